"""Price-to-product alignment and price summaries.

Both inputs grow with the data (a catalogue and a price log), so the joins
are plain equi-joins left to the planner: sort-merge by default, turned into
a broadcast by AQE only when a side's measured size is under the threshold,
and with skewed partitions split by AQE's skew-join handling when one barcode
carries a large share of the prices.  Null keys are filtered before the join
(Catalyst would infer the same filter).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.predicates import same_market
from larder.operators.ranks import (GROUP, Carried, describe, describe_rows, group_columns, split_points, value_counts,
                                    with_group)

# Product columns brought to each price row (key + 18 attributes).
PRODUCT_JOIN_COLS = [
    "code", "product_name", "analysis_country_tag", "analysis_country_code",
    "analysis_category_tag", "nutriscore_grade", "nutriscore_score", "nova_group",
    "completeness", "quality_warning_count", "quality_error_count", "energy_kcal_100g",
    "fat_100g", "saturated_fat_100g", "carbohydrates_100g", "sugars_100g",
    "proteins_100g", "salt_100g", "fiber_100g",
]

# Output columns of the aligned price table, in order.
ALIGNED_COLS = [
    "id", "product_code", "product_name", "analysis_country_tag", "analysis_country_code",
    "analysis_category_tag", "location_osm_address_country_code", "location_osm_address_country",
    "location_osm_address_city", "currency", "price_value", "price_without_discount_value",
    "price_is_discounted", "date", "proof_type", "source", "same_market_as_analysis_country",
    "nutriscore_grade", "nutriscore_score", "nova_group", "completeness",
    "quality_warning_count", "quality_error_count", "energy_kcal_100g", "fat_100g",
    "saturated_fat_100g", "carbohydrates_100g", "sugars_100g", "proteins_100g",
    "salt_100g", "fiber_100g",
]

# The keys of the price summary.
SUMMARY_KEYS = [
    "product_code", "analysis_country_tag", "analysis_country_code",
    "analysis_category_tag", "location_osm_address_country_code", "currency",
]


def align_prices(prices: DataFrame, products: DataFrame,
                 product_cols: Sequence[str] = PRODUCT_JOIN_COLS,
                 out_cols: Sequence[str] = ALIGNED_COLS) -> DataFrame:
    """J2 = B17 -> D1 -> C8/B13/B14 -> projection.

    ``product_name`` of the result is the price table's own; the product's
    copy is not brought over (the reference's join would suffix it and
    never select it)."""
    right = products.select(*[c for c in product_cols if c != "product_name"])
    joined = (prices.filter(F.col("product_code").isNotNull())
              .join(right, prices["product_code"] == right["code"], "inner")
              .drop(right["code"]))
    price = F.col("price").cast("double")
    return (joined
            .withColumns({
                "price_value": price,
                "price_without_discount_value": F.col("price_without_discount").cast("double"),
                "same_market_as_analysis_country": same_market(
                    "location_osm_address_country_code", "analysis_country_code"),
            })
            .filter(price > F.lit(0.0))
            .select(*out_cols))


def price_carried() -> Carried:
    """What a price table's frequency table carries per (keys, price), and how
    two of them are merged."""
    return {"any_same_market_match": (F.bool_or("same_market_as_analysis_country"), F.bool_or),
            "first_price_date": (F.min("date"), F.min), "last_price_date": (F.max("date"), F.max)}


def price_counts(aligned: DataFrame, keys: Sequence[str] = SUMMARY_KEYS) -> DataFrame:
    """The frequency table ``(_g, price_value, c, _sum, ...)`` that holds all
    that a price summary needs: the only shuffle of the aligned rows.  Tables
    of several batches add up (:func:`larder.operators.ranks.add_counts`)."""
    return value_counts(with_group(aligned, list(keys)), "price_value", carry=price_carried(), mean=True)


def summary_of_counts(counts: DataFrame, keys: Sequence[str] = SUMMARY_KEYS,
                      range_rows: int | None = None) -> DataFrame:
    """The price summary cut from its frequency table."""
    out = describe(counts, "price_value", median="price_median", mean="price_mean", carry=price_carried(),
                   range_rows=range_rows)
    return _summary_columns(out, group_columns(keys))


def _summary_columns(out: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    return out.select(*keys, F.col("n").cast("int").alias("price_record_count"),
                      F.col("min").alias("price_min"), "price_median", "price_mean", F.col("max").alias("price_max"),
                      F.coalesce("any_same_market_match", F.lit(False)).alias("any_same_market_match"),
                      "first_price_date", "last_price_date")


# Columns of the price table alone that tell its rows apart: a share drawn by
# their hash is drawn before the join with the products.
ROW_COLS = ("id", "price_value", "date")


def summarise_prices(aligned: DataFrame, keys: Sequence[str] = SUMMARY_KEYS,
                     range_rows: int | None = None, from_rows: bool = False) -> DataFrame:
    """Per key tuple: count, min, exact median, mean, max, any
    same-market match (all-null gives false), first and last date, all eight
    from one weighted ``(keys, price)`` frequency table, so no task holds a
    whole group.

    With ``from_rows``, and where no product has more than about ``range_rows``
    rows, no table is written: the rows take one exchange by product and two
    windows on it, and the result stays partitioned by product, so the choice of
    one row per product moves little."""
    keys = list(keys)
    if from_rows:
        marks = [c for c in ROW_COLS if c in aligned.columns]
        near = with_group(aligned, keys[:1])
        if split_points(near, "price_value", [GROUP], marks, range_rows) is None:
            out = describe_rows(aligned, "price_value", keys, keys[:1], median="price_median", mean="price_mean",
                                carry={"any_same_market_match": ("same_market_as_analysis_country", F.bool_or),
                                       "first_price_date": ("date", F.min), "last_price_date": ("date", F.max)})
            return _summary_columns(out, keys)
    return summary_of_counts(price_counts(aligned, keys), keys, range_rows)


def with_price_flag(products: DataFrame, prices: DataFrame, flag: str = "_has_price",
                    product_key: str = "code", price_key: str = "product_code") -> DataFrame:
    """D3 as one pass: every product row with a boolean telling whether its
    code has any price.  Distinct price codes (partially aggregated) are
    left-joined once instead of one join per filter level."""
    codes = (prices.select(F.col(price_key).alias(product_key)).filter(F.col(product_key).isNotNull())
             .distinct().withColumn(flag, F.lit(True)))
    return (products.join(codes, on=product_key, how="left")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))
