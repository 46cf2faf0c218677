"""Roll-ups and feeds over the analysis table.

Group statistics use partial aggregation (``groupBy().agg``) and, for exact
medians, the frequency-table method of :mod:`larder.operators.ranks`; feeds
are projections with a filter, a bounded top-k where the limit is the
feature, or a semi-join against a code list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import exact_mean
from larder.operators.ranks import GROUP, describe, group_columns, value_counts, with_group


# Quantiles of the nutrition-structure view.
STRUCTURE_QUANTILES = {"p25": 0.25, "p75": 0.75, "p95": 0.95}


def group_stats(df: DataFrame, views: Mapping[str, Sequence[str]], measures: Mapping[str, Column | str],
                range_rows: int | None = None) -> DataFrame:
    """(view, _g, measure, n, mean, median, p25, p75, p95): per view, group
    of its keys and measure the non-null count, mean, exact median and
    nearest-rank quantiles.  Views and measures are stacked long, so one
    frequency table serves all of them; ``_g`` is a struct over the keys of all
    views in which those that a view does not use are null."""
    keys = list(dict.fromkeys(k for own in views.values() for k in own))
    types = {f.name: f.dataType for f in df.schema.fields}

    def group(own: Sequence[str]) -> Column:
        return F.struct(*[(F.col(k) if k in own else F.lit(None).cast(types[k])).alias(k) for k in keys])

    entries = [F.struct(F.lit(view).alias("view"), group(own).alias(GROUP), F.lit(m).alias("measure"),
                        (F.col(e) if isinstance(e, str) else e).cast("double").alias("_v"))
               for view, own in views.items() for m, e in measures.items()]
    by = ["view", GROUP, "measure"]
    freq = value_counts(df.select(F.inline(F.array(*entries))), "_v", by=by, mean=True)
    return (describe(freq, "_v", by=by, median="median", mean="mean", qs=STRUCTURE_QUANTILES, range_rows=range_rows)
            .select(*by, "n", "mean", "median", *STRUCTURE_QUANTILES))


def currency_medians(aligned: DataFrame, range_rows: int | None = None) -> DataFrame:
    """Per currency (null kept): rows, exact median and mean price, from
    one frequency table."""
    freq = value_counts(with_group(aligned, ["currency"]), "price_value", mean=True)
    return (describe(freq, "price_value", median="median_price", mean="mean_price", range_rows=range_rows)
            .select(*group_columns(["currency"]), F.col("n").alias("rows"), "median_price", "mean_price"))


def brand_concentration(df: DataFrame, keys: Sequence[str] = ("analysis_country_tag", "analysis_category_tag"),
                        brand: str = "primary_brand_tag") -> DataFrame:
    """K1: per market (keys): products with a brand, distinct brands, the top
    brand's share and the Herfindahl index sum(share^2).

    ``groupBy(keys, brand).count()`` is partially aggregated; the market
    figures are a second aggregate over that (brand-sized) table, so no step
    sees the rows of a market together."""
    keys = list(keys)
    per_brand = (with_group(df.filter(F.col(brand).isNotNull()), keys)
                 .groupBy(GROUP, brand).agg(F.count(F.lit(1)).alias("n")))
    # sum(n^2) / total^2 is the Herfindahl index computed from exact
    # integer sums, so it does not depend on summation order
    market = per_brand.groupBy(GROUP).agg(
        F.sum("n").alias("branded_products"),
        F.count(F.lit(1)).alias("brands"),
        F.max("n").alias("_top"),
        F.sum(F.col("n") * F.col("n")).alias("_sq"),
    )
    total = F.col("branded_products").cast("double")
    return market.select(*[F.col(f"{GROUP}.{k}").alias(k) for k in keys],
                         "branded_products", "brands",
                         (F.col("_top").cast("double") / total).alias("top_brand_share"),
                         (F.col("_sq").cast("double") / (total * total)).alias("hhi"))


def brand_shares(df: DataFrame, keys: Sequence[str] = ("analysis_country_tag", "analysis_category_tag"),
                 brand: str = "primary_brand_tag") -> DataFrame:
    """K1 detail: (keys..., brand, n, share) for every branded market."""
    keys = list(keys)
    per_brand = (with_group(df.filter(F.col(brand).isNotNull()), keys)
                 .groupBy(GROUP, brand).agg(F.count(F.lit(1)).alias("n")))
    totals = per_brand.groupBy(GROUP).agg(F.sum("n").alias("_total"))
    return (per_brand.join(totals, on=GROUP, how="inner")
            .select(*[F.col(f"{GROUP}.{k}").alias(k) for k in keys], brand, "n",
                    (F.col("n") / F.col("_total")).alias("share")))


def country_overview(analysis: DataFrame, key: str = "analysis_country_tag") -> DataFrame:
    """K2: per country: products, mean health score, mean completeness
    score, mean Nutri-Score and mean NOVA group."""
    return analysis.groupBy(key).agg(
        F.count("code").alias("products"),
        exact_mean("health_score_composite").alias("avg_health_score"),
        exact_mean("data_completeness_score").alias("avg_data_completeness_score"),
        exact_mean("nutriscore_score").alias("avg_nutriscore_score"),
        exact_mean("nova_group").alias("avg_nova_group"),
    )


# Measures of the nutrition-structure view (K3).
STRUCTURE_MEASURES = {
    "sugars_100g": "sugars_100g",
    "salt_equivalent_100g": "salt_equivalent_100g",
    "fat_100g": "fat_100g",
    "energy_kcal_100g": "energy_kcal_100g",
    "nutriscore_score": "nutriscore_score",
    "nova_group": "nova_group",
}


# Keys of the two nutrition-structure views.
STRUCTURE_VIEWS = {
    "category": ["analysis_country_tag", "analysis_category_tag"],
    "brand": ["analysis_country_tag", "primary_brand_tag"],
}


def nutrition_structure(analysis: DataFrame, views: Mapping[str, Sequence[str]] = STRUCTURE_VIEWS,
                        range_rows: int | None = None) -> DataFrame:
    """K3: (view, analysis_country_tag, member, measure, n, ...): per
    (country, category) and per (country, brand), in one pass, n, mean, exact
    median and quantiles of the six nutrition measures, long format.  A view
    is a country key and a member key."""
    member = F.coalesce(*[F.when(F.col("view") == F.lit(v), F.col(f"{GROUP}.{own[1]}")) for v, own in views.items()])
    country = F.coalesce(*[F.when(F.col("view") == F.lit(v), F.col(f"{GROUP}.{own[0]}")) for v, own in views.items()])
    return (group_stats(analysis, views, STRUCTURE_MEASURES, range_rows)
            .select("view", country.alias("analysis_country_tag"), member.alias("member"), "measure", "n", "mean",
                    "median", *STRUCTURE_QUANTILES))


def anomaly_feed(analysis: DataFrame, limit: int | None = None) -> DataFrame:
    """K4: every product with the scatter plot's axes, colour and size fields;
    with ``limit``, only the most anomalous ones (ties broken by code)."""
    feed = analysis.select(
        "code", "analysis_country_tag", "analysis_category_tag", "primary_brand_tag",
        "price_median", "sugars_100g", "salt_equivalent_100g", "health_score_composite",
        "data_completeness_score", "peer_anomaly_score", "price_record_count", "unique_scans_n")
    if limit is None:
        return feed
    return feed.orderBy(F.col("peer_anomaly_score").desc_nulls_last(), F.col("code").asc()).limit(limit)


def currency_feed(analysis: DataFrame) -> DataFrame:
    """K5: products with a price, same-market rows first-class (kept and
    flagged), one currency at a time via the ``currency`` column (write with
    ``partitionBy("currency")``)."""
    return analysis.filter(F.col("has_price")).select(
        "currency", "code", "analysis_country_tag", "analysis_category_tag",
        "any_same_market_match", "price_median", "price_median_percentile",
        "health_score_composite", "health_score_percentile", "price_nutrition_value_index")


def write_currency_feed(analysis: DataFrame, path: str) -> None:
    """K5 sink: one folder per currency, so a reader filtering on one currency
    lists only its folder (partition pruning)."""
    currency_feed(analysis).write.mode("overwrite").partitionBy("currency").parquet(path)


def product_detail(analysis: DataFrame, codes: DataFrame, key: str = "code") -> DataFrame:
    """K6: all fields of the products whose code is in ``codes`` (semi-join;
    the code list may be as large as the table)."""
    return analysis.join(codes.select(key).distinct(), on=key, how="left_semi")
