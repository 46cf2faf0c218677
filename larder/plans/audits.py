"""Dataset audit, filter audit, preprocessing and price-alignment audit.

Each job returns a ``dict[str, DataFrame]`` of small report tables (the
reference renders them to JSON/Markdown; here they stay tables and can be
written with :func:`larder.sources.io.write_report`).  Scalar metrics of one
table come from one aggregate over one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from larder.functions import predicates as P
from larder.functions.scalars import pct
from larder.operators import audit as A
from larder.operators.ladder import ladder_counts, level_profile
from larder.sources.io import stage

# The reference's required-field spec per dataset.
PRODUCT_REQUIRED = {
    "identity": ["code", "product_name", "brands", "brands_tags"],
    "geography": ["countries_tags", "main_countries_tags"],
    "category": ["categories", "categories_tags", "food_groups_tags"],
    "health": ["nutriscore_grade", "nutriscore_score", "nova_group", "nova_groups_tags",
               "nutrient_levels_tags", "nutriments"],
    "label_transparency": ["labels_tags", "ingredients_text", "completeness",
                           "data_quality_warnings_tags", "data_quality_errors_tags"],
    "popularity": ["scans_n", "unique_scans_n", "popularity_tags"],
}
PRICE_REQUIRED = {
    "identity": ["id", "product_code", "product_name", "category_tag"],
    "price": ["price", "price_without_discount", "price_is_discounted", "price_per", "currency", "date"],
    "geography": ["location_osm_lat", "location_osm_lon", "location_osm_address_country",
                  "location_osm_address_country_code", "location_osm_address_city",
                  "location_osm_display_name"],
    "provenance": ["proof_type", "source", "created", "updated"],
}

# Nutrient entry names audited for coverage.
NUTRIENTS_OF_INTEREST = [
    "energy-kcal", "energy-kj", "fat", "saturated-fat", "carbohydrates", "sugars", "fiber",
    "proteins", "salt", "sodium", "nova-group", "nutrition-score-fr",
]

# Fields audited for coverage per dataset.
PRODUCT_CORE_FIELDS = [
    "code", "product_name", "brands", "brands_tags", "countries_tags", "main_countries_tags",
    "categories", "categories_tags", "food_groups_tags", "nutriscore_grade", "nutriscore_score",
    "nova_group", "nova_groups_tags", "nutrient_levels_tags", "nutriments", "labels_tags",
    "ingredients_text", "completeness", "data_quality_warnings_tags", "data_quality_errors_tags",
    "scans_n", "unique_scans_n",
]
PRICE_CORE_FIELDS = [
    "id", "type", "product_code", "product_name", "category_tag", "labels_tags", "origins_tags",
    "price", "price_is_discounted", "price_without_discount", "price_per", "currency", "date",
    "location_osm_address_country", "location_osm_address_country_code",
    "location_osm_address_city", "location_osm_lat", "location_osm_lon",
    "location_osm_display_name", "proof_type", "source",
]

# Fields profiled and tallied per dataset.
PRODUCT_NUMERIC = ["completeness", "nutriscore_score", "nova_group", "scans_n", "unique_scans_n"]
PRICE_NUMERIC = ["price", "price_without_discount"]
PRODUCT_TOP_LISTS = ["countries_tags", "categories_tags", "brands_tags"]
PRODUCT_TOP_SCALARS = ["nutriscore_grade", "nova_group"]
PRICE_TOP_SCALARS = ["currency", "price_per", "location_osm_address_country_code", "proof_type"]


def _tag(df: DataFrame, **cols) -> DataFrame:
    return df.select(*[F.lit(v).alias(k) for k, v in cols.items()], "*")


def top_table(df: DataFrame, columns: Sequence[str], limit: int, explode: bool,
              keep_null: bool = False) -> DataFrame:
    """G1/G2/G3 for several columns in one scan -> (column, value string, count)."""
    return A.top_values_multi(df, {c: (limit, ()) for c in columns}, explode=explode,
                              keep_null=keep_null)


def product_figures(products: DataFrame) -> DataFrame:
    """All counts of the catalogue (A3, A4, E2, E3, E5) from one scan."""
    return A.figures(products, {
        "rows": {"food_rows": F.lit(True)},
        "required": _required(products, PRODUCT_REQUIRED),
        "coverage": P.present_flags(products.schema, PRODUCT_CORE_FIELDS),
        "derived": P.product_usability(products.schema),
        "nutrient": {n: P.has_named_entry(n) for n in NUTRIENTS_OF_INTEREST},
    })


def price_figures(prices: DataFrame) -> DataFrame:
    """All counts of the price table (A3, A4, E2, E6, E7) from one scan."""
    return A.figures(prices, {
        "rows": {"price_rows": F.lit(True)},
        "required": _required(prices, PRICE_REQUIRED),
        "coverage": P.present_flags(prices.schema, PRICE_CORE_FIELDS),
        "derived": P.price_readiness(),
    })


def _required(df: DataFrame, spec: Mapping[str, Sequence[str]]) -> dict:
    return {f: F.col(f).isNotNull() for fields in spec.values() for f in fields if f in df.columns}


def _group(figures: DataFrame, source: str, name: str, **tags) -> DataFrame:
    """One group of a figures table as (name, present_rows, coverage_pct)."""
    rows = figures.filter(F.col("source") == source).select(
        F.col("metric").alias(name), "present_rows",
        pct("present_rows", "rows", zero=None).alias("coverage_pct"))
    return _tag(rows, **tags)


def _required_table(figures: DataFrame, spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """A3 from a figures table: (group, field, present, present_rows)."""
    wanted = figures.sparkSession.createDataFrame(
        [(g, f) for g, fields in spec.items() for f in fields], "group string, field string")
    found = figures.filter(F.col("source") == "required").select(F.col("metric").alias("field"), "present_rows")
    return wanted.join(found, on="field", how="left").select(
        "group", "field", F.col("present_rows").isNotNull().alias("present"), "present_rows")


def schema_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A2 without a scan: (dataset, position, column, type, is_list)."""
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        [(d, i, f.name, f.dataType.simpleString(), isinstance(f.dataType, ArrayType))
         for d, df in tables.items() for i, f in enumerate(df.schema.fields)],
        "dataset string, position int, column string, type string, is_list boolean")


def audit_datasets(products: DataFrame, prices: DataFrame) -> dict[str, DataFrame]:
    """Schema, row counts, coverage, derived quality, nutrient coverage,
    numeric and date profiles, value tops, join coverage and task readiness.

    The counts of each table are taken once and written (a few dozen rows);
    every report table of counts is cut from there."""
    of_products = stage(product_figures(products), "product-figures")
    of_prices = stage(price_figures(prices), "price-figures")
    joined = stage(A.join_coverage(products, prices), "join-coverage")
    return {
        "schema_columns": schema_columns({"products": products, "prices": prices}),
        "row_counts": A.stack_metrics([
            _tag(f.filter(F.col("source") == "rows").select("rows"), dataset=d)
            for d, f in (("products", of_products), ("prices", of_prices))]),
        "product_required_fields": _required_table(of_products, PRODUCT_REQUIRED),
        "price_required_fields": _required_table(of_prices, PRICE_REQUIRED),
        "field_coverage": A.stack_metrics([_group(of_products, "coverage", "field", dataset="products"),
                                           _group(of_prices, "coverage", "field", dataset="prices")]),
        "derived_quality": A.stack_metrics([_group(of_products, "derived", "metric", dataset="products"),
                                            _group(of_prices, "derived", "metric", dataset="prices")]),
        "nutrient_coverage": _group(of_products, "nutrient", "nutrient"),
        "numeric_profile": A.stack_metrics([
            _tag(A.numeric_profile(products, PRODUCT_NUMERIC), dataset="products"),
            _tag(A.numeric_profile(prices, PRICE_NUMERIC), dataset="prices")]),
        "date_profile": A.date_profile(prices, "date"),
        "top_product_lists": top_table(products, PRODUCT_TOP_LISTS, 20, explode=True, keep_null=True),
        "top_scalars": A.stack_metrics([
            _tag(top_table(products, PRODUCT_TOP_SCALARS, 20, explode=False), dataset="products"),
            _tag(top_table(prices, PRICE_TOP_SCALARS, 20, explode=False), dataset="prices")]),
        "join_coverage": joined,
        "task_readiness": _readiness(of_products, of_prices, joined),
    }


def derived_quality(products: DataFrame, prices: DataFrame) -> DataFrame:
    """E5 + E6 -> (dataset, metric, present_rows, coverage_pct)."""
    return A.stack_metrics([
        _tag(A.count_table(products, P.product_usability(products.schema), "metric"), dataset="products"),
        _tag(A.count_table(prices, P.price_readiness(), "metric"), dataset="prices")])


def audit_filters(products: DataFrame, prices: DataFrame, level: str = "strict_quality_ready",
                  limit: int = 20) -> dict[str, DataFrame]:
    """The ladder with price matches, the profile of one level, its tag
    tops and its grade / NOVA distributions."""
    levels = P.filter_ladder(products.schema)
    chosen = products.filter(levels[level])
    return {
        "ladder": ladder_counts(products, prices, levels),
        "level_profile": level_profile(products, levels[level]),
        "level_top_lists": top_table(chosen, PRODUCT_TOP_LISTS, limit, explode=True),
        "level_nutriscore_dist": A.value_distribution(chosen, "nutriscore_grade"),
        "level_nova_dist": A.value_distribution(chosen, "nova_group"),
    }


def aligned_metrics() -> dict[str, Column]:
    """What a job counts of the aligned table while it writes it."""
    same = F.coalesce(F.col("same_market_as_analysis_country"), F.lit(False))
    return {"aligned_price_rows": F.count(F.lit(1)), "same_market_rows": F.count_if(same),
            "same_market_non_null_currency_rows": F.count_if(same & F.col("currency").isNotNull())}


def row_metrics(name: str) -> dict[str, Column]:
    """The row count of a table that is being written."""
    return {name: F.count(F.lit(1))}


def _counts(df: DataFrame, metrics: Mapping[str, Column], known: Mapping[str, int]) -> dict[str, int]:
    """The metrics of a table: those taken while it was written, or else from
    one scan (one row of numbers)."""
    if all(name in known for name in metrics):
        return {name: known[name] for name in metrics}
    return df.agg(*[agg.alias(name) for name, agg in metrics.items()]).first().asDict()


def _priced_products(summary: DataFrame) -> DataFrame:
    """One row: products with a price, and with a same-market price in a known
    currency.  The currency is a key of the summary, so both distinct counts
    come from it, by one row per product."""
    same = F.col("any_same_market_match") & F.col("currency").isNotNull()
    per_code = summary.groupBy("product_code").agg(F.max(same.cast("int")).alias("_same"))
    return per_code.agg(F.count(F.lit(1)).alias("unique_products_with_price"),
                        F.coalesce(F.sum("_same"), F.lit(0)).cast("long").alias("unique_products_with_same_market_price"))


def alignment_counters(products_main: DataFrame, aligned: DataFrame, summary: DataFrame,
                       known: Mapping[str, int] | None = None) -> DataFrame:
    """E12 (B14): one row of alignment counters and percentages.

    ``known`` holds the counts that were taken while the tables were written
    (``product_rows``, ``price_summary_rows`` and :func:`aligned_metrics`); what
    it lacks costs one scan of its table.  The distinct counts are an aggregate
    over the summary."""
    known = known or {}
    found = {**_counts(products_main, row_metrics("product_rows"), known),
             **_counts(aligned, aligned_metrics(), known),
             **_counts(summary, row_metrics("price_summary_rows"), known)}
    wide = _priced_products(summary).select("*", *[F.lit(int(v)).cast("long").alias(n) for n, v in found.items()])
    return wide.select(
        "aligned_price_rows",
        "unique_products_with_price",
        pct("unique_products_with_price", "product_rows").alias("products_with_price_pct"),
        "same_market_rows",
        pct("same_market_rows", "aligned_price_rows").alias("same_market_rows_pct"),
        "same_market_non_null_currency_rows",
        pct("same_market_non_null_currency_rows", "aligned_price_rows").alias(
            "same_market_non_null_currency_rows_pct"),
        "unique_products_with_same_market_price",
        pct("unique_products_with_same_market_price", "product_rows").alias(
            "unique_products_with_same_market_price_pct"),
        "price_summary_rows",
    )


def preprocess_counters(raw: DataFrame, products_main: DataFrame, summary: DataFrame,
                        known: Mapping[str, int] | None = None) -> DataFrame:
    """Raw rows, kept rows and share, products with a price and share.
    ``known`` as in :func:`alignment_counters`; the raw rows are counted from
    the scan, which reads no column for it."""
    found = _counts(products_main, row_metrics("product_rows"), known or {})
    total = raw.agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    wide = _priced_products(summary).select(
        F.lit(total).cast("long").alias("total_raw_product_rows"),
        F.lit(found["product_rows"]).cast("long").alias("preprocessed_product_rows"),
        F.col("unique_products_with_price").alias("products_with_price"))
    return wide.select(
        "total_raw_product_rows", "preprocessed_product_rows",
        pct("preprocessed_product_rows", "total_raw_product_rows").alias("preprocessed_product_pct_total"),
        "products_with_price",
        pct("products_with_price", "preprocessed_product_rows").alias("products_with_price_pct"),
    )


def selected_tag_counts(products_main: DataFrame, selected: Mapping[str, Sequence[str]]) -> DataFrame:
    """E13 (second half): each selected tag with its attributed row count in
    the product table; a tag with no rows gets 0 (left join of the k tags)."""
    spark = products_main.sparkSession
    parts = []
    for col, tags in selected.items():
        sel = spark.createDataFrame([(col, t, i) for i, t in enumerate(tags)],
                                    "column string, tag string, position int")
        counts = A.value_distribution(products_main, col).select(
            F.col("value").alias("tag"), F.col("count").alias("rows"))
        parts.append(sel.join(counts, on="tag", how="left")
                     .select("column", "position", "tag",
                             F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows")))
    return A.stack_metrics(parts)


def audit_alignment(raw: DataFrame, products_main: DataFrame, aligned: DataFrame,
                    summary: DataFrame, selected: Mapping[str, Sequence[str]],
                    known: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """Preprocessing counters, selected tags, alignment counters, value
    distributions and per-currency price medians.  ``known``: counts taken while
    the tables were written."""
    from larder.operators.rollups import currency_medians
    return {
        "preprocess_counters": preprocess_counters(raw, products_main, summary, known),
        "selected_tags": selected_tag_counts(products_main, selected),
        "alignment_counters": alignment_counters(products_main, aligned, summary, known),
        "aligned_currencies": A.value_distribution(aligned, "currency"),
        "aligned_price_countries": A.value_distribution(aligned, "location_osm_address_country_code"),
        "product_countries": A.value_distribution(products_main, "analysis_country_tag"),
        "product_categories": A.value_distribution(products_main, "analysis_category_tag"),
        "median_price_by_currency": currency_medians(aligned),
    }


# Which audited figures support which analysis task (E16).  The reference
# attaches prose and a status word to these; only the figures are built.  It
# names none for T4; those two are an addition.
TASK_METRICS = {
    "T1_global_nutrition_structure": [
        ("rows", "products", "food_rows"),
        ("derived", "products", "valid_nutriscore_grade_a_to_e"),
        ("coverage", "products", "nutriscore_score"),
        ("coverage", "products", "nova_group"),
        ("nutrient", "products", "sugars"),
        ("nutrient", "products", "salt"),
        ("nutrient", "products", "fat"),
    ],
    "T2_price_health_relationship": [
        ("rows", "prices", "price_rows"),
        ("coverage", "prices", "price"),
        ("coverage", "prices", "currency"),
        ("coverage", "prices", "date"),
        ("derived", "prices", "price_currency_date_geo_ready"),
        ("join", "prices", "matched_price_rows_pct"),
    ],
    "T3_label_transparency": [
        ("coverage", "products", "completeness"),
        ("coverage", "products", "labels_tags"),
        ("coverage", "products", "ingredients_text"),
    ],
    "T4_peer_comparison_and_anomalies": [
        ("derived", "products", "has_country_category_and_brand"),
        ("join", "prices", "matched_price_rows_pct"),
    ],
}


def _readiness(of_products: DataFrame, of_prices: DataFrame, joined: DataFrame) -> DataFrame:
    value = F.when(F.col("source") == "rows", F.col("present_rows").cast("double")).otherwise(
        pct("present_rows", "rows", zero=None))
    found = A.stack_metrics([
        *[f.select("source", F.lit(d).alias("dataset"), "metric", value.alias("value"))
          for d, f in (("products", of_products), ("prices", of_prices))],
        joined.select(F.lit("join").alias("source"), F.lit("prices").alias("dataset"),
                      F.lit("matched_price_rows_pct").alias("metric"),
                      F.col("matched_price_rows_pct").alias("value"))])
    wanted = joined.sparkSession.createDataFrame(
        [(t, s, d, m, i) for t, ms in TASK_METRICS.items() for i, (s, d, m) in enumerate(ms)],
        "task string, source string, dataset string, metric string, position int")
    return (wanted.join(found, on=["source", "dataset", "metric"], how="left")
            .select("task", "position", "source", "dataset", "metric", "value"))


def task_readiness(products: DataFrame, prices: DataFrame) -> DataFrame:
    """(task, position, source, dataset, metric, value): the audited
    figures (percentages; row counts for the ``rows`` source) behind each
    task, from one scan of counts and one of codes per table."""
    return _readiness(product_figures(products), price_figures(prices), A.join_coverage(products, prices))
