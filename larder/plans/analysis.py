"""The one-row-per-product analysis table (``products_analysis``).

Dependency order (kept from the reference): base columns -> peer
percentiles -> scores -> score percentiles -> value index -> robust z ->
anomaly score -> flags.

Plan shape: the primary price per product is a partial aggregate (``min_by``)
and one left join by code.  Percentiles and robust z use
:mod:`larder.operators.peers`: ranks of stacked rows where they lie and small
per-group statistics from frequency tables; the wide table is written once and
only ever joined by ``code`` (unique), never gathered by peer group.  What a pass
adds is a narrow table by code; they meet the wide one in the last joins, of
which a caller that selects a few columns reads no more than those.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import scores as SC
from larder.operators.dedup import asc, desc, top_one
from larder.operators.peers import percentile_table, robust_z
from larder.sources.io import stage

GROUP_KEYS = ("analysis_country_tag", "analysis_category_tag")
PRICE_KEYS = ("analysis_country_code", "currency", "analysis_category_tag")

# Output columns of the analysis table, in order.
ANALYSIS_COLS = [
    "code", "product_name", "brands", "primary_brand_tag", "analysis_country_tag",
    "analysis_country_code", "analysis_category_tag", "nutriscore_grade", "nutriscore_score",
    "nova_group", "energy_kcal_100g", "energy_kj_100g", "fat_100g", "saturated_fat_100g",
    "carbohydrates_100g", "sugars_100g", "proteins_100g", "salt_100g", "salt_equivalent_100g",
    "fiber_100g", "completeness", "has_ingredients_text", "has_labels_tags", "labels_count",
    "quality_warning_count", "quality_error_count", "nutrition_fields_present_count",
    "nutrient_field_fill_rate", "data_completeness_score", "data_completeness_percentile",
    "scans_n", "unique_scans_n", "currency", "location_osm_address_country_code",
    "price_record_count", "price_min", "price_median", "price_mean", "price_max",
    "first_price_date", "last_price_date", "any_same_market_match", "has_price",
    "nutriscore_good_percentile", "nova_good_percentile", "sugars_good_percentile",
    "salt_good_percentile", "proteins_good_percentile", "sugars_percentile", "salt_percentile",
    "fat_percentile", "saturated_fat_percentile", "energy_percentile", "price_median_percentile",
    "price_percentile_within_peer", "health_score_composite", "health_score_percentile",
    "price_nutrition_value_index", "price_robust_z", "sugars_robust_z", "salt_robust_z",
    "saturated_fat_robust_z", "nutriscore_robust_z", "nova_robust_z",
    "data_completeness_robust_z", "peer_anomaly_score", "flag_high_price_low_health",
    "flag_high_sugar_high_nova", "flag_low_completeness_many_warnings",
]


# Fixed value: the records that a same-market match counts for.
SAME_MARKET_PRIORITY = 100_000


@dataclass(frozen=True)
class AnalysisSpec:
    group_keys: Sequence[str] = GROUP_KEYS
    price_keys: Sequence[str] = PRICE_KEYS
    range_rows: int | None = None  # rows of a group that isn't cut into ranges; None: ranks.RANGE_ROWS
    health: str = "code"           # K7: "code" (default) or "design" formula
    materialize: bool = True       # write each pass to the checkpoint folder


def primary_price(summary: DataFrame) -> DataFrame:
    """Per product the summary row with the highest priority, which is
    ``SAME_MARKET_PRIORITY`` for a same-market match plus the number of
    records; then the most records, then location country and currency
    ascending (nulls last) as total tie-breaks.  The three product attributes
    are dropped."""
    priority = (F.col("any_same_market_match").cast("long") * SAME_MARKET_PRIORITY
                + F.col("price_record_count"))
    order = [*desc(priority), *desc(F.col("price_record_count")),
             *asc("location_osm_address_country_code"), *asc("currency")]
    return top_one(summary, ["product_code"], order,
                   drop=["analysis_country_tag", "analysis_country_code", "analysis_category_tag"])


def base_table(products: DataFrame, summary: DataFrame) -> DataFrame:
    """D2 + C13-C19: every product, its primary price (null when none) and
    the row-level inputs of the metrics, all assigned simultaneously."""
    joined = products.join(primary_price(summary), products["code"] == F.col("product_code"), "left")
    joined = joined.drop("product_code")
    return joined.withColumns({
        "nutrient_field_fill_rate": S.fill_rate("nutrition_fields_present_count", 8.0),
        "has_price": F.coalesce(F.col("price_record_count"), F.lit(0)) > F.lit(0),
        "price_record_count": F.coalesce(F.col("price_record_count"), F.lit(0)).cast("int"),
        "any_same_market_match": F.coalesce(F.col("any_same_market_match"), F.lit(False)),
        "has_quality_warning": S.positive_flag("quality_warning_count"),
        "has_quality_error": S.positive_flag("quality_error_count"),
        "nutriscore_good_direction": S.negate("nutriscore_score"),
        "nova_scaled": S.scaled_group("nova_group"),
        "salt_equivalent_100g": S.salt_equivalent("salt_100g", "sodium_100g"),
        "price_median_clean": S.positive_or_null("price_median"),
    })


def build_analysis(products: DataFrame, summary: DataFrame,
                   spec: AnalysisSpec = AnalysisSpec()) -> DataFrame:
    """``products_analysis`` (69 columns, one row per code).

    ``products`` is unique per code (J1 dedups) and the primary price is
    unique per product, so the left join keeps one row per code and the
    reference's final keep-first is a no-op that costs no shuffle here."""
    keys, limit = list(spec.group_keys), spec.range_rows
    df = base_table(products, summary).withColumn("data_completeness_score", SC.completeness_score())

    def cut(df: DataFrame, name: str) -> DataFrame:
        # a pass reads its input several times (group sizes, stacked
        # measures), and so may the caller: a written table keeps that from
        # re-running the whole lineage and survives executor loss
        return stage(df, name, count=True) if spec.materialize else df

    df = cut(df, "analysis-base")

    peer = {
        "nutriscore_good_percentile": F.col("nutriscore_good_direction"),
        "nova_good_percentile": -F.col("nova_group"),
        "sugars_good_percentile": -F.col("sugars_100g"),
        "salt_good_percentile": -F.col("salt_equivalent_100g"),
        "proteins_good_percentile": F.col("proteins_100g"),
        "sugars_percentile": F.col("sugars_100g"),
        "salt_percentile": F.col("salt_equivalent_100g"),
        "fat_percentile": F.col("fat_100g"),
        "saturated_fat_percentile": F.col("saturated_fat_100g"),
        "energy_percentile": F.col("energy_kcal_100g"),
        "price_percentile_within_peer": F.col("price_median_clean"),
        "data_completeness_percentile": F.col("data_completeness_score"),
    }
    price_keys = list(spec.price_keys)
    if spec.health == "design":
        # K7 design variant: value index keyed by the *location* country
        price_keys = ["location_osm_address_country_code", "currency", "analysis_category_tag"]
    # F3 has its own peer keys but shares the pass (one stacked table)
    peer["price_median_percentile"] = (F.col("price_median_clean"), price_keys)
    percentiles = cut(percentile_table(df, peer, keys, range_rows=limit), "analysis-percentiles")

    if spec.health == "design":
        health = S.clip01(F.lit(0.45) * F.col("nutriscore_good_percentile")
                          + F.lit(0.25) * (F.lit(1.0) - F.col("nova_scaled"))
                          + F.lit(0.15) * (F.lit(1.0) - F.col("sugars_percentile"))
                          + F.lit(0.10) * (F.lit(1.0) - F.col("salt_percentile"))
                          + F.lit(0.05) * F.col("proteins_good_percentile"))
    else:
        health = SC.health_score()
    scores = cut(df.join(percentiles, on="code", how="left")
                 .select("code", *keys, health.alias("health_score_composite")), "analysis-scores")
    ranked = cut(percentile_table(scores, {"health_score_percentile": F.col("health_score_composite")},
                                  keys, range_rows=limit), "analysis-score-pct")
    df = robust_z(df, {
        "price_robust_z": F.col("price_median_clean"),
        "sugars_robust_z": F.col("sugars_100g"),
        "salt_robust_z": F.col("salt_equivalent_100g"),
        "saturated_fat_robust_z": F.col("saturated_fat_100g"),
        "nutriscore_robust_z": F.col("nutriscore_score"),
        "nova_robust_z": F.col("nova_group").cast("double"),
        "data_completeness_robust_z": F.col("data_completeness_score"),
    }, keys, range_rows=limit)
    df = df.join(percentiles, on="code", how="left").join(ranked, on="code", how="left").withColumns({
        "health_score_composite": health, "price_nutrition_value_index": SC.value_index()})
    df = df.withColumn("peer_anomaly_score", SC.anomaly_score())
    df = df.withColumns(SC.flags())
    return df.select(*ANALYSIS_COLS)
