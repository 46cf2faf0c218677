"""Build the analysis-ready product table (``products_main``).

Order of work: filter (B10 plus the allow-lists, B11) -> one projection that
does all nested/array work right after the scan (C1-C8) -> scalar fallbacks
and the code map (C9-C12) -> keep-first per code (G7).  The two allow-lists
come from top-k tag counts over the filtered rows (G4): the only values that
reach the driver, k strings each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import nested as N
from larder.functions import predicates as P
from larder.functions import scalars as S
from larder.operators.audit import allow_lists
from larder.operators.dedup import keep_first

# The reference's country-tag -> ISO code map (11 entries).
COUNTRY_TAG_TO_CODE = {
    "en:france": "FR",
    "en:united-states": "US",
    "en:germany": "DE",
    "en:spain": "ES",
    "en:united-kingdom": "GB",
    "en:italy": "IT",
    "en:switzerland": "CH",
    "en:belgium": "BE",
    "en:netherlands": "NL",
    "en:canada": "CA",
    "en:poland": "PL",
}

# Nutrient entry names read into columns: output column -> entry name.
NUTRIENT_COLUMNS = {
    "fat_100g": "fat",
    "saturated_fat_100g": "saturated-fat",
    "carbohydrates_100g": "carbohydrates",
    "sugars_100g": "sugars",
    "proteins_100g": "proteins",
    "salt_100g": "salt",
    "sodium_100g": "sodium",
    "fiber_100g": "fiber",
}

VALUED = "_valued"

PRODUCTS_MAIN_COLS = [
    "code", "product_name", "brands", "brands_tags", "primary_brand_tag", "countries_tags",
    "categories_tags", "food_groups_tags", "analysis_country_tag", "analysis_category_tag",
    "ingredients_text", "nutriscore_grade", "nutriscore_score", "nova_group", "completeness",
    "labels_count", "quality_warning_count", "quality_error_count", "has_ingredients_text",
    "has_labels_tags", "scans_n", "unique_scans_n", "fat_100g", "saturated_fat_100g",
    "carbohydrates_100g", "sugars_100g", "proteins_100g", "salt_100g", "sodium_100g",
    "fiber_100g", "energy_kcal_100g", "energy_kj_100g", "analysis_country_code",
    "nutrition_fields_present_count",
]


@dataclass(frozen=True)
class ProductSpec:
    """Parameters of J1.  ``order_by`` defines "first" for the per-code
    dedup (the reference relies on file order, which Spark lacks); columns
    missing from the input are ignored, and with none left a hash of the
    output row decides."""
    country_col: str = "countries_tags"
    category_col: str = "categories_tags"
    top_countries: int = 10
    top_categories: int = 10
    exclude_countries: Sequence[str] = ("en:world",)
    exclude_categories: Sequence[str] = ()
    country_codes: Mapping[str, str] = field(default_factory=lambda: dict(COUNTRY_TAG_TO_CODE))
    order_by: Sequence[str] = ("src_seq",)


def select_allow_lists(raw: DataFrame, spec: ProductSpec = ProductSpec()) -> tuple[list[str], list[str]]:
    """G4 x 2: the top countries (exclusions applied) and top categories
    among rows that pass the product filter."""
    where = P.product_filter(raw.schema)
    lists = allow_lists(raw, {spec.country_col: (spec.top_countries, spec.exclude_countries),
                              spec.category_col: (spec.top_categories, spec.exclude_categories)}, where)
    return lists[spec.country_col], lists[spec.category_col]


def build_products(raw: DataFrame, countries: Sequence[str], categories: Sequence[str],
                   spec: ProductSpec = ProductSpec(), dedup: bool = True) -> DataFrame:
    """``products_main`` (34 columns, one row per code)."""
    cond = (P.product_filter(raw.schema)
            & P.any_in(spec.country_col, countries)
            & P.any_in(spec.category_col, categories))
    order_cols = [c for c in spec.order_by if c in raw.columns]
    extracted = raw.filter(cond).withColumn(VALUED, N.with_values("nutriments")).select(
        "code",
        N.first_text("product_name").alias("product_name"),
        "brands",
        "brands_tags",
        N.first_tag("brands_tags").alias("primary_brand_tag"),
        "countries_tags",
        "categories_tags",
        "food_groups_tags",
        N.first_match(spec.country_col, countries).alias("analysis_country_tag"),
        N.last_match(spec.category_col, categories).alias("analysis_category_tag"),
        N.first_text("ingredients_text").alias("ingredients_text"),
        "nutriscore_grade",
        S.as_double("nutriscore_score").alias("nutriscore_score"),
        S.as_int("nova_group").alias("nova_group"),
        S.as_double("completeness").alias("completeness"),
        N.size_or_zero("labels_tags").alias("labels_count"),
        N.size_or_zero("data_quality_warnings_tags").alias("quality_warning_count"),
        N.size_or_zero("data_quality_errors_tags").alias("quality_error_count"),
        S.flag(P.has_list("ingredients_text")).alias("has_ingredients_text"),
        S.flag(P.has_list("labels_tags")).alias("has_labels_tags"),
        S.as_int("scans_n").alias("scans_n"),
        S.as_int("unique_scans_n").alias("unique_scans_n"),
        N.named_value(VALUED, "energy-kcal").alias("_kcal"),
        N.named_value(VALUED, "energy-kj").alias("_kj"),
        N.named_value(VALUED, "energy").alias("_energy"),
        *[N.named_value(VALUED, name).alias(out) for out, name in NUTRIENT_COLUMNS.items()],
        *order_cols,
    )
    shaped = extracted.withColumns({
        "energy_kcal_100g": S.energy_kcal("_kcal", "_kj", "_energy"),
        "energy_kj_100g": S.energy_kj("_kcal", "_kj", "_energy"),
        "analysis_country_code": S.map_code("analysis_country_tag", spec.country_codes),
    }).withColumn("nutrition_fields_present_count", S.count_present([
        "energy_kcal_100g", "fat_100g", "saturated_fat_100g", "carbohydrates_100g",
        "sugars_100g", "proteins_100g", ("salt_100g", "sodium_100g"), "fiber_100g"]))
    if dedup:
        # without an order column, a hash of the whole output row is the
        # tie-break: deterministic whatever the file and partition order
        order = order_cols or [F.xxhash64(*PRODUCTS_MAIN_COLS)]
        shaped = keep_first(shaped, ["code"], order)
    return shaped.select(*PRODUCTS_MAIN_COLS)
