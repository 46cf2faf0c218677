"""Boolean column builders (filters and presence tests).

Everything here returns a ``Column`` of built-in expressions without lambdas,
so it stays inside whole-stage codegen, and predicate pushdown applies
wherever Spark can push the expression (scalar null tests and comparisons).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(and_, preds) if preds else F.lit(True)


def any_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(or_, preds) if preds else F.lit(False)


def has_list(col: ColumnOrName) -> Column:
    """B1: the list is non-null and non-empty (null when the list is null is
    avoided: the result is false)."""
    c = _c(col)
    return c.isNotNull() & (F.coalesce(F.size(c), F.lit(0)) > 0)


def has_present(name: str, schema: StructType) -> Column:
    """B2: presence dispatched on the column's type: lists must be non-empty,
    everything else (including the empty string) only non-null."""
    if isinstance(schema[name].dataType, ArrayType):
        return has_list(name)
    return F.col(name).isNotNull()


def has_named_entry(name: str, col: ColumnOrName = "nutriments",
                    key_field: str = "name") -> Column:
    """Some struct element has ``key_field == name`` (its value may be
    null); false on a null or empty list."""
    return F.coalesce(F.array_contains(_c(col)[key_field], F.lit(name)), F.lit(False))


def any_in(col: ColumnOrName, allowed: Sequence[str]) -> Column:
    """Some list element is in the allow-list; false on null/empty lists.

    The allow-list is a bounded literal (it comes from a top-k), so this is a
    per-row array test, not a join."""
    if not allowed:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(_c(col), F.array(*map(F.lit, allowed))), F.lit(False))


def is_in(col: ColumnOrName, values: Sequence) -> Column:
    """Scalar in-list (null stays null, and a filter drops it)."""
    return _c(col).isin(list(values))


def not_in(col: ColumnOrName, values: Sequence) -> Column:
    """Exclusion list; an empty list excludes nothing."""
    if not values:
        return F.lit(True)
    return ~_c(col).isin(list(values))


def same_market(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Plain equality; null when either side is null."""
    return _c(left) == _c(right)


# Valid Nutri-Score grades and NOVA groups.
VALID_GRADES = ["a", "b", "c", "d", "e"]
VALID_NOVA = [1, 2, 3, 4]


def product_predicates(schema: StructType) -> dict[str, Column]:
    """Named product predicates (B7-B9, B16 and the parts of B10/B12)."""
    return {
        "has_code": F.col("code").isNotNull(),
        "has_name": has_present("product_name", schema),
        "has_country": has_list("countries_tags"),
        "has_category": has_list("categories_tags"),
        "has_brand": has_present("brands", schema) | has_list("brands_tags"),
        "has_nutriments": has_list("nutriments"),
        "has_energy": any_of(has_named_entry(n) for n in ("energy-kcal", "energy-kj", "energy")),
        "has_fat": has_named_entry("fat"),
        "has_satfat": has_named_entry("saturated-fat"),
        "has_carbs": has_named_entry("carbohydrates"),
        "has_sugars": has_named_entry("sugars"),
        "has_proteins": has_named_entry("proteins"),
        "has_salt": has_named_entry("salt") | has_named_entry("sodium"),
        "valid_nutriscore": F.col("nutriscore_score").isNotNull() | is_in("nutriscore_grade", VALID_GRADES),
        "valid_nova": is_in("nova_group", VALID_NOVA),
        # Empty warning list is allowed here, only null is not
        "quality_ready": F.col("completeness").isNotNull() & F.col("data_quality_warnings_tags").isNotNull(),
        # B8
        "high_complete": F.coalesce(F.col("completeness"), F.lit(0.0)) >= F.lit(0.5),
    }


def product_filter(schema: StructType) -> Column:
    """The analysis-ready product filter (AND of 16 predicates)."""
    p = product_predicates(schema)
    return all_of(p[k] for k in (
        "has_code", "has_name", "has_country", "has_category", "has_brand",
        "has_energy", "has_fat", "has_satfat", "has_carbs", "has_sugars",
        "has_proteins", "has_salt", "valid_nutriscore", "valid_nova",
        "quality_ready", "high_complete"))


def filter_ladder(schema: StructType) -> dict[str, Column]:
    """Eight named cumulative levels, in order."""
    p = product_predicates(schema)
    base = p["has_code"] & p["has_name"] & p["has_country"] & p["has_category"]
    core = base & p["has_energy"] & p["has_fat"] & p["has_sugars"] & p["has_salt"] & p["has_proteins"]
    full = core & p["valid_nutriscore"] & p["valid_nova"]
    brand = full & p["has_brand"]
    strict = brand & p["quality_ready"] & p["high_complete"]
    return {
        "base_identity_geo_category": base,
        "base_with_any_nutriments": base & p["has_nutriments"],
        "core_nutrition_ready": core,
        "broad_health_ready": core & (p["valid_nutriscore"] | p["valid_nova"]),
        "full_health_ready": full,
        "brand_full_health_ready": brand,
        "strict_quality_ready": strict,
        "full_nutrient_detail_ready": strict & p["has_satfat"] & p["has_carbs"],
    }


def product_usability(schema: StructType) -> dict[str, Column]:
    """Derived-quality predicates of the catalogue audit."""
    grade = is_in("nutriscore_grade", VALID_GRADES)
    country_category = has_list("countries_tags") & has_list("categories_tags")
    return {
        "valid_nutriscore_grade_a_to_e": grade,
        "usable_nutrition_score": grade | F.col("nutriscore_score").isNotNull(),
        "has_country_and_category": country_category,
        "has_country_category_and_brand": country_category & (
            F.col("brands").isNotNull() | has_list("brands_tags")),
        "completeness_at_least_0_5": F.col("completeness") >= F.lit(0.5),
    }


def price_readiness() -> dict[str, Column]:
    """Derived-quality predicates of the price audit."""
    pos = F.col("price") > F.lit(0)
    ready = (pos & F.col("currency").isNotNull() & F.col("date").isNotNull()
             & F.col("location_osm_lat").isNotNull() & F.col("location_osm_lon").isNotNull())
    return {
        "positive_price": pos,
        "price_currency_date_geo_ready": ready,
        "barcode_price_ready": ready & F.col("product_code").isNotNull(),
    }


def present_flags(schema: StructType, fields: Sequence[str]) -> Mapping[str, Column]:
    """B2 over a field list; fields absent from the schema are skipped."""
    return {f: has_present(f, schema) for f in fields if f in schema.fieldNames()}
