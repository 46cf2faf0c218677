"""Composite scores, value index, anomaly score and flags.

Pure column arithmetic on one row; the weights are the reference's and are
kept together here as fixed values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.scalars import clip, clip01, weighted_abs_sum

# Health score weights (I1), in formula order.
HEALTH_WEIGHTS = {
    "nutriscore_good_percentile": 0.45,
    "nova_good_percentile": 0.25,
    "sugars_good_percentile": 0.15,
    "salt_good_percentile": 0.10,
    "proteins_good_percentile": 0.05,
}

# Anomaly score weights (I4), in formula order.
ANOMALY_WEIGHTS = {
    "price_robust_z": 0.20,
    "sugars_robust_z": 0.20,
    "salt_robust_z": 0.15,
    "saturated_fat_robust_z": 0.15,
    "nutriscore_robust_z": 0.10,
    "nova_robust_z": 0.10,
    "data_completeness_robust_z": 0.10,
}


def weighted_score(weights: Mapping[str, float], nulls: str = "propagate") -> Column:
    """Sum of w * x in the given order.  ``nulls="propagate"`` makes the
    score null when any part is null (the reference's I1); ``"zero"`` treats
    a null part as 0."""
    total = None
    for name, w in weights.items():
        x = F.col(name) if nulls == "propagate" else F.coalesce(F.col(name), F.lit(0.0))
        term = F.lit(float(w)) * x
        total = term if total is None else total + term
    return total


def health_score(weights: Mapping[str, float] = HEALTH_WEIGHTS) -> Column:
    """clip01 of the weighted percentile sum; null if any part is null."""
    return clip01(weighted_score(weights))


def completeness_score() -> Column:
    """clip01(.50 completeness + .15 fill rate + .10 has_ingredients
    + .05 has_labels - .12 clip(warnings,0,5)/5 - .08 clip(errors,0,3)/3)."""
    s = (F.lit(0.50) * F.col("completeness")
         + F.lit(0.15) * F.col("nutrient_field_fill_rate")
         + F.lit(0.10) * F.col("has_ingredients_text").cast("double")
         + F.lit(0.05) * F.col("has_labels_tags").cast("double")
         - F.lit(0.12) * clip("quality_warning_count", 0, 5) / F.lit(5.0)
         - F.lit(0.08) * clip("quality_error_count", 0, 3) / F.lit(3.0))
    return clip01(s)


def value_index(health_pct: str = "health_score_percentile",
                price_pct: str = "price_median_percentile") -> Column:
    """Health percentile minus price percentile."""
    return F.col(health_pct) - F.col(price_pct)


def anomaly_score(weights: Mapping[str, float] = ANOMALY_WEIGHTS) -> Column:
    """I4: sum of w * |z| with null z counted as 0."""
    return weighted_abs_sum(weights)


def flags() -> dict[str, Column]:
    """I5-I7 (three-valued AND, as in the reference)."""
    return {
        "flag_high_price_low_health": (F.col("has_price")
                                       & (F.col("price_median_percentile") > F.lit(0.75))
                                       & (F.col("health_score_percentile") < F.lit(0.25))),
        "flag_high_sugar_high_nova": ((F.col("sugars_percentile") > F.lit(0.80))
                                      & (F.col("nova_group") >= F.lit(4))),
        "flag_low_completeness_many_warnings": ((F.col("data_completeness_percentile") < F.lit(0.20))
                                                & (F.col("quality_warning_count") >= F.lit(2))),
    }
