"""Filter ladder evaluation (B12, D3, E8) and the profile of one level.

The reference counts each level and then joins each level's rows with the
price codes: eight joins over the catalogue.  Here every level predicate is
evaluated once in a projection right after the scan (nested columns are not
carried any further), the narrow ``(code, level booleans)`` rows are flagged
by a single left join against the distinct price codes, and one aggregate
produces all counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import exact_mean, pct
from larder.operators.align import with_price_flag
from larder.operators.ranks import GROUP, group_median, value_counts

FLAG = "_has_price"


def ladder_counts(products: DataFrame, prices: DataFrame, levels: Mapping[str, Column],
                  product_key: str = "code", price_key: str = "product_code") -> DataFrame:
    """(position, level, count, pct, price_matched_count,
    price_matched_pct_total, price_matched_pct_filter)."""
    names = list(levels)
    narrow = products.select(product_key, *[F.coalesce(p, F.lit(False)).alias(n) for n, p in levels.items()])
    flagged = with_price_flag(narrow, prices, FLAG, product_key, price_key)
    row = flagged.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(n)).alias(f"{n}__n") for n in names],
        *[F.count_if(F.col(n) & F.col(FLAG)).alias(f"{n}__p") for n in names],
    )
    entries = [F.struct(F.lit(i).alias("position"), F.lit(n).alias("level"),
                        F.col(f"{n}__n").alias("count"), F.col(f"{n}__p").alias("price_matched_count"))
               for i, n in enumerate(names)]
    long = row.select("_total", F.inline(F.array(*entries)))
    return long.select(
        "position", "level", "count",
        pct("count", "_total", zero=0.0).alias("pct"),
        "price_matched_count",
        pct("price_matched_count", "_total", zero=0.0).alias("price_matched_pct_total"),
        pct("price_matched_count", "count", zero=0.0).alias("price_matched_pct_filter"),
    )


def level_profile(products: DataFrame, level: Column, range_rows: int | None = None) -> DataFrame:
    """Rows, distinct codes (null counted as a value), exact medians of
    nutriscore_score, nova_group and completeness, mean completeness."""
    rows = products.filter(level).select("code", "nutriscore_score", "nova_group", "completeness")
    basic = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_distinct("code") + F.max(F.col("code").isNull().cast("int"))).cast("long").alias("unique_codes"),
        exact_mean("completeness").alias("completeness_mean"),
    ).withColumn(GROUP, F.struct(F.lit(0).alias("all")))
    measures = {"nutriscore_score_median": "nutriscore_score", "nova_group_median": "nova_group",
                "completeness_median": "completeness"}
    entries = [F.struct(F.lit(out).alias("_m"), F.col(src).cast("double").alias("_v"))
               for out, src in measures.items()]
    long = rows.select(F.struct(F.lit(0).alias("all")).alias(GROUP), F.inline(F.array(*entries)))
    med = group_median(value_counts(long, "_v", by=[GROUP, "_m"]), "_v", by=[GROUP, "_m"],
                       range_rows=range_rows, out="median")
    wide = med.groupBy(GROUP).agg(*[F.max(F.when(F.col("_m") == F.lit(o), F.col("median"))).alias(o)
                                    for o in measures])
    return (basic.join(wide, on=GROUP, how="left")
            .select("rows", "unique_codes", *measures, "completeness_mean"))
