"""Data audits: coverage, profiles, value tops, join coverage.

The counts of a table are one ``agg`` over one scan (all fields in a single
pass), reshaped into a long table; profiles and join coverage take their own
scans.  Nothing is collected except the k tags of an allow-list.  Percentages use the exact rule
of :func:`larder.functions.scalars.pct`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from larder.functions.predicates import has_list, has_named_entry, present_flags
from larder.functions.scalars import pct
from larder.operators.ranks import describe, value_counts


def _unpivot(one_row: DataFrame, names: Sequence[str], name_col: str, value_col: str) -> DataFrame:
    """Turn a one-row frame with columns ``names`` into (name_col, value_col)."""
    return one_row.unpivot([], list(names), name_col, value_col)


def count_table(df: DataFrame, preds: Mapping[str, Column], name_col: str = "field",
                zero: float | None = None) -> DataFrame:
    """(name, present_rows, coverage_pct): one pass of ``count_if`` over all
    predicates, plus ``count(*)`` as the denominator."""
    if not preds:
        return df.sparkSession.createDataFrame([], f"{name_col} string, present_rows bigint, coverage_pct double")
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(p).alias(name) for name, p in preds.items()])
    long = row.unpivot(["_rows"], list(preds), name_col, "present_rows")
    return long.select(name_col, F.col("present_rows").cast("long").alias("present_rows"),
                       pct("present_rows", "_rows", zero=zero).alias("coverage_pct"))


def figures(df: DataFrame, groups: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """(rows, source, metric, present_rows): every predicate of every group
    counted by one aggregate over one scan, next to the number of rows."""
    entries = [F.struct(F.lit(source).alias("source"), F.lit(metric).alias("metric"),
                        F.count_if(p).alias("present_rows"))
               for source, preds in groups.items() for metric, p in preds.items()]
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*entries).alias("_figures"))
    return row.select("rows", F.inline("_figures"))


def field_coverage(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per field, rows where it is present (B2) and the share of rows;
    fields missing from the schema are skipped."""
    return count_table(df, present_flags(df.schema, fields), "field")


def named_entry_coverage(df: DataFrame, names: Sequence[str], col: str = "nutriments") -> DataFrame:
    """Per entry name, rows whose list has an element with that name."""
    return count_table(df, {n: has_named_entry(n, col) for n in names}, "nutrient")


def numeric_profile(df: DataFrame, columns: Sequence[str], qs: Mapping[str, float] | None = None,
                    range_rows: int | None = None) -> DataFrame:
    """(column, min, median, mean, p95, p99, max) per numeric column,
    quantiles by nearest rank, median interpolated; all exact.

    Columns are stacked long, and one frequency table gives every figure, so
    the data is scanned once."""
    qs = dict(qs or {"p95": 0.95, "p99": 0.99})
    cols = [c for c in columns if c in df.columns]
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in cols]
    freq = value_counts(df.select(F.inline(F.array(*entries))), "_v", by=["column"], mean=True)
    out = describe(freq, "_v", by=["column"], median="median", mean="mean", qs=qs, range_rows=range_rows)
    return out.select("column", "min", "median", "mean", *qs.keys(), "max")


def date_profile(df: DataFrame, column: str) -> DataFrame:
    """Min, max and non-null count of a date column."""
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"),
                  F.count(column).alias("present_rows"))


def _pair_builder(column: str, is_num: bool):
    """element -> struct(column, value as string, numeric sort key)."""
    def entry(v: Column) -> Column:
        num = v.cast("double") if is_num else F.lit(None).cast("double")
        return F.struct(F.lit(column).alias("column"), v.cast("string").alias("value"), num.alias("num"))
    return entry


def top_values_multi(df: DataFrame, specs: Mapping[str, tuple[int, Sequence[str]]],
                     explode: bool = False, keep_null: bool = False,
                     where: Column | None = None) -> DataFrame:
    """G1-G4 for several columns in **one scan**: ``specs`` maps a column to
    (limit, exclusions); the result is (column, value as string, count).

    Every row emits one (column, value) pair per element / column (an
    ``inline`` over the concatenated arrays), one partially aggregated count
    serves all columns, and the per-column cut is ``row_number() <= k``,
    which Spark evaluates as a group limit before and after the shuffle, so
    no task holds more than k candidates per column.  Ties are broken by the
    typed value (numbers numerically), nulls last."""
    src = df if where is None else df.filter(where)
    types = {f.name: f.dataType for f in src.schema.fields}
    pair = "struct<column:string,value:string,num:double>"
    arrays = []
    for c in specs:
        dt = types[c].elementType if explode else types[c]
        entry = _pair_builder(c, isinstance(dt, NumericType))
        if explode:
            arr = F.when(has_list(c), F.transform(F.col(c), entry))
        else:
            arr = F.array(entry(F.col(c)))
        arrays.append(F.coalesce(arr, F.array().cast(f"array<{pair}>")))
    pairs = src.select(F.inline(F.concat(*arrays) if len(arrays) > 1 else arrays[0]))
    if not keep_null:
        pairs = pairs.filter(F.col("value").isNotNull())
    for c, (_, excl) in specs.items():
        if excl:
            pairs = pairs.filter(~((F.col("column") == F.lit(c))
                                   & F.coalesce(F.col("value").isin(list(excl)), F.lit(False))))
    counts = pairs.groupBy("column", "value", "num").agg(F.count(F.lit(1)).alias("count"))
    order = Window.partitionBy("column").orderBy(
        F.col("count").desc(), F.col("num").asc_nulls_last(), F.col("value").asc_nulls_last())
    limit = None
    for c, (k, _) in specs.items():
        limit = (F.when(F.col("column") == F.lit(c), F.lit(k)) if limit is None
                 else limit.when(F.col("column") == F.lit(c), F.lit(k)))
    top_k = max(k for k, _ in specs.values())
    return (counts.withColumn("_rn", F.row_number().over(order))
            .filter(F.col("_rn") <= F.lit(top_k))
            .filter(F.col("_rn") <= limit)
            .select("column", "value", "count"))


def allow_lists(df: DataFrame, specs: Mapping[str, tuple[int, Sequence[str]]],
                where: Column | None = None) -> dict[str, list[str]]:
    """G4 for several list columns in one scan and one job: ``specs`` maps a
    column to (limit, exclusions); at most sum(limit) short strings reach
    the driver."""
    for limit, _ in specs.values():
        if limit > 10000:
            raise ValueError("allow-lists are literals in the plan; keep them small")
    rows = top_values_multi(df, specs, explode=True, where=where).collect()
    out: dict[str, list[tuple[int, str]]] = {c: [] for c in specs}
    for r in rows:
        out[r["column"]].append((-r["count"], r["value"]))
    return {c: [v for _, v in sorted(vals)] for c, vals in out.items()}


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, count) for every value, null kept as its own group."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def stack_metrics(frames: Sequence[DataFrame]) -> DataFrame:
    """H1: diagonal concat: union by name, missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def wide_from_metrics(long: DataFrame, names: Sequence[str], name_col: str = "metric",
                      value_col: str = "value") -> DataFrame:
    """Pivot a small (metric, value) table to one row with known names."""
    return long.agg(*[F.max(F.when(F.col(name_col) == F.lit(n), F.col(value_col))).alias(n)
                      for n in names])


def join_coverage(products: DataFrame, prices: DataFrame, product_key: str = "code",
                  price_key: str = "product_code") -> DataFrame:
    """E14 (D4, D5, H1): one row: unique product codes, unique price codes,
    matched unique codes, price rows with a code, matched price rows, and
    the two match percentages (null when the denominator is 0).

    Each table becomes one row per code by a partially aggregated count, so a
    code with a third of all price rows is one row per map task; the two key
    tables meet in one full join and one aggregate gives every figure."""
    def per_code(df: DataFrame, key: str, rows: str) -> DataFrame:
        return (df.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull())
                .groupBy("_key").agg(F.count(F.lit(1)).alias(rows)))

    both = per_code(products, product_key, "_n").join(per_code(prices, price_key, "_m"), on="_key", how="full")
    matched = F.col("_n").isNotNull() & F.col("_m").isNotNull()
    names = ["unique_price_product_codes", "matched_unique_product_codes",
             "price_rows_with_product_code", "matched_price_rows"]
    wide = both.agg(
        F.count("_n").alias("unique_product_codes"),
        F.count("_m").alias(names[0]),
        F.count_if(matched).alias(names[1]),
        F.sum("_m").alias(names[2]),
        F.sum(F.when(matched, F.col("_m"))).alias(names[3]),
    )
    for n in ["unique_product_codes", *names]:
        wide = wide.withColumn(n, F.coalesce(F.col(n), F.lit(0)).cast("long"))
    return wide.withColumns({
        "matched_unique_price_code_pct": pct("matched_unique_product_codes",
                                             "unique_price_product_codes", zero=None),
        "matched_price_rows_pct": pct("matched_price_rows", "price_rows_with_product_code", zero=None),
    })


def schema_profile(df: DataFrame) -> DataFrame:
    """A2 (re-aimed): one row per column with its Spark type, whether it is a
    list, the table's row count and the column's non-null count.

    The names and types are literals from the schema; the counts are one
    ``agg`` over the scan (an array of per-column structs, then ``inline``),
    so the data is read once whatever the number of columns."""
    entries = [F.struct(F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("type"),
                        F.lit(isinstance(f.dataType, ArrayType)).alias("is_list"),
                        F.lit(i).alias("position"),
                        F.count(F.col(f"`{f.name}`")).alias("non_null_rows"))
               for i, f in enumerate(df.schema.fields)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*entries).alias("_cols"))
    return row.select("rows", F.inline("_cols")).select(
        "column", "type", "is_list", "position", "rows", "non_null_rows")


def required_field_matrix(df: DataFrame, required: Mapping[str, Sequence[str]]) -> DataFrame:
    """A3: (group, field, present, present_rows) for a required-field spec
    against ``df``: whether the schema has the field and, if so, on how many
    rows it is non-null (null for an absent field).  One ``agg`` over the
    scan serves every field."""
    names = set(df.columns)
    entries = [F.struct(F.lit(g).alias("group"), F.lit(f).alias("field"),
                        F.lit(f in names).alias("present"),
                        (F.count(F.col(f"`{f}`")) if f in names
                         else F.lit(None).cast("long")).alias("present_rows"))
               for g, fs in required.items() for f in fs]
    return df.agg(F.array(*entries).alias("_spec")).select(F.inline("_spec"))
