"""Exact order statistics per group without whole-group buffers.

A peer group may hold a third of all rows, so nothing here puts the rows of a
whole group into one task.  Instead:

1. **Frequency table** ``(g, v, c, ...)``: one row per group and value, with
   its multiplicity and whatever else a caller carries per value (sums, first
   and last dates, flags).  Partial aggregation collapses repeated values
   before the shuffle, and the shuffle is keyed by the value as well, so a hot
   group spreads over many tasks.  Tables of several batches add up to the
   table of all of them (:func:`add_counts`).
2. **Running counts**: one exchange of the frequency table by group, sorted by
   value; windows give the number of smaller values and the group's total, and
   the statistics are an aggregate on the same partitioning.
3. A group with more than about ``RANGE_ROWS`` *distinct* values is cut into
   ranges of values at quantiles of a hashed share of its rows, its ranges are
   dealt to different tasks, and the counts of lower ranges come from a table
   with one row per range.  The cuts only balance the work: every count covers
   all rows and is exact wherever the cuts fall.

Groups are carried as one non-null struct column ``_g`` so that null keys
form a group of their own and joins stay plain equi-joins on one column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.scalars import MEAN_SCALE
from larder.sources.io import is_staged, rows_of, stage

GROUP = "_g"
RANGE = "_range"
CUTS = "_cuts"

#: Rows that a group may have before it is cut into ranges, and the number of
#: ranges that a group is cut into.
RANGE_ROWS = 1_000_000
RANGES = 256
#: The cuts are quantiles of one row in so many, but of SAMPLE_ROWS at least
#: where a group is just large enough to be cut.
SAMPLE_ROWS = 1024

#: name -> (aggregate over rows, function that merges it): what a frequency
#: table carries per value besides the multiplicity.
Carried = Mapping[str, tuple[Column, Callable[[str], Column]]]


def with_group(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the group struct ``_g`` (an empty struct-free constant when there
    are no keys, so that global statistics use the same code path)."""
    g = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    return df.withColumn(GROUP, g)


def group_columns(keys: Sequence[str]) -> list[Column]:
    """The key columns back from the group struct."""
    return [F.col(f"{GROUP}.{k}").alias(k) for k in keys]


def value_counts(df: DataFrame, value: str, by: Sequence[str] = (GROUP,), carry: Carried | None = None,
                 mean: bool = False) -> DataFrame:
    """(by..., value, c, ...): multiplicity of every value, nulls included;
    ``mean`` adds the exact sum ``_sum`` that a mean is cut from."""
    aggs = [F.count(F.lit(1)).alias("c")]
    v = F.col(value)
    if mean:
        aggs.append(F.sum(F.when(F.abs(v) >= F.lit(PRODUCT_BELOW), v.cast(f"decimal(38,{MEAN_SCALE})"))).alias("_sum"))
    aggs += [agg.alias(name) for name, (agg, _) in (carry or {}).items()]
    counts = df.groupBy(*by, value).agg(*aggs)
    return counts.withColumn("_sum", F.coalesce("_sum", times(v, F.col("c")))) if mean else counts


#: Values below it are summed as a product with their number, larger ones (and
#: what is no number) row by row.
PRODUCT_BELOW = 1e17


def times(value: Column, c: Column) -> Column:
    """The exact sum of ``c`` equal values: two products, of types that lose no
    digit, where ``c`` has ten digits or more."""
    billion, whole = F.lit(10**9), f"decimal(37,{MEAN_SCALE})"

    def product(n: Column) -> Column:
        return value.cast(f"decimal(28,{MEAN_SCALE})") * n.cast("decimal(9,0)")

    many = product(F.call_function("div", c, billion)).cast(f"decimal(27,{MEAN_SCALE})") * billion.cast("decimal(10,0)")
    return (F.when(c < billion, product(c))
            .otherwise(product(F.pmod(c, billion)).cast(whole) + many.cast(whole)).cast(f"decimal(38,{MEAN_SCALE})"))


def add_counts(tables: Sequence[DataFrame], value: str, by: Sequence[str] = (GROUP,),
               carry: Carried | None = None) -> DataFrame:
    """The frequency table of all rows from those of parts of them."""
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    sums = [F.sum(c).alias(c) for c in ("c", "_sum") if c in both.columns]
    return both.groupBy(*by, value).agg(*sums, *[merge(name).alias(name) for name, (_, merge) in (carry or {}).items()])


def written(freq: DataFrame) -> DataFrame:
    """A frequency table that is read several times is written once to the
    checkpoint folder, so that its source is scanned once."""
    return freq if is_staged(freq) else stage(freq, "freq", count=True)


def split_points(rows: DataFrame, value: str, by: Sequence[str], sample_by: Sequence[str],
                 range_rows: int | None = None, at_most: int | None = None) -> DataFrame | None:
    """(by..., _cuts): ascending cut values of the groups that have more than
    about ``range_rows`` rows; None if there is none.  ``sample_by`` tells the
    rows apart: the share that the cuts are taken from is drawn by its hash.
    ``at_most`` is a known bound of a group's rows, e.g. the table's."""
    range_rows = range_rows or RANGE_ROWS
    if at_most is not None and at_most <= range_rows:
        return None
    every = max(1, range_rows // SAMPLE_ROWS)
    share = rows.filter(F.col(value).isNotNull())
    if every > 1:
        share = share.filter(F.pmod(F.xxhash64(*sample_by), F.lit(every)) == 0)
    large = share.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * every > range_rows)
    if not large.limit(1).count():
        return None
    points = [k / RANGES for k in range(1, RANGES)]
    return stage(share.join(large, on=list(by), how="left_semi").groupBy(*by)
                 .agg(F.percentile_approx(value, F.array(*map(F.lit, points)), F.lit(10 * RANGES)).alias(CUTS)), "cuts")


def cuts_below(value: str) -> Column:
    """How many of the group's cuts are below the value; 0 without cuts."""
    below = F.size(F.filter(F.col(CUTS), lambda c: c < F.col(value)))
    return F.when(F.col(CUTS).isNotNull() & F.col(value).isNotNull(), below).otherwise(F.lit(0))


def range_offsets(counts: DataFrame, by: Sequence[str], total: str) -> DataFrame:
    """(by..., _range, _lower, _all) from the totals of the ranges of the
    groups that were cut: one row per range, at most 2 x RANGES of a group."""
    lower = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*by, RANGE, F.coalesce(F.sum(total).over(lower), F.lit(0)).alias("_lower"),
                         F.sum(total).over(Window.partitionBy(*by)).alias("_all"))


def running_counts(t: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """``t`` with ``below``, the total ``c`` of the rows before it in order of
    the value, and ``n``, the total of the non-null values: two frames of one
    window."""
    ordered = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_last())
    smaller = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = F.when(F.col(value).isNotNull(), F.col("c")).otherwise(F.lit(0))
    return t.withColumns({"below": F.coalesce(F.sum("c").over(smaller), F.lit(0)), "n": F.sum(counted).over(whole)})


def prefix_counts(freq: DataFrame, value: str, by: Sequence[str] = (GROUP,),
                  range_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Add ``below``, the total ``c`` of the strictly smaller values of the
    same ``by`` group, and ``n``, the group's total of non-null values; and
    tell whether a group was cut.  ``freq`` must hold one row per (by, value).
    Without a cut the result is partitioned by ``by``."""
    by = list(by)
    t = written(freq)
    cuts = split_points(t, value, by, [*by, value], range_rows, at_most=rows_of(t))
    part = by
    if cuts is not None:
        part = [*by, RANGE]
        t = t.join(cuts, on=by, how="left").withColumn(RANGE, cuts_below(value))
        totals = (t.filter(F.col(CUTS).isNotNull()).groupBy(*part)
                  .agg(F.sum(F.when(F.col(value).isNotNull(), F.col("c")).otherwise(F.lit(0))).alias("_total")))
        offsets = range_offsets(totals, by, "_total")
    t = running_counts(t, value, part)
    if cuts is not None:
        t = (t.join(offsets, on=part, how="left")
             .withColumns({"below": F.col("below") + F.coalesce("_lower", F.lit(0)), "n": F.coalesce("_all", "n")})
             .drop(CUTS, RANGE, "_lower", "_all"))
    return t, cuts is not None


def _at(position: Column, value: Column, before: str = "below") -> Column:
    """The value at a 1-based position: an aggregate over a group's rows."""
    return F.max(F.when((F.col(before) < position) & (position <= F.col(before) + F.col("c")), value))


def _median(value: Column, over: Callable[[Column], Column] = lambda c: c, before: str = "below") -> Column:
    """Median of a group's rows; same interpolation as Spark's
    percentile(x, 0.5): 0.5*lo + 0.5*hi."""
    n = F.col("n")
    # 1-based middle positions; equal when n is odd
    lo, hi = (over(_at(p, value, before)).cast("double") for p in (F.floor((n + 1) / 2), F.floor(n / 2) + 1))
    return F.when(lo == hi, lo).otherwise(F.lit(0.5) * lo + F.lit(0.5) * hi)


def describe(freq: DataFrame, value: str, by: Sequence[str] = (GROUP,), median: str | None = None,
             mean: str | None = None, qs: Mapping[str, float] | None = None, carry: Carried | None = None,
             range_rows: int | None = None) -> DataFrame:
    """(by..., n, min, max, ...): per group the non-null values' number,
    least and largest, optionally the exact interpolated median, the exact
    mean (``freq`` needs ``_sum``), nearest-rank quantiles (the value at
    0-based sorted index ``floor((n - 1) * q + 0.5)``) and the carried
    aggregates, all from one frequency table."""
    pref, _ = prefix_counts(freq, value, by, range_rows)
    return _figures(pref, value, by, median, mean, qs, carry)


def _figures(pref: DataFrame, value: str, by: Sequence[str], median: str | None, mean: str | None,
             qs: Mapping[str, float] | None, carry: Carried | None) -> DataFrame:
    """The figures of :func:`describe` from running counts."""
    v, n = F.col(value), F.col("n")
    aggs = [F.max("n").alias("n"), F.min(value).alias("min"), F.max(value).alias("max")]
    if median:
        aggs.append(_median(v).alias(median))
    if mean:
        aggs.append(F.try_divide(F.sum("_sum").cast("double"), F.max("n").cast("double")).alias(mean))
    for name, q in (qs or {}).items():
        aggs.append(_at(F.floor((n - 1) * F.lit(float(q)) + F.lit(0.5)) + 1, v).alias(name))
    return pref.groupBy(*by).agg(*aggs, *[merge(name).alias(name) for name, (_, merge) in (carry or {}).items()])


def describe_rows(rows: DataFrame, value: str, by: Sequence[str], near: Sequence[str], median: str | None = None,
                  mean: str | None = None, carry: Mapping[str, tuple[str, Callable[[str], Column]]] | None = None
                  ) -> DataFrame:
    """:func:`describe` of rows instead of a frequency table, for groups that
    :func:`split_points` found to be of a bounded size: one exchange by
    ``near`` (some of the keys ``by``), no table written, and the result is
    partitioned by ``near``.  ``carry`` names the column that each carried
    aggregate merges."""
    carried = (carry or {}).items()
    ones = (rows.select(*by, value, *[F.col(c).alias(name) for name, (c, _) in carried]).repartition(*near)
            .withColumn("c", F.lit(1).cast("long")))
    if mean:
        ones = ones.withColumn("_sum", F.col(value).cast(f"decimal(38,{MEAN_SCALE})"))
    # the keys last named come first after ``near``: those that tell rows of one
    # ``near`` apart end most of the sort's comparisons
    sort_keys = [*near, *[k for k in reversed(by) if k not in near]]
    return _figures(running_counts(ones, value, sort_keys), value, sort_keys, median, mean, None,
                    {name: (F.col(c), merge) for name, (c, merge) in carried})


def group_median(freq: DataFrame, value: str, by: Sequence[str] = (GROUP,),
                 range_rows: int | None = None, out: str = "median") -> DataFrame:
    """Exact median of each group from its frequency table -> (by..., out)."""
    return describe(freq, value, by, median=out, range_rows=range_rows).select(*by, out)


def nearest_rank(freq: DataFrame, value: str, qs: Mapping[str, float],
                 by: Sequence[str] = (GROUP,), range_rows: int | None = None,
                 median: str | None = None) -> DataFrame:
    """Nearest-rank quantiles per group, optionally also the median."""
    out = describe(freq, value, by, median=median, qs=qs, range_rows=range_rows)
    return out.select(*by, *qs, *([median] if median else []))


def median_and_mad(freq: DataFrame, value: str, by: Sequence[str] = (GROUP,),
                   range_rows: int | None = None) -> DataFrame:
    """(by..., median, mad): exact median and median absolute deviation
    (no consistency factor) per group.

    Both come from one table and one exchange: the median is a window over the
    group's running counts, and a second running count, in the order of the
    distance from it, counts on both sides of the median at once.  Only if some
    group was cut into ranges, the distances get a frequency table of their
    own."""
    by = list(by)
    freq = written(freq)
    pref, cut = prefix_counts(freq, value, by, range_rows)
    if cut:
        med = stage(pref.groupBy(*by).agg(_median(F.col(value)).alias("median")), "medians")
        far = (freq.join(med, on=by, how="inner")
               .select(*by, F.abs(F.col(value) - F.col("median")).alias("_far"), "c")
               .groupBy(*by, "_far").agg(F.sum("c").alias("c")))
        return med.join(group_median(far, "_far", by, range_rows, out="mad"), on=by, how="inner")
    whole = Window.partitionBy(*by)
    nearer = whole.orderBy(F.col("_far").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = pref.withColumn("median", _median(F.col(value), lambda c: c.over(whole)))
    t = t.withColumn("_far", F.abs(F.col(value) - F.col("median")))
    t = t.withColumn("_nearer", F.coalesce(F.sum("c").over(nearer), F.lit(0)))
    return t.groupBy(*by).agg(F.max("median").alias("median"), _median(F.col("_far"), before="_nearer").alias("mad"))
