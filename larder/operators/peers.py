"""Peer-group statistics: average-rank percentiles and robust z-scores (F1-F8).

Measures are stacked long ``(id, group, measure, value)``, ranked by windows
after one exchange, and pivoted back by ``id``.  A large peer group is cut into
ranges of values, so no task ever holds a third of all rows.  Robust z
needs only per-group medians and MADs, which come from frequency tables and are
small (groups x measures), joined back by the group key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.scalars import safe_div
from larder.operators.ranks import (CUTS, GROUP, RANGE, cuts_below, median_and_mad, range_offsets, split_points,
                                    value_counts, with_group)
from larder.sources.io import rows_of, stage

MEASURE = "_m"
VALUE = "_v"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


MeasureSpec = Column | str | tuple[Column | str, Sequence[str]]


def _split_spec(measures: Mapping[str, MeasureSpec], keys: Sequence[str]) -> dict[str, tuple[Column, list[str]]]:
    """Normalise measures to name -> (expression, peer keys); a bare
    expression uses the default ``keys``."""
    out = {}
    for name, spec in measures.items():
        if isinstance(spec, tuple):
            expr, own = spec
            out[name] = (_c(expr), list(own))
        else:
            out[name] = (_c(spec), list(keys))
    return out


def _stack(df: DataFrame, id_col: str, measures: Mapping[str, tuple[Column, list[str]]]) -> DataFrame:
    """(id, _g, _m, _v) with one row per input row and measure, whose place in
    ``measures`` is ``_m``.

    ``_g`` is a struct over the union of all measures' key columns in which
    the keys a measure does not use are null; since ``_m`` is part of every
    grouping, measures with different peer keys share one pass."""
    union: list[str] = []
    for _, ks in measures.values():
        union += [k for k in ks if k not in union]
    types = {f.name: f.dataType for f in df.schema.fields}

    def group_of(ks: list[str]) -> Column:
        if not union:
            return F.struct(F.lit(0).alias("all"))
        return F.struct(*[(F.col(k) if k in ks else F.lit(None).cast(types[k])).alias(k) for k in union])

    entries = [F.struct(F.lit(m).alias(MEASURE), group_of(ks).alias(GROUP),
                        expr.cast("double").alias(VALUE))
               for m, (expr, ks) in enumerate(measures.values())]
    return df.select(id_col, F.inline(F.array(*entries)))


def peer_percentiles(df: DataFrame, measures: Mapping[str, MeasureSpec], keys: Sequence[str],
                     id_col: str = "code", range_rows: int | None = None) -> DataFrame:
    """add one column per measure holding the average rank of
    the row's value among the non-null values of its peer group divided by
    the number of *all* rows in the group (nulls included); null values get
    null.  A measure given as ``(expr, keys)`` uses its own peer keys (F3),
    in the same pass.  ``id_col`` must be unique per row."""
    return df.join(percentile_table(df, measures, keys, id_col, range_rows), on=id_col, how="left")


def percentile_table(df: DataFrame, measures: Mapping[str, MeasureSpec], keys: Sequence[str],
                     id_col: str = "code", range_rows: int | None = None) -> DataFrame:
    """What :func:`peer_percentiles` adds, alone: one row per ``id_col`` with
    one column per measure."""
    spec = _split_spec(measures, keys)
    ranked = _ranked(_stack(df, id_col, spec), id_col, range_rows, at_most=rows_of(df))
    return ranked.groupBy(id_col).agg(
        *[F.max(F.when(F.col(MEASURE) == F.lit(m), F.col("_pct"))).alias(name) for m, name in enumerate(spec)])


# Tasks that the rows of one very frequent value (or the nulls) of a group
# that was cut are dealt to.
SALTS = 256


def _ranked(long: DataFrame, id_col: str, range_rows: int | None, at_most: int | None = None) -> DataFrame:
    """(id, _m, _pct) of stacked rows, which are ranked where they lie: one
    exchange by group and measure, sorted by value, and three frames of one
    window on it (smaller rows, rows up to the equal ones, all rows).

    A group with more than about ``ranks.RANGE_ROWS`` rows is cut into ranges
    of values that go to different tasks.  A value that spans several cuts is a
    range of its own: its rows all have one rank, which the ranges' totals
    tell, so they (and the nulls) are salted and no task holds them all."""
    by = [GROUP, MEASURE]
    cuts = split_points(long, VALUE, by, [id_col, MEASURE], range_rows, at_most)
    v = F.col(VALUE)
    part = by
    if cuts is not None:
        part = [*by, RANGE, "_salt"]
        below = cuts_below(VALUE)
        frequent = F.coalesce(F.size(F.filter(F.col(CUTS), lambda c: c == v)) > 1, F.lit(False))
        cut, alone = F.col(CUTS).isNotNull(), F.col("_alone")
        long = (long.join(cuts, on=by, how="left").withColumn("_alone", cut & frequent)
                .withColumn(RANGE, F.when(cut & v.isNull(), F.lit(-1)).otherwise(2 * below + alone.cast("int")))
                .withColumn("_salt", F.when(cut & (v.isNull() | alone), F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
                            .otherwise(F.lit(0))))
        totals = long.filter(cut).groupBy(*by, RANGE).agg(F.count(F.lit(1)).alias("_total"))
        nulls = F.when(F.col(RANGE) < 0, F.col("_total")).otherwise(F.lit(0))
        offsets = stage(range_offsets(totals, by, "_total").join(totals, on=[*by, RANGE])
                        .withColumn("_lower", F.col("_lower") - F.sum(nulls).over(Window.partitionBy(*by))), "offsets")
        long = long.drop(CUTS)
    ordered = Window.partitionBy(*part).orderBy(v.asc_nulls_last())
    one = F.count(F.lit(1))
    ranked = long.withColumns({
        "_below": F.rank().over(ordered) - F.lit(1),
        "_upto": one.over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        "_n": one.over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    }).withColumn("_c", F.col("_upto") - F.col("_below"))
    if cuts is not None:
        ranked = ranked.join(offsets, on=[*by, RANGE], how="left").withColumns({
            "_below": F.coalesce("_lower", F.lit(0)) + F.when(F.col("_alone"), F.lit(0)).otherwise(F.col("_below")),
            "_c": F.when(F.col("_alone"), F.col("_total")).otherwise(F.col("_c")),
            "_n": F.coalesce("_all", "_n")})
    pct = (F.col("_below") + (F.col("_c") + F.lit(1)) / F.lit(2.0)) / F.col("_n")
    return ranked.select(id_col, MEASURE, F.when(v.isNotNull(), pct).alias("_pct"))


def group_median_mad(df: DataFrame, measures: Mapping[str, Column | str], keys: Sequence[str],
                     range_rows: int | None = None) -> DataFrame:
    """one row per peer group with ``<m>__median`` and ``<m>__mad``
    for every measure (exact, from frequency tables)."""
    long = _stack(df.withColumn("_id", F.lit(0)), "_id", _split_spec(measures, keys))
    freq = value_counts(long, VALUE, by=[GROUP, MEASURE])
    stats = median_and_mad(freq, VALUE, by=[GROUP, MEASURE], range_rows=range_rows)
    return stats.groupBy(GROUP).agg(*[
        agg for m, name in enumerate(measures) for agg in (
            F.max(F.when(F.col(MEASURE) == F.lit(m), F.col("median"))).alias(f"{name}__median"),
            F.max(F.when(F.col(MEASURE) == F.lit(m), F.col("mad"))).alias(f"{name}__mad"))])


# Fixed value: the stabiliser added to the MAD before dividing.
MAD_EPSILON = 1e-6


def robust_z(df: DataFrame, measures: Mapping[str, Column | str], keys: Sequence[str],
             range_rows: int | None = None,
             mad_floor: float | None = None, z_cap: float | None = None) -> DataFrame:
    """``(x - median) / (MAD + 1e-6)`` per peer group, null only when
    x is null (or the whole group is null).  ``mad_floor`` / ``z_cap`` are
    opt-in guards against zero-MAD groups; the defaults keep the
    reference's behaviour."""
    keys = list(keys)
    stats = group_median_mad(df, measures, keys, range_rows)
    joined = with_group(df, keys).join(stats, on=GROUP, how="left")
    cols = {name: _z(_c(expr).cast("double"), F.col(f"{name}__median"), F.col(f"{name}__mad"),
                     mad_floor, z_cap)
            for name, expr in measures.items()}
    drop = [GROUP] + [f"{n}__{s}" for n in measures for s in ("median", "mad")]
    return joined.withColumns(cols).drop(*drop)


def _z(x: Column, median: Column, mad: Column, mad_floor, z_cap) -> Column:
    if mad_floor is not None:
        mad = F.greatest(mad, F.lit(float(mad_floor)))
    z = safe_div(x - median, mad + F.lit(MAD_EPSILON))
    if z_cap is not None:
        z = F.when(z.isNotNull(), F.least(F.greatest(z, F.lit(-float(z_cap))), F.lit(float(z_cap))))
    return z
