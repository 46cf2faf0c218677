"""Keep-first dedup and top-1 per group.

Rows of repeated keys meet ``groupBy(key).agg(min_by(row,
order))``: an aggregate, so each map task keeps one candidate per key before
the shuffle and a key holding a third of all rows sends one row per map task,
not all of them.  A ``row_number()`` window would sort every row of that key
in one task.

The order must be total for a deterministic result; the reference relies on
input order, which Spark does not have, so the caller names an explicit
order (``src_seq`` in the fixtures).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.sources.io import is_staged, stage

ROW = "_row"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _order_struct(order_by: Sequence[Column | str]) -> Column:
    return F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(order_by))])


def first_of_each(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The row of each key that sorts first, as one aggregate over all rows."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    return (df.groupBy(*keys).agg(F.min_by(payload, _order_struct(order_by)).alias(ROW))
            .select(f"{ROW}.*"))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """One row per key: the row that sorts first by ``order_by``
    (ascending; nulls first, as Spark orders structs).

    A pass over the keys alone finds the repeated ones.  Rows with a unique key
    go by untouched: neither sorted nor moved, where the repeated keys are few
    enough for Spark to broadcast them.  Only rows of repeated keys (and of null
    ones) meet the aggregate.  ``df`` is read three times, so one that isn't a
    written table is written first."""
    t = df if is_staged(df) else stage(df, "keyed")
    keys = list(keys)
    repeated = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*keys)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    unique = t.filter(~no_key).join(repeated, on=keys, how="left_anti")
    several = t.filter(~no_key).join(repeated, on=keys, how="left_semi").unionByName(t.filter(no_key))
    return unique.select(*df.columns).unionByName(first_of_each(several.select(*df.columns), keys, order_by))


def asc(col: str, nulls_last: bool = True) -> list[Column]:
    """Order components for ascending ``col`` (nulls last by default)."""
    c = F.col(col)
    return [c.isNull(), c] if nulls_last else [c]


def desc(col: str | Column, nulls_last: bool = True) -> list[Column]:
    """Order components for descending numeric ``col`` (cast booleans to int
    first)."""
    c = F.col(col) if isinstance(col, str) else col
    return [c.isNull(), -c] if nulls_last else [-c]


def top_one(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
            drop: Sequence[str] = ()) -> DataFrame:
    """The best row per key under ``order_by`` (built with :func:`asc` /
    :func:`desc` components), helper columns dropped."""
    return first_of_each(df, keys, order_by).drop(*drop)
