"""Array and list-of-struct extraction.

All are built-ins evaluated in the projection right after the scan, so the
nested columns are read once and everything downstream is scalar.  Set
functions (``array_intersect``, ``array_except``) keep the first list's order,
so they find first and last elements inside whole-stage codegen; the only
lambda is :func:`with_values`, once per row.  ``get`` is used instead of
``arr[i]`` / ``element_at`` because those throw under ANSI mode on an empty
list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_values(col: ColumnOrName, value_field: str = "100g") -> Column:
    """The list's elements that have a value: one pass that every
    :func:`named_value` of a row shares when it is a column of its own."""
    return F.filter(_c(col), lambda e: e[value_field].isNotNull())


def named_value(valued: ColumnOrName, name: str, key_field: str = "name",
                value_field: str = "100g") -> Column:
    """``value_field`` of the first element whose ``key_field`` equals
    ``name``, as double; null when none.  ``valued`` is the list of
    :func:`with_values`, so the value is the first non-null one."""
    c = _c(valued)
    place = F.array_position(c[key_field], F.lit(name)).cast("int")
    return F.get(c[value_field], place - 1).cast("double")


def first_match(col: ColumnOrName, allowed: Sequence[str]) -> Column:
    """First list element (list order) that is in the allow-list."""
    if not allowed:
        return F.lit(None).cast("string")
    return F.get(F.array_intersect(_c(col), F.array(*map(F.lit, allowed))), 0)


def last_match(col: ColumnOrName, allowed: Sequence[str]) -> Column:
    """Last list element that is in the allow-list."""
    if not allowed:
        return F.lit(None).cast("string")
    return first_match(F.reverse(_c(col)), allowed)


def first_text(col: ColumnOrName, text_field: str = "text") -> Column:
    """C4: first non-null ``text`` of a list of {lang, text}, any language."""
    return first_tag(_c(col)[text_field])


def first_tag(col: ColumnOrName) -> Column:
    """First non-null element."""
    return F.get(F.array_except(_c(col), F.array(F.lit(None).cast("string"))), 0)


def size_or_zero(col: ColumnOrName) -> Column:
    """List length (null elements counted); null list gives 0."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c)).cast("int")
