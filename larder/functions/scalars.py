"""Scalar column arithmetic (C7-C25) with the reference's null rules.

Spark 4 runs in ANSI mode: division by zero and out-of-range list access
throw, and ``greatest``/``least`` skip nulls.  Each helper states the null
rule it implements instead of relying on a session flag.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def flag(pred: Column) -> Column:
    """A never-null boolean (null counts as false)."""
    return F.coalesce(pred, F.lit(False))


def as_double(col: ColumnOrName) -> Column:
    """Cast to double (``try_cast`` so that text never throws)."""
    return _c(col).try_cast("double")


def as_int(col: ColumnOrName) -> Column:
    return _c(col).try_cast("int")


# Fixed value: kilojoules per kilocalorie.
KJ_PER_KCAL = 4.184


def energy_kcal(kcal: ColumnOrName, kj: ColumnOrName, generic: ColumnOrName) -> Column:
    """Kcal, else kJ / 4.184, else generic / 4.184, else null."""
    return F.coalesce(_c(kcal), _c(kj) / F.lit(KJ_PER_KCAL), _c(generic) / F.lit(KJ_PER_KCAL))


def energy_kj(kcal: ColumnOrName, kj: ColumnOrName, generic: ColumnOrName) -> Column:
    """kJ, else kcal * 4.184, else generic, else null."""
    return F.coalesce(_c(kj), _c(kcal) * F.lit(KJ_PER_KCAL), _c(generic))


def map_code(col: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """C11: look a tag up in a small literal map; unmapped or null gives null.

    The map is a literal in the plan (no join); a mapping that grows with the
    data belongs in a dimension table joined with ``left``."""
    if not mapping:
        return F.lit(None).cast("string")
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    c = _c(col)
    return F.when(c.isNotNull(), F.try_element_at(m, c))


def count_present(cols: Sequence[ColumnOrName | Sequence[ColumnOrName]]) -> Column:
    """Number of non-null fields; a tuple entry counts once if any of
    its members is non-null (salt-or-sodium)."""
    terms = []
    for item in cols:
        if isinstance(item, (list, tuple)):
            present = F.lit(False)
            for sub in item:
                present = present | _c(sub).isNotNull()
        else:
            present = _c(item).isNotNull()
        terms.append(F.when(present, F.lit(1)).otherwise(F.lit(0)))
    total = F.lit(0)
    for t in terms:
        total = total + t
    return total.cast("int")


def fill_rate(count: ColumnOrName, slots: float = 8.0) -> Column:
    """Count / slots."""
    return _c(count) / F.lit(float(slots))


# Fixed value: salt equivalent of one gram of sodium.
SALT_PER_SODIUM = 2.5


def salt_equivalent(salt: ColumnOrName, sodium: ColumnOrName) -> Column:
    """C14: salt, else sodium * 2.5."""
    return F.when(_c(salt).isNotNull(), _c(salt)).otherwise(_c(sodium) * F.lit(SALT_PER_SODIUM))


def positive_or_null(col: ColumnOrName) -> Column:
    """The value when > 0, else null."""
    c = _c(col)
    return F.when(c.isNotNull() & (c > F.lit(0)), c)


def negate(col: ColumnOrName) -> Column:
    """Flip the direction of a score; null stays null."""
    return -_c(col)


def scaled_group(col: ColumnOrName, lo: float = 1.0, span: float = 3.0) -> Column:
    """C17: (x - lo) / span."""
    return (_c(col) - F.lit(lo)) / F.lit(span)


def positive_flag(col: ColumnOrName) -> Column:
    """Count > 0, null gives false."""
    return flag(_c(col) > F.lit(0))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """C20: num / den, null when den is 0 or null."""
    return F.try_divide(_c(num), _c(den))


def clip(col: ColumnOrName, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; null stays null (``greatest``/``least`` alone
    would turn null into a bound)."""
    c = _c(col)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def clip01(col: ColumnOrName) -> Column:
    return clip(col, 0.0, 1.0)


def abs_or_zero(col: ColumnOrName) -> Column:
    """|x|, null gives 0."""
    return F.coalesce(F.abs(_c(col)), F.lit(0.0))


def weighted_abs_sum(weights: Mapping[str, float]) -> Column:
    """C22 summed: sum of w * |x| with nulls as 0, in the given order."""
    total = None
    for name, w in weights.items():
        term = F.lit(float(w)) * abs_or_zero(name)
        total = term if total is None else total + term
    return total if total is not None else F.lit(0.0)


def pct(part: ColumnOrName, whole: ColumnOrName, zero: float | None = 0.0) -> Column:
    """Part / whole * 100 rounded to 2 decimals.

    The exact ratio is rounded in integer arithmetic, ties to the even
    hundredth (1 of 800 is 0.12, 1 of 32 is 3.12), so the result does not
    depend on how a binary double happens to round.  A zero or null whole
    gives ``zero`` (0.0 in two of the reference's scripts, None in the third).
    """
    p = _c(part).cast("long")
    w = _c(whole).cast("long")
    twice = p * F.lit(20000) + w
    up = int_div(twice, w * F.lit(2))
    tie_to_odd = (F.pmod(twice, w * F.lit(2)) == F.lit(0)) & (up % F.lit(2) == F.lit(1))
    r = F.when(w.isNotNull() & (w != F.lit(0)), (up - tie_to_odd.cast("long")) / F.lit(100.0))
    if zero is None:
        return r
    return F.coalesce(r, F.lit(float(zero)))


def int_div(a: Column, b: Column) -> Column:
    """Floor division of two non-negative longs (SQL ``div``).

    ``a - pmod(a, b)`` is an exact multiple of ``b``; the double quotient is
    within far less than 0.5 of that integer, so rounding recovers it."""
    return F.round((a - F.pmod(a, b)) / b).cast("long")


# Scale of the exact sums behind :func:`exact_mean` (values are rounded to
# this many decimals before summing).
MEAN_SCALE = 10


def exact_mean(col: ColumnOrName, scale: int = MEAN_SCALE) -> Column:
    """Mean of the non-null values as an exact decimal sum divided by the
    count.  A double ``avg`` depends on the order in which partitions are
    added; an exact sum does not, so the mean is the same for any
    partitioning, cluster size or engine."""
    x = _c(col).cast(f"decimal(38,{scale})")
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))
