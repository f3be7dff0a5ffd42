"""Arithmetic with the null and rounding rules of the source reports.

Money stays DECIMAL through every step; values leave the library as DOUBLE.
Two division flavours exist because the reports mix two languages:

* SQL division (``sql_div``): x / 0 or x / NULL is NULL.
* Measure division (``divide``): ``DIVIDE(a, b, alt)`` gives ``alt`` when b
  is NULL or 0, otherwise a / b (a NULL numerator stays NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale at which ratio quotients are fixed before a final ROUND, so that the
# rounding step sees the same digits whatever the engine's division type.
RATIO_TYPE = "decimal(38,10)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_div(a: Column | str, b: Column | str) -> Column:
    """SQL division: NULL on a zero or NULL divisor (never raises)."""
    return F.try_divide(_col(a), _col(b))


def round_ratio(ratio: Column, digits: int) -> Column:
    """ROUND(ratio, digits) after fixing the quotient at 10 decimals."""
    return F.round(ratio.cast(RATIO_TYPE), digits)


def divide(a: Column | str, b: Column | str, alternate: float | int | None = 0) -> Column:
    """Measure division ``DIVIDE(a, b, alternate)`` evaluated in DOUBLE."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    return F.when(b.isNull() | (b == 0), F.lit(alternate).cast("double")).otherwise(a / b)


def blank_sub(a: Column | str, b: Column | str) -> Column:
    """Measure subtraction: BLANK when both sides are BLANK, else BLANK acts as 0."""
    a, b = _col(a), _col(b)
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def blank_add(*cols: Column | str) -> Column:
    """Measure addition: BLANK when every term is BLANK, else BLANK terms act as 0."""
    cs = [_col(c) for c in cols]
    total = F.coalesce(cs[0], F.lit(0))
    for c in cs[1:]:
        total = total + F.coalesce(c, F.lit(0))
    all_blank = cs[0].isNull()
    for c in cs[1:]:
        all_blank = all_blank & c.isNull()
    return F.when(all_blank, F.lit(None)).otherwise(total)


def money(c: Column | str, precision: int = 20) -> Column:
    """Round to cents and fix the money type DECIMAL(precision, 2)."""
    return F.round(_col(c), 2).cast(f"decimal({precision},2)")


def to_double(c: Column | str) -> Column:
    return _col(c).cast("double")
