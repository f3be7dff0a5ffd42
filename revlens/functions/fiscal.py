"""Fiscal calendar expressions (September-start fiscal year by default).

Fiscal year N runs from month ``start_month`` of calendar year N-1 to the
month before it in year N, so with ``start_month=9`` Aug 31 2020 is FY2020
and Sep 1 2020 is FY2021. All helpers are plain Catalyst expressions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.fixed_values import FY_START_MONTH  # noqa: F401  (re-exported)


def _shift(start_month: int) -> int:
    if not 1 <= start_month <= 12:
        raise ValueError(f"start month must be 1..12, got {start_month}")
    # months to add so that the fiscal year's first month lands in January
    return (13 - start_month) % 12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_year(date: Column | str, start_month: int = FY_START_MONTH) -> Column:
    """Fiscal year of a date or timestamp column, as INT."""
    return F.year(F.add_months(F.to_date(_col(date)), _shift(start_month))).cast("int")


def fiscal_quarter(date: Column | str, start_month: int = FY_START_MONTH) -> Column:
    """Fiscal quarter 1..4 (Q1 = the first three fiscal months), as INT."""
    return F.quarter(F.add_months(F.to_date(_col(date)), _shift(start_month))).cast("int")


def fiscal_year_bounds(fy: int, start_month: int = FY_START_MONTH) -> tuple[_dt.date, _dt.date]:
    """First day of the fiscal year and first day of the next one."""
    shift = _shift(start_month)
    if shift == 0:
        return _dt.date(fy, 1, 1), _dt.date(fy + 1, 1, 1)
    return _dt.date(fy - 1, start_month, 1), _dt.date(fy, start_month, 1)


def fiscal_year_filter(date: Column | str, fy: int, start_month: int = FY_START_MONTH) -> Column:
    """Predicate "date falls in fiscal year fy" written as a date range.

    ``fiscal_year(d) == fy`` is opaque to parquet pushdown; the range form
    reaches the scan as two pushed comparisons and prunes row groups.
    """
    lo, hi = fiscal_year_bounds(fy, start_month)
    d = _col(date)
    return (d >= F.lit(lo)) & (d < F.lit(hi))
