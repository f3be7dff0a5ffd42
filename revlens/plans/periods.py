"""Same-period-last-year values without a self-join.

An aggregate ``agg`` (unique on ``dims``, which include a period column) is
emitted twice per row: once for its own period and once, as ``*_ly`` values,
for the period a year later. Merging the two by ``dims`` gives each period
its prior-year values. Compared with joining the aggregate to a shifted copy
of itself, the aggregate is computed once (a self-join recomputes it, since
Spark cannot reuse the exchange when the two sides' plans differ) and the
only extra work is one shuffle of the aggregated rows.

The shift follows the calendar (fiscal_year + 1, or date + 12 months), so a
missing prior period gives NULL rather than the previous available row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.fiscal import FY_START_MONTH, fiscal_year


def _shifted(dims: list[str], period: str) -> dict[str, Column]:
    if period == "fiscal_year":
        return {"fiscal_year": F.col("fiscal_year") + 1}
    if period == "date":
        out = {"date": F.add_months(F.col("date"), 12)}
        if "fiscal_year" in dims:
            out["fiscal_year"] = F.col("fiscal_year") + 1
        return out
    raise ValueError("period must be 'fiscal_year' or 'date'")


def calendar_periods(dim_date: DataFrame, period: str, start_month: int = FY_START_MONTH) -> DataFrame:
    """The periods of the date dimension: its fiscal years, or the first days of its months."""
    if period == "fiscal_year":
        return dim_date.select(fiscal_year("date", start_month).alias("fiscal_year")).distinct()
    return dim_date.select(F.trunc("date", "month").alias(period)).distinct()


def with_prior_period(agg: DataFrame, dims: list[str], period: str, columns: list[str],
                      suffix: str = "_ly", known: DataFrame | None = None) -> DataFrame:
    """``agg`` plus ``<col><suffix>`` = value of the same dims one year earlier.

    A group present only a year earlier is kept with NULL current values when
    its period is a known one, so the prior amounts of a lapsed customer or
    market stay in that period's total. ``known`` holds the periods (one
    column), e.g. ``calendar_periods`` of the date dimension; without it they
    are those that occur in ``agg``, whose input is then read a second time.
    """
    if period not in dims:
        raise ValueError(f"dims must contain the period column {period!r}")
    shift = _shifted(dims, period)
    types = {f.name: f.dataType for f in agg.schema.fields}

    def null(c: str) -> Column:
        return F.lit(None).cast(types[c])

    current = F.struct(*[F.col(d).alias(d) for d in dims],
                       *[F.col(c).alias(c) for c in columns],
                       *[null(c).alias(c + suffix) for c in columns])
    prior = F.struct(*[shift.get(d, F.col(d)).alias(d) for d in dims],
                     *[null(c).alias(c) for c in columns],
                     *[F.col(c).alias(c + suffix) for c in columns])
    # each (dims) group receives at most one current and one prior row, so
    # max() just picks the non-null value and keeps its type
    merged = (agg.select(F.inline(F.array(current, prior)))
              .groupBy(*dims)
              .agg(*[F.max(c).alias(c) for c in columns],
                   *[F.max(c + suffix).alias(c + suffix) for c in columns]))
    if known is None:
        known = agg.select(period).distinct()  # needs the period column only, so its scan reads no amounts
    return merged.join(known, period, "left_semi").select(*dims, *columns, *[c + suffix for c in columns])
