"""A calendar spine: every month between a group's first and last, sales or not.

Facts hold months with sales only, so a group's series has gaps that a chart
draws as if they weren't there. The months come from the date dimension, as one
small array (a scalar subquery). Each row of the series looks at its group's
next row and emits the months between: one shuffle of the aggregated series, no
join, and the fact is read once. A group has at most one row per month, so no
group is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.plans.joins import attach_row


def calendar_months(dim_date: DataFrame) -> DataFrame:
    """One row with ``months``: the first days of the calendar's months, ascending."""
    return dim_date.agg(F.array_sort(F.collect_set(F.trunc("date", "month"))).alias("months"))


def with_every_month(series: DataFrame, dim_date: DataFrame, dims: list[str], period: str = "date") -> DataFrame:
    """``series`` (unique on ``dims`` and the month ``period``) with a row of NULL values for each month
    of the calendar that a group lacks between its first and its last.

    Months of the series that the calendar lacks stay. A NULL in ``dims`` is a group like any other.
    """
    group = dims or [F.lit(0)]
    values = [c for c in series.columns if c not in {*dims, period}]
    rows = series.withColumn("__next", F.lead(period).over(Window.partitionBy(*group).orderBy(period)))
    missing = F.filter("months", lambda m: (m > F.col(period)) & (m < F.col("__next")))
    rows = attach_row(rows, calendar_months(dim_date)).withColumn("__gap", F.coalesce(missing, F.array().cast("array<date>")))
    rows = rows.withColumn("__month", F.explode(F.concat(F.array(period), "__gap")))
    own = F.col("__month").eqNullSafe(F.col(period))
    filled = {c: F.when(own, F.col(c)) for c in values}
    return rows.withColumns(filled).withColumn(period, F.col("__month")).select(*series.columns)
