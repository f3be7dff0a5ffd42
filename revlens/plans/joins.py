"""Attaching totals: one-row aggregates as scalar subqueries, group totals as joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a single-row frame to every row of ``df``.

    ``one_row`` must be a global aggregate (``df.agg(...)`` with no grouping),
    which always yields exactly one row. It is attached as one scalar
    subquery (packed into a struct so it runs once): computed first, then
    used as a constant by every task, so there is no join at all and Spark
    fails the query if the input ever had more than one row. This replaces
    ``SUM(x) OVER ()``, which Spark runs as a single-partition window.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("__row")).scalar()
    return (df.withColumn("__row", packed)
            .withColumns({c: F.col("__row").getField(c) for c in cols})
            .drop("__row"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL, as it does in GROUP BY and PARTITION BY.

    Columns: the keys once (taken from whichever side has the row), then the
    other columns of ``left`` and of ``right``. Spark hashes and sorts a
    null-safe equality like any other, so this is an ordinary shuffled or
    broadcast join, outer joins included.
    """
    own = {k: f"__{k}" for k in keys}
    right = right.withColumnsRenamed(own)
    same: Column = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[own[k]]) for k in keys])
    out = left.join(right, same, how)
    if how in ("inner", "left"):
        return out.drop(*own.values())
    merged = [F.coalesce(k, own[k]).alias(k) for k in keys]
    return out.select(*merged, *[c for c in left.columns if c not in own], *[c for c in right.columns if c not in own.values()])


def join_totals(df: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Join per-group totals back to ``df`` on ``keys`` (one total row per key).

    A NULL key is a group like any other, so the result is that of
    ``SUM() OVER (PARTITION BY keys)``. With no keys the totals frame is one row
    and is attached with :func:`attach_row`; otherwise this is an equi-join whose
    strategy (broadcast below Spark's size threshold, shuffled otherwise) is
    left to the planner.
    """
    if not keys:
        return attach_row(df, totals)
    return null_safe_join(df, totals, keys)
