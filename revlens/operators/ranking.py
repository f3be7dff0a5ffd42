"""Top-N and ranking reports.

Rank filters are written as ``rank_fn().over(w) <= k`` directly after the
window so Catalyst inserts ``WindowGroupLimit``: each map task keeps only the
top rows of every group before the shuffle, so a group holding a third of
all rows still sends at most k (plus ties) rows per task. Ranks of all rows
have no such limit: ``row_numbers`` and ``all_ranks`` number a group over many
tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.plans.joins import null_safe_join
from revlens.session import written_once

_RANKERS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def _desc(cols: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


_POSITION_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def _asc(cols: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def top_n(df: DataFrame, by: str | list[str], n: int, tie_break: list[str] | None = None) -> DataFrame:
    """First ``n`` rows by ``by`` descending; ``tie_break`` (ascending) makes ties deterministic.

    Planned as ``TakeOrderedAndProject``: a per-partition top-n then a merge of
    n rows per partition, never a full sort.
    """
    by = [by] if isinstance(by, str) else list(by)
    return df.orderBy(*_desc(by), *_asc(tie_break or [])).limit(n)


def top_k_per_group(df: DataFrame, group: list[str], by: str | list[str], k: int,
                    method: str = "dense_rank", tie_break: list[str] | None = None,
                    rank_col: str = "rnk") -> DataFrame:
    """Rows whose rank within ``group`` (by ``by`` descending) is at most ``k``.

    ``method`` is ``dense_rank`` (ties share, no gaps), ``rank`` (ties share,
    gaps follow) or ``row_number`` (unique; ``tie_break`` orders ties).
    """
    by = [by] if isinstance(by, str) else list(by)
    order = _desc(by) + (_asc(tie_break or []) if method == "row_number" else [])
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, _RANKERS[method]().over(w)).filter(F.col(rank_col) <= k)


def ranking_compare(df: DataFrame, group: str | list[str], value: str, k: int,
                    tie_break: list[str]) -> DataFrame:
    """ROW_NUMBER, RANK and DENSE_RANK side by side, keeping rows with row number <= k.

    The top-k rows by row number are selected first (group-limited, skew
    safe); RANK and DENSE_RANK are then computed on those rows only. That is
    exact: every row ranked before a kept row is itself kept, so counting the
    greater values inside the kept set gives the same rank as over the group.
    """
    group = [group] if isinstance(group, str) else list(group)
    kept = top_k_per_group(df, group, value, k, method="row_number", tie_break=tie_break,
                           rank_col="rn")
    w = Window.partitionBy(*group).orderBy(F.col(value).desc_nulls_last())
    return (kept.withColumn("rnk", F.rank().over(w))
            .withColumn("drank", F.dense_rank().over(w)))


def row_numbers(df: DataFrame, group: list[str], by: list[str], tie_break: list[str], alias: str = "rn",
                partitions: int | None = None) -> DataFrame:
    """``df`` with ROW_NUMBER() OVER (PARTITION BY group ORDER BY by DESC, tie_break) of every row.

    A window would sort a whole group in one task. Here rows are range-partitioned
    and sorted by (group, by, tie_break), written once, and a row's number is its
    place in its partition plus the rows of its group in the partitions before:
    sums over one row per group and partition. A group that holds all rows is
    spread over all tasks, as are rows that tie (equal in all order columns, they
    are numbered in any order).
    """
    by, place = list(by), "__place"
    columns = df.columns
    order = [*_asc(group), *_desc(by), *_asc(tie_break), F.col("__mixed"), F.col("__source")]
    rows = df.withColumn("__mixed", F.xxhash64(*columns)).withColumn("__source", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)
    rows = written_once(rows.select(*columns, F.monotonically_increasing_id().alias(place)))
    part = F.shiftright(place, _POSITION_BITS).alias("__part")
    position = F.col(place).bitwiseAND((1 << _POSITION_BITS) - 1)
    rows = rows.select(*columns, part, position.alias(place))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (rows.groupBy(*group, "__part").agg(F.count("*").alias("__n"), F.min(place).alias("__first"))
            .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first"))
            .select(*group, "__part", "__start"))
    out = null_safe_join(rows, runs, [*group, "__part"])
    return out.withColumn(alias, F.col("__start") + F.col(place) + 1).select(*columns, alias)


def all_ranks(df: DataFrame, group: str | list[str], value: str, tie_break: list[str],
              partitions: int | None = None) -> DataFrame:
    """Every row with ROW_NUMBER (rn), RANK (rnk) and DENSE_RANK (drank) in its group by ``value`` descending.

    No task holds a group. RANK is the smallest row number of a value and
    DENSE_RANK the number of the value among its group's distinct values; both
    come from one row per distinct value and are joined back.
    """
    group = [group] if isinstance(group, str) else list(group)
    numbered = row_numbers(df, group, [value], tie_break, "rn", partitions)
    values = numbered.groupBy(*group, value).agg(F.min("rn").alias("rnk"))
    values = row_numbers(values, group, [value], [], "drank", partitions)
    out = null_safe_join(numbered, values, [*group, value])
    return out.select(*df.columns, "rn", "rnk", "drank")
