"""Ranks of all rows without a task that holds a group, against the window functions."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from revlens.operators.ranking import all_ranks, row_numbers
from revlens.plans.inspect import physical_plan


def windows(df):
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    rn = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), F.col("id").asc_nulls_last())
    return df.select("*", F.row_number().over(rn).alias("rn"), F.rank().over(w).alias("rnk"), F.dense_rank().over(w).alias("drank"))


def rows(df):
    return sorted((tuple(r) for r in df.select("g", "v", "id", "rn", "rnk", "drank").collect()), key=str)


@pytest.mark.parametrize("groups,values", [(1, 5), (1, 10_000), (40, 7), (700, 3)])
def test_equal_to_windows(spark, groups, values):
    rng = random.Random(groups)
    data = [(rng.choice([None, *(f"g{k}" for k in range(groups))]), rng.choice([None, *range(values)]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    assert rows(all_ranks(df, "g", "v", ["id"], partitions=7)) == rows(windows(df))


def test_edges(spark):
    df = spark.createDataFrame([], "g string, v int, id int")
    assert all_ranks(df, "g", "v", ["id"]).count() == 0
    same = spark.createDataFrame([("a", 1, 1)] * 50, "g string, v int, id int")
    got = all_ranks(same, "g", "v", ["id"], partitions=4).collect()
    assert sorted(r.rn for r in got) == list(range(1, 51)) and {(r.rnk, r.drank) for r in got} == {(1, 1)}
    total = row_numbers(same.withColumn("v", F.col("v") + 1), [], ["v"], ["id"], "n")
    assert sorted(r.n for r in total.collect()) == list(range(1, 51))


@pytest.mark.parametrize("distinct", [1, 50_000])
def test_a_group_of_all_rows_is_spread(spark, distinct):
    """One group, and one value of it or all different: no task has over twice the median rows."""
    df = spark.range(0, 50_000, 1, 8).select(F.lit("hot").alias("g"), (F.col("id") % distinct).cast("int").alias("v"), F.col("id").cast("int"))

    def seen(batches):
        yield pa.RecordBatch.from_pydict({"n": [sum(b.num_rows for b in batches)]})

    out = row_numbers(df, ["g"], ["v"], ["id"], partitions=8)
    sizes = sorted(r.n for r in out.mapInArrow(seen, "n long").collect() if r.n)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert out.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first()[:] == (1, 50_000, 50_000)
    ranked = all_ranks(df, "g", "v", ["id"], partitions=8)
    assert ranked.agg(F.max("drank")).first()[0] == distinct


def test_no_window_sees_the_rows(spark, star):
    """The one window runs over a row per group and partition."""
    df = star.expenses.limit(500)
    plan = physical_plan(row_numbers(df, ["category"], ["amount"], ["expense_id"]))
    assert plan.count("Window [") == 1 and plan.count("Scan ExistingRDD") >= 2
    assert "partial_count" in plan.split("Window [")[1]
