from pyspark.sql import Window
from pyspark.sql import functions as F

from revlens.operators.ranking import ranking_compare, top_k_per_group, top_n

TIES = [("a", 10, 1), ("a", 10, 2), ("a", 8, 3), ("a", 7, 4), ("a", 6, 5), ("a", None, 6),
        ("b", 5, 7), ("c", None, 8), ("c", 3, 9), ("c", 3, 10)]


def _ties(spark):
    return spark.createDataFrame(TIES, "category string, amount int, id int")


def test_three_rankers_on_ties(spark):
    out = ranking_compare(_ties(spark), "category", "amount", 4, tie_break=["id"])
    a = [(r.rn, r.rnk, r.drank) for r in out.filter("category = 'a'").orderBy("rn").collect()]
    assert a == [(1, 1, 1), (2, 1, 1), (3, 3, 2), (4, 4, 3)]
    assert out.filter("category = 'b'").count() == 1
    c = [(r.amount, r.rn, r.rnk, r.drank) for r in out.filter("category = 'c'").orderBy("rn").collect()]
    assert c == [(3, 1, 1, 1), (3, 2, 1, 1), (None, 3, 3, 2)]


def test_ranking_compare_equals_full_windows(spark):
    df = spark.range(0, 3000).select((F.col("id") % 7).cast("string").alias("category"),
                                     ((F.col("id") * 37) % 11).cast("int").alias("amount"),
                                     F.col("id").alias("expense_id"))
    w = Window.partitionBy("category").orderBy(F.col("amount").desc_nulls_last())
    w_rn = Window.partitionBy("category").orderBy(F.col("amount").desc_nulls_last(), "expense_id")
    brute = (df.withColumn("rn", F.row_number().over(w_rn)).withColumn("rnk", F.rank().over(w))
             .withColumn("drank", F.dense_rank().over(w)).filter("rn <= 4"))
    ours = ranking_compare(df, "category", "amount", 4, tie_break=["expense_id"])
    cols = ["category", "amount", "expense_id", "rn", "rnk", "drank"]
    assert sorted(ours.select(cols).collect()) == sorted(brute.select(cols).collect())


def test_dense_rank_top_k_and_group_limit(spark):
    df = _ties(spark)
    out = top_k_per_group(df, ["category"], "amount", 2, method="dense_rank")
    got = sorted((r.category, r.amount) for r in out.collect() if r.category == "a")
    assert got == [("a", 8), ("a", 10), ("a", 10)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rank_and_row_number_methods(spark):
    df = _ties(spark)
    r = top_k_per_group(df, ["category"], "amount", 2, method="rank").filter("category = 'a'")
    assert r.count() == 2  # 10, 10 share rank 1; 8 has rank 3
    rn = top_k_per_group(df, ["category"], "amount", 1, method="row_number", tie_break=["id"])
    assert [x.id for x in rn.filter("category = 'a'").collect()] == [1]


def test_top_n_tie_break(spark):
    df = spark.createDataFrame([("x", 5), ("b", 5), ("a", 5), ("z", 9)], "name string, v int")
    assert [r.name for r in top_n(df, "v", 3, tie_break=["name"]).collect()] == ["z", "a", "b"]
