"""Property checks: invariants on the fixtures and randomised comparisons."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from revlens.functions.sets import code_in_list
from revlens.operators.contribution import contribution, net_sales_by
from revlens.operators.forecast import forecast_accuracy, key_duplicates
from revlens.operators.ranking import ranking_compare
from revlens.operators.supply import forecast_measures

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def test_net_error_bounded_by_abs_error(star):
    for df in (forecast_accuracy(star, 1997), forecast_accuracy(star, 1997, "zero")):
        assert df.filter(F.abs("net_error") > F.col("abs_error")).count() == 0
    m = forecast_measures(star, ["fiscal_year", "customer"])
    assert m.filter(F.abs("net_error") > F.col("abs_error")).count() == 0


def test_shares_sum_to_100(star):
    df = contribution(net_sales_by(star, ["market"], 1997), "net_sales_mln")
    n, total = df.agg(F.count("*"), F.sum("pct_contribution")).first()
    assert abs(float(total) - 100) <= 0.005 * n + 0.01 * n  # rounding of shares and of the millions
    by_region = contribution(net_sales_by(star, ["customer", "region"], 1997), "net_sales_mln", within=["region"],
                            alias="pct_by_region")
    for r in by_region.groupBy("region").agg(F.sum("pct_by_region").alias("s"), F.count("*").alias("n")).collect():
        assert abs(float(r.s) - 100) <= 0.015 * r.n or float(r.s) == 0


def test_monthly_keys_unique(star):
    assert key_duplicates(star.fact_sales_monthly).count() == 0
    assert key_duplicates(star.fact_forecast_monthly).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 6))), min_size=1, max_size=40),
       st.integers(1, 5))
def test_rankers_ordered_and_equal_brute_force(spark, rows, k):
    df = spark.createDataFrame([(str(g), a, i) for i, (g, a) in enumerate(rows)],
                               "category string, amount int, expense_id int")
    ours = ranking_compare(df, "category", "amount", k, tie_break=["expense_id"])
    assert ours.filter((F.col("drank") > F.col("rnk")) | (F.col("rnk") > F.col("rn"))).count() == 0
    w = Window.partitionBy("category").orderBy(F.col("amount").desc_nulls_last())
    w_rn = Window.partitionBy("category").orderBy(F.col("amount").desc_nulls_last(), "expense_id")
    brute = (df.withColumn("rn", F.row_number().over(w_rn)).withColumn("rnk", F.rank().over(w))
             .withColumn("drank", F.dense_rank().over(w)).filter(F.col("rn") <= k))
    cols = ["category", "amount", "expense_id", "rn", "rnk", "drank"]
    def key(r):
        return tuple((v is None, v if v is not None else 0) for v in r)

    assert sorted(ours.select(cols).collect(), key=key) == sorted(brute.select(cols).collect(), key=key)


@SETTINGS
@given(st.lists(st.sampled_from(["7", "70", "77", "07", " 7", "7 ", "", "700", "8"]), min_size=0, max_size=5))
def test_code_list_matches_find_in_set(spark, parts):
    text = ",".join(parts)
    df = spark.createDataFrame([(7,), (70,), (77,), (700,), (8,)], "c bigint")
    got = sorted(r.c for r in df.filter(code_in_list("c", text)).collect())
    expect = sorted(c for c in (7, 70, 77, 700, 8) if str(c) in text.split(","))
    assert got == expect


@SETTINGS
@given(st.lists(st.dates(min_value=__import__("datetime").date(1990, 1, 1),
                         max_value=__import__("datetime").date(2030, 12, 31)), min_size=1, max_size=30),
       st.integers(1, 12))
def test_fiscal_functions_match_definition(spark, days, start):
    from revlens.functions.fiscal import fiscal_quarter, fiscal_year, fiscal_year_filter

    def fy(d):
        return d.year + (1 if start > 1 and d.month >= start else 0)

    def fq(d):
        return ((d.month - start) % 12) // 3 + 1

    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = df.select("date", fiscal_year("date", start).alias("y"), fiscal_quarter("date", start).alias("q")).collect()
    assert all(r.y == fy(r.date) and r.q == fq(r.date) for r in got)
    target = fy(days[0])
    in_range = {r.date for r in df.filter(fiscal_year_filter("date", target, start)).collect()}
    assert in_range == {d for d in days if fy(d) == target}
