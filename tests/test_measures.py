import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import Tables
from revlens.operators.market import market_share, own_market_share
from revlens.operators.measures import (BASE, gap_flag, measures, measures_ly, measures_with_prior,
                                        with_benchmark, with_targets)
from revlens.operators.pl import pl_statement

ROWS = [  # fiscal_year, date, market, net_sales_amount
    (1996, dt.date(1996, 1, 1), "A", "100.00"),
    (1997, dt.date(1997, 1, 1), "A", "120.00"),
    (1997, dt.date(1997, 2, 1), "A", "30.00"),
    (1997, dt.date(1997, 1, 1), "B", "50.00"),
    (1997, dt.date(1997, 1, 1), "Z", "0.00"),
]


def _fact(spark):
    df = spark.createDataFrame(ROWS, "fiscal_year int, date date, market string, ns string")
    cols = {}
    for name, col in BASE.items():
        if col == "sold_quantity":
            cols[col] = F.lit(10).cast("bigint")
        elif col == "net_sales_amount":
            cols[col] = F.col("ns").cast("decimal(20,2)")
        elif col in ("manufacturing_cost",):
            cols[col] = (F.col("ns").cast("decimal(20,2)") * F.lit(0.5).cast("decimal(2,1)")).cast("decimal(20,2)")
        else:
            cols[col] = F.lit(0).cast("decimal(20,2)")
    return df.withColumns(cols).drop("ns")


def test_derived_measures_and_zero_sales(spark):
    m = {r.market: r for r in measures(_fact(spark), ["fiscal_year", "market"], 1997).collect()}
    assert float(m["A"].gross_margin) == 75.0 and m["A"].gross_margin_pct == 0.5
    assert m["Z"].gross_margin_pct == 0.0 and m["Z"].net_profit_pct == 0.0  # DIVIDE(x, 0, 0)
    assert float(m["A"].operational_expense) == 0.0


def test_last_year_blank_rules(spark):
    m = {(r.fiscal_year, r.market): r for r in measures_ly(_fact(spark), ["fiscal_year", "market"]).collect()}
    a, b = m[(1997, "A")], m[(1997, "B")]
    assert float(a.net_sales_ly) == 100.0 and a.gross_margin_pct_ly == 0.5
    assert b.net_sales_ly is None and b.gross_margin_pct_ly == 0.0  # ratio of BLANK sums is 0
    blank = {(r.fiscal_year, r.market): r for r in
             measures_ly(_fact(spark), ["fiscal_year", "market"], blank_ratio=True).collect()}
    assert blank[(1997, "B")].gross_margin_pct_ly is None


def test_last_year_month_grain_gaps(spark):
    m = {(r.date, r.market): r for r in measures_ly(_fact(spark), ["date", "market"], period="date").collect()}
    assert float(m[(dt.date(1997, 1, 1), "A")].net_sales_ly) == 100.0
    assert m[(dt.date(1997, 2, 1), "A")].net_sales_ly is None  # no Feb 1996: calendar shift, not lag


def test_conditional_prior_equals_self_join(spark):
    f = _fact(spark)
    a = {r.market: (r.net_sales, r.net_sales_ly) for r in measures_with_prior(f, ["market"], 1997).collect()}
    b = {r.market: (r.net_sales, r.net_sales_ly) for r in
         measures_ly(f, ["fiscal_year", "market"]).filter("fiscal_year = 1997").collect()}
    assert a == b


def test_targets_and_benchmarks(spark):
    f = _fact(spark)
    tg = spark.createDataFrame([(1997, "A", "300.00", "60.00", "15.00")],
                               "fiscal_year int, market string, ns_target string, gm_target string, np_target string") \
        .select("fiscal_year", "market", *[F.col(c).cast("decimal(24,2)").alias(c)
                                           for c in ("ns_target", "gm_target", "np_target")])
    cust = spark.createDataFrame([(1, "x", "A", "R1", "c"), (2, "y", "B", "R1", "c")],
                                 "customer_code bigint, customer string, market string, region string, channel string")
    t = Tables(ns_gm_target=tg, dim_customer=cust)
    dims = ["fiscal_year", "market"]
    m = {r.market: r for r in with_benchmark(with_targets(measures(f, dims, 1997), t, dims), "target").collect()}
    assert float(m["A"].net_sales_bm) == 300.0 and m["A"].gross_margin_pct_target == 0.2
    assert m["B"].net_sales_bm is None and m["B"].gross_margin_pct_bm == 0.0
    cust_level = with_targets(measures(f.withColumn("customer", F.lit("x")), ["customer"], 1997), t, ["customer"])
    assert cust_level.first().ns_target is None  # below the target grain: BLANK
    flag = {r.market: r.gross_margin_pct_flag for r in
            gap_flag(with_benchmark(measures_ly(f, dims), "ly"), 0.0).filter("fiscal_year = 1997").collect()}
    assert flag == {"A": 1, "B": 0, "Z": 1}  # Z: 0 % vs a blank-year 0 %: variance 0


def test_pl_statement_no_prior_year(spark):
    pl_rows = spark.createDataFrame([(i, f"line{i}") for i in range(1, 18)], "ord int, description string")
    t = Tables(pl_rows=pl_rows)
    f = _fact(spark).filter("market = 'B'")
    rows = {r.ord: r for r in pl_statement(f, t, 1997, benchmark="ly").collect()}
    assert len(rows) == 18
    assert rows[7].value == pytest.approx(50.0 / 1e6) and rows[7].bm is None and rows[7].chg is None
    assert rows[13].bm == 0.0 and rows[13].chg == rows[13].value  # ratio LY of nothing is 0
    assert rows[None].description == "Total" and rows[None].value == rows[7].value
    assert rows[7].chg_pct == 0.0  # DIVIDE(BLANK, BLANK, 0)


def test_market_share_brand_case(spark):
    ms = spark.createDataFrame([(1997, "c1", "Brand#1", "10", "100"), (1997, "c2", "brand#1", "20", "200"),
                                (1997, "c1", "Other", "90", "100")],
                               "fiscal_year int, category string, manufacturer string, sales string, total string") \
        .select("fiscal_year", "category", "manufacturer", F.col("sales").cast("decimal(25,2)").alias("sales"),
                F.col("total").cast("decimal(25,2)").alias("total_market_sales"))
    own = own_market_share(ms, ["fiscal_year", "manufacturer"], "BRAND#1").first()
    assert own.own_market_share == pytest.approx(0.1)
    shares = {r.manufacturer: r.market_share for r in market_share(ms, ["manufacturer"]).collect()}
    assert shares["Other"] == pytest.approx(0.9)


def test_partially_blank_terms_count_as_zero(spark):
    f = _fact(spark).withColumn("freight_cost", F.lit(None).cast("decimal(20,2)"))
    m = {r.market: r for r in measures(f, ["market"], 1997).collect()}
    a = m["A"]
    assert a.total_cogs == a.manufacturing_cost and a.gross_margin == a.net_sales - a.manufacturing_cost
    none = measures(f.withColumn("manufacturing_cost", F.lit(None).cast("decimal(20,2)"))
                    .withColumn("other_cost", F.lit(None).cast("decimal(20,2)")), ["market"], 1997)
    assert none.filter("market = 'A'").first().total_cogs is None  # every term blank -> blank
