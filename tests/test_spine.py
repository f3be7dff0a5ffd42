"""Every month between a group's first and last; last-year values as without the spine; one read of the fact."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from revlens.operators.measures import BASE, measures_ly
from revlens.operators.pages import kpi_series
from revlens.plans.inspect import scans
from revlens.plans.periods import calendar_periods
from revlens.plans.spine import with_every_month
from revlens.sources.star import Star


def month(k):
    return dt.date(1996 + k // 12, k % 12 + 1, 1)


@pytest.fixture(scope="module")
def days(spark):
    return spark.sql("SELECT explode(sequence(DATE'1996-01-01', DATE'1998-03-20')) AS date")


def test_gaps_by_hand(spark, days):
    rows = [("a", month(0), 1), ("a", month(1), 2), ("a", month(5), 3), ("b", month(3), 4), (None, month(2), 5), (None, month(4), None), ("c", month(40), 6), ("c", month(42), 7)]
    df = spark.createDataFrame(rows, "g string, date date, v int")
    got = sorted(((r.g, r.date, r.v) for r in with_every_month(df, days, ["g"]).collect()), key=str)
    want = [("a", month(k), {0: 1, 1: 2, 5: 3}.get(k)) for k in range(6)] + [("b", month(3), 4)]
    want += [(None, month(k), 5 if k == 2 else None) for k in (2, 3, 4)] + [("c", month(40), 6), ("c", month(42), 7)]  # months the calendar lacks stay as they are
    assert got == sorted(want, key=str)
    total = df.where("g = 'a'").drop("g")
    assert with_every_month(total, days, []).count() == 6
    assert with_every_month(df.limit(0), days, ["g"]).count() == 0


def sparse(spark):
    money = [c for c in BASE.values() if c != "sold_quantity"]
    rows = [("a", 0, 100), ("a", 3, 50), ("a", 14, 70), ("b", 13, 10), ("b", 14, 20), (None, 2, 5), (None, 6, 5)]
    df = spark.createDataFrame([(g, month(k), v) for g, k, v in rows], "market string, date date, amount int")
    return df.select("market", "date", *[F.col("amount").cast("decimal(20,2)").alias(c) for c in money], F.lit(1).cast("bigint").alias("sold_quantity"))


def test_series_of_a_sparse_fact(spark, days):
    got = {(r.market, r.date): r for r in kpi_series(sparse(spark), ["market"], days).collect()}
    a = sorted(d for m, d in got if m == "a")
    assert a == [month(k) for k in range(27)][: len(a)] and a[-1] == month(26)  # the sale of month 14 is compared with month 26
    assert got["a", month(1)].net_sales is None and got["a", month(1)].gross_margin_pct is None
    assert got["a", month(12)].net_sales is None and got["a", month(12)].net_sales_ly == 100
    assert got["a", month(15)].net_sales_ly == 50 and got["a", month(13)].net_sales_ly is None
    assert got["a", month(14)].net_sales == 70 and got["a", month(26)].net_sales_ly == 70
    assert [d for m, d in sorted(x for x in got if x[0] == "b")][0] == month(13)
    assert got[None, month(4)].net_sales is None and got[None, month(18)].net_sales_ly == 5


def test_values_are_those_without_the_spine(star):
    keys = ["channel", "market", "date"]
    fact = star.fact_actuals_estimates
    series = {tuple(r[k] for k in keys): r for r in kpi_series(fact, keys[:2], star.dim_date).collect()}
    plain = {tuple(r[k] for k in keys): r for r in measures_ly(fact, keys, "date", blank_ratio=True).collect()}
    assert set(plain) <= set(series) and len(series) > len(plain)
    for key, r in plain.items():
        s = series[key]
        assert (s.net_sales, s.net_sales_ly, s.gross_margin_pct_ly) == (
            None if r.net_sales is None else float(r.net_sales), None if r.net_sales_ly is None else float(r.net_sales_ly), r.gross_margin_pct_ly)
    groups = {}
    for c, m, d in series:
        groups.setdefault((c, m), []).append(d.year * 12 + d.month)
    assert all(sorted(x) == list(range(min(x), max(x) + 1)) for x in groups.values())


def test_known_periods_read_no_fact(spark, tmp_path):
    path = str(tmp_path / "s")
    Star.build(spark, SF_SMALL, path)
    t = Star.read(spark, path)
    fact = lambda df: sum("fiscal_year#" in s for s in scans(df))
    dims = ["fiscal_year", "market"]
    once = measures_ly(t.fact_actuals_estimates, dims, known=calendar_periods(t.dim_date, "fiscal_year"))
    twice = measures_ly(t.fact_actuals_estimates, dims)
    assert (fact(once), fact(twice)) == (1, 2)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert sum("market#" in s for s in scans(kpi_series(t.fact_actuals_estimates, ["market"], t.dim_date))) == 1
