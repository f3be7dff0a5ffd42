from pyspark.sql import functions as F

from revlens.operators.measures import measures
from revlens.operators.pages import kpi_trend, performance_matrix, region_scorecard, revenue_split
from revlens.operators.pl import pl_drill, pl_rows, pl_statement


def test_drill_levels_are_consistent(star):
    fact = star.fact_actuals_estimates
    d = pl_drill(fact, ["region", "market", "product"], 1997)
    levels = {r.level: r.n for r in d.groupBy("level").agg(F.count("*").alias("n")).collect()}
    assert set(levels) == {0, 1, 3, 7} and levels[7] == 1
    grand = d.filter("level = 7").first()
    assert grand.region is None and grand.market is None and grand.product is None
    regions = d.filter("level = 3").agg(F.sum("net_sales")).first()[0]
    assert abs(regions - grand.net_sales) < 1e-6
    direct = measures(fact, ["region"], 1997).collect()
    by_region = {r.region: float(r.net_sales) for r in direct}
    assert {r.region: r.net_sales for r in d.filter("level = 3").collect()} == by_region


def test_pl_rows_total_line_is_net_sales(spark, star):
    rows = pl_rows(star.fact_actuals_estimates, star, ["fiscal_year"])
    for fy in (1996, 1997):
        got = {r.ord: r for r in rows.filter(F.col("fiscal_year") == fy).collect()}
        assert len(got) == 18 and got[None].value == got[7].value
        assert abs(got[6].value - (got[4].value + got[5].value)) < 1e-9
        assert abs(got[3].value - (got[1].value - got[2].value)) < 1e-9
        assert abs(got[12].value - (got[7].value - got[11].value)) < 1e-9
        assert abs(got[16].value - (got[12].value + got[15].value)) < 1e-9


def test_pl_statement_vs_ly_and_target(star):
    fact = star.fact_actuals_estimates
    ly = {r.ord: r for r in pl_statement(fact, star, 1997).collect()}
    prior = {r.ord: r.value for r in pl_rows(fact, star, ["fiscal_year"]).filter("fiscal_year = 1996").collect()}
    assert all(abs(ly[o].bm - prior[o]) < 1e-9 for o in range(1, 18))
    assert abs(ly[7].chg - (ly[7].value - ly[7].bm)) < 1e-12
    tg = {r.ord: r for r in pl_statement(fact, star, 1997, benchmark="target").collect()}
    assert {o for o, r in tg.items() if r.bm is not None} == {7, 12, 13, 17, None}


def test_shares_and_matrix(star):
    fact = star.fact_actuals_estimates
    split = revenue_split(fact, ["channel"], 1997)
    assert abs(split.agg(F.sum("share")).first()[0] - 1.0) < 1e-9
    pm = performance_matrix(fact, ["customer"], 1997)
    overall = {r.overall_gross_margin_pct for r in pm.collect()}
    assert len(overall) == 1
    sc = region_scorecard(fact, star, 1997)
    assert sc.count() == fact.select("region").distinct().count()
    assert sc.filter(F.col("net_sales_target").isNull()).count() == 0
    trend = kpi_trend(fact)
    assert trend.count() == fact.select("date").distinct().count()
