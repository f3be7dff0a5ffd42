"""Forecast accuracy at each drill level equals the measures computed at that level alone."""

import datetime as dt

from conftest import Tables
from revlens.operators.supply import forecast_drill, forecast_measures
from revlens.plans.inspect import physical_plan

PATH = ["region", "market", "customer"]
SHOWN = ["forecast_qty", "actual_qty", "net_error", "net_error_pct", "abs_error", "abs_error_pct", "forecast_accuracy_pct", "risk"]


def test_each_level_on_its_own(star):
    got = forecast_drill(star, PATH, 1997).collect()
    for n in range(4):
        level = [r for r in got if r.level == 2 ** (3 - n) - 1]
        own = [r for r in forecast_measures(star, [*PATH[:n], "fiscal_year"]).collect() if r.fiscal_year == 1997]
        want = {tuple(r[c] for c in PATH[:n]): tuple(r[c] for c in SHOWN) for r in own}
        assert {tuple(r[c] for c in PATH[:n]): tuple(r[c] for c in SHOWN) for r in level if r.actual_qty is not None or r.forecast_qty is not None} == want
        before = {tuple(r[c] for c in PATH[:n]): r.abs_error for r in forecast_measures(star, [*PATH[:n], "fiscal_year"]).collect() if r.fiscal_year == 1996}
        assert {k: v for k, v in ((tuple(r[c] for c in PATH[:n]), r.abs_error_ly) for r in level) if v is not None} == {k: v for k, v in before.items() if v is not None}
    leaf, top = (sum(r.abs_error or 0 for r in got if r.level == k) for k in (0, 7))
    assert top < leaf  # never the sum of the level below


def test_netting_and_names_that_are_missing(spark):
    day = dt.date(1997, 1, 1)
    keys = "date date, fiscal_year int, customer_code bigint, product_code bigint, "
    sales = spark.createDataFrame([(day, 1997, c, 1, 10) for c in (1, 2, 3, 4)], keys + "sold_quantity bigint")
    fc = spark.createDataFrame([(day, 1997, 1, 1, 15), (day, 1997, 2, 1, 5), (day, 1997, 3, 1, 12), (day, 1997, 4, 1, 10)], keys + "forecast_quantity bigint")
    dim = spark.createDataFrame([(1, "a", "m", "r"), (2, "b", "m", "r"), (3, "c", None, "r"), (4, "d", "m", None)], "customer_code bigint, customer string, market string, region string")
    t = Tables(fact_sales_monthly=sales, fact_forecast_monthly=fc, dim_customer=dim)
    got = {(r.region, r.market, r.customer, r.level): (r.abs_error, r.forecast_accuracy_pct) for r in forecast_drill(t, PATH, 1997).collect()}
    assert got["r", "m", "a", 0] == (5, 1 - 5 / 15) and got["r", "m", "b", 0][0] == 5
    assert got["r", "m", None, 1] == (0, None)  # 20 of 20: the two customers net off
    assert got["r", None, None, 1][0] == 2 and got["r", None, None, 3][0] == 2
    assert got[None, "m", None, 1] == (0, None) and got[None, None, None, 3] == (0, None)
    assert got[None, None, None, 7][0] == 2
    assert len(got) == 4 + 3 + 2 + 1


def test_facts_are_read_once(star):
    plan = physical_plan(forecast_drill(star, PATH, 1997))
    assert plan.count("Expand") == 1 and "Cartesian" not in plan
