"""A fiscal year that starts in March, through the waterfall, shares, forecasts, coverage and the sinks."""

import uuid

import pytest

import oracle_compare
from conftest import SF_SMALL
from oracle_compare import duck, rows_of
from revlens import oracle
from revlens.operators import contribution as C
from revlens.operators import forecast as FC
from revlens.operators import ranking as R
from revlens.operators.coverage import coverage_report
from revlens.operators.output import decimals_to_double
from revlens.operators.waterfall import net_sales
from revlens.plans.inspect import scans
from revlens.sources.refresh import refresh_actual_est
from revlens.sources.sinks import write_actual_est
from revlens.sources.star import Star, stored_year

oracle_compare.STRICT = True
REPORTS = {
    "net_sales_by_customer": lambda t: C.net_sales_by(t, ["customer"], 1997),
    "customer_contribution_region": lambda t: C.contribution(C.net_sales_by(t, ["customer", "region"], 1997), "net_sales_mln", within=["region"], alias="pct_by_region"),
    "market_contribution": lambda t: C.contribution(C.net_sales_by(t, ["market"], 1997), "net_sales_mln"),
    "top_markets_per_region": lambda t: R.top_k_per_group(C.gross_sales_by(t, ["market", "region"], 1997), ["region"], "gross_sales_mln", 2),
    "top_products_per_division": lambda t: R.top_k_per_group(C.quantity_by(t, ["division", "product"], 1997), ["division"], "total_quantity", 3, rank_col="drank"),
    "forecast_accuracy": lambda t: FC.forecast_accuracy(t, 1997),
    "accuracy_decline": lambda t: FC.accuracy_decline(t, 1996, 1997),
    "actual_est": lambda t: FC.actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly),
}


@pytest.fixture(scope="module")
def march(star):
    return star.starting(3)


def march_sql(name):
    """The oracle with years that start ten months before January of the next."""
    return oracle.oracle_queries()[name].replace("INTERVAL 4 MONTH", "INTERVAL 10 MONTH").replace("INTERVAL 5 MONTH", "INTERVAL 11 MONTH")


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports(march, name):
    got = decimals_to_double(REPORTS[name](march))
    result = duck(SF_SMALL).execute(march_sql(name))
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == want and want


def test_years_limit_the_scans_and_change_nothing(spark, tmp_path):
    path = str(tmp_path / "s")
    Star.build(spark, SF_SMALL, path)
    t = Star.read(spark, path)
    every, some = t.starting(3), t.starting(3, [1997])
    a, b = (sorted(map(tuple, C.net_sales_by(x, ["market"], 1997).collect())) for x in (every, some))
    assert a == b and a
    for scan in scans(net_sales(some, 1997)):
        if "sold_quantity" in scan.split("ReadSchema")[1] or "discounts_pct:" in scan.split("ReadSchema")[1]:
            assert "fiscal_year#" in scan.split("PartitionFilters:")[1].split("]")[0] and "1996,1997" in scan.split("PartitionFilters:")[1]
            assert "GreaterThanOrEqual(date,1996-03-01)" in scan and "LessThan(date,1997-03-01)" in scan
    assert t.starting(3, []).fact_sales_monthly.count() == 0
    assert t.starting(9).fact_sales_monthly.exceptAll(t.fact_sales_monthly).count() == 0


def test_coverage_and_sinks(spark, march, tmp_path):
    rows = coverage_report(march).collect()
    assert sum(r.lines for r in rows) == march.fact_sales_monthly.count()
    want = {tuple(r) for r in FC.actual_vs_forecast(march.fact_sales_monthly, march.fact_forecast_monthly).select("fiscal_year", "date").distinct().collect()}
    assert all(y == d.year + (d.month >= 3) for y, d in want)
    stored = write_actual_est(march, str(tmp_path / "a"), [1996, 1997])
    assert {tuple(r) for r in stored.select("fiscal_year", "date").distinct().collect()} == {x for x in want if x[0] in (1996, 1997)}
    db = f"revlens_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path / db}'")
    refresh_actual_est(march, db)
    assert {tuple(r) for r in spark.table(f"{db}.fact_actual_est").select("fiscal_year", "date").distinct().collect()} == want


def test_stored_year():
    from datetime import date
    assert [stored_year(date(1996, m, 1)) for m in (8, 9)] == [1996, 1997]
