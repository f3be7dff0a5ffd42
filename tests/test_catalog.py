"""Procedures and views by name, in one session and from a second one, against the operators."""

import uuid

import pytest

from revlens.functions.sets import restrict_to_codes
from revlens.operators.finance import monthly_gross_sales
from revlens.operators.forecast import actual_vs_forecast, forecast_accuracy
from revlens.operators.waterfall import gross_sales, net_sales
from revlens.plans.inspect import physical_plan, python_nodes, scans
from revlens.sources.catalog import LAYERS, PROCEDURES, publish, register
from revlens.sources.star import Star

FACTS = ("fact_sales_monthly", "fact_forecast_monthly", "fact_post_invoice_deductions", "fact_gross_price", "fact_pre_invoice_deductions")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def stored(spark, star, tmp_path_factory):
    """A database saved and published by one session; the name, and another session that uses it."""
    db = f"revlens_{uuid.uuid4().hex[:8]}"
    star.save_tables(spark, db, buckets=2, location=str(tmp_path_factory.mktemp("db") / db))
    names = publish(spark, db)
    assert set(LAYERS) | set(PROCEDURES) <= set(names)
    publish(spark, db)  # again: names are replaced
    second = spark.newSession()
    second.conf.set("spark.sql.session.timeZone", "UTC")
    second.sql(f"USE {db}")
    return db, second


def pruned(df, tables, year=1997):
    """Every scan of the tables reads that year alone."""
    seen = set()
    for scan in scans(df):
        name = next((t for t in FACTS if f".{t}[" in scan), None)
        if name:
            seen.add(name)
            assert f"= {year})" in scan.split("PartitionFilters:")[1].split("]")[0], scan
    assert seen == set(tables), seen


def check_procedures(session, star):
    assert rows(session.sql("SELECT * FROM get_forecast_accuracy(1997)")) == rows(forecast_accuracy(star, 1997))
    assert rows(session.sql("SELECT * FROM get_forecast_accuracy(in_fiscal_year => 1995)")) == rows(forecast_accuracy(star, 1995))
    assert session.sql("SELECT * FROM get_forecast_accuracy(1800)").count() == 0
    assert rows(session.sql("SELECT * FROM get_monthly_gross_sales_for_customer(7)")) == rows(monthly_gross_sales(star, 7))
    for codes in ("7,8,9", "7, 70", "", "7", "07,8"):
        got = session.sql(f"SELECT * FROM get_monthly_gross_sales_for_customer_multi('{codes}')")
        assert rows(got) == rows(monthly_gross_sales(star, codes)), codes
    of_year = session.sql("SELECT * FROM get_monthly_gross_sales_for_customer_multi('7,8,9', 1997)")
    assert rows(of_year) == [r for r in rows(monthly_gross_sales(star, "7,8,9")) if "1996-09" <= str(r[0]) < "1997-09"]


def test_procedures_of_a_session(spark, star):
    register(spark, star)
    check_procedures(spark, star)
    joined = spark.sql("SELECT a.customer, b.forecast_accuracy FROM get_forecast_accuracy(1996) a JOIN get_forecast_accuracy(1997) b USING (customer_code)")
    assert joined.count() > 0


def test_procedures_of_a_second_session(stored, star):
    check_procedures(stored[1], star)


def test_views_of_a_second_session(stored, star):
    session = stored[1]
    want = net_sales(star, keep_components=False)
    assert rows(session.table("net_sales").select(*want.columns)) == rows(want)
    assert rows(session.sql("SELECT * FROM gross_sales")) == rows(gross_sales(star))
    unified = actual_vs_forecast(star.fact_sales_monthly, star.fact_forecast_monthly)
    assert rows(session.table("fact_actual_est").select(*unified.columns)) == rows(unified)
    one = session.sql("SELECT get_fiscal_year(DATE'2020-09-01') AS y, get_fiscal_quarter(DATE'2020-08-31') AS q").first()
    assert (one.y, one.q) == (2021, 4)


def test_year_prunes_every_fact(stored):
    session = stored[1]
    priced = ["fact_sales_monthly", "fact_gross_price"]
    pruned(session.sql("SELECT market, SUM(net_sales) FROM net_sales WHERE fiscal_year = 1997 GROUP BY market"),
           [*priced, "fact_pre_invoice_deductions", "fact_post_invoice_deductions"])
    pruned(session.sql("SELECT * FROM fact_actual_est WHERE fiscal_year = 1997"), ["fact_sales_monthly", "fact_forecast_monthly"])
    for call, tables in (("get_forecast_accuracy(1997)", ["fact_sales_monthly", "fact_forecast_monthly"]),
                         ("get_monthly_gross_sales_for_customer(7, 1997)", priced),
                         ("get_monthly_gross_sales_for_customer_multi('7,8,9', 1997)", priced)):
        df = session.sql(f"SELECT * FROM {call}")
        pruned(df, tables)
        assert python_nodes(df) == []
    assert "(customer_code" in physical_plan(session.sql("SELECT * FROM get_monthly_gross_sales_for_customer(7)")).split("PushedFilters")[1]


def test_codes_reach_the_layers(stored, star):
    got = stored[1].sql("SELECT COUNT(*) AS n FROM gross_sales WHERE customer_code IN (7, 8, 9)").first().n
    assert got == restrict_to_codes(gross_sales(star), "customer_code", "7,8,9").count()


def test_another_start_month(spark, star):
    """March start: years come from the dates, in the functions and in the procedures."""
    register(spark, star, start_month=3)
    try:
        assert spark.sql("SELECT get_fiscal_year(DATE'2020-03-01') AS y").first().y == 2021
        assert rows(spark.sql("SELECT * FROM get_monthly_gross_sales_for_customer(7)")) == rows(monthly_gross_sales(star, 7, start_month=3))
    finally:
        register(spark, star)


def test_views_survive_new_rows(spark, star, tmp_path):
    """A stored view is a name for its tables, not a copy."""
    db = f"revlens_{uuid.uuid4().hex[:8]}"
    star.save_tables(spark, db, buckets=2, location=str(tmp_path / db))
    publish(spark, db)
    before = spark.table(f"{db}.gross_sales").count()
    t = Star.from_catalog(spark, db)
    customers = t.dim_customer.where("customer_code <> 7").collect()
    spark.createDataFrame(customers, t.dim_customer.schema).write.mode("overwrite").saveAsTable(f"{db}.dim_customer")
    after = spark.newSession().table(f"{db}.gross_sales").count()
    assert before - after == gross_sales(star).where("customer_code = 7").count() > 0
