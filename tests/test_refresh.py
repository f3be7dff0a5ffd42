"""The stored actual/forecast table: changed keys, untouched years, one visible step, stopped refreshes."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import Tables
from revlens.operators.forecast import actual_vs_forecast
from revlens.plans.inspect import scans
from revlens.sources import refresh as R

DAY = {1996: dt.date(1996, 1, 1), 1997: dt.date(1997, 1, 1), 1998: dt.date(1998, 1, 1)}


def facts(spark, sales, forecast):
    """(fiscal year, product, quantity) rows of both facts."""
    schema = "date date, product_code bigint, customer_code bigint, {} bigint, fiscal_year int"
    frame = lambda rows, name: spark.createDataFrame([(DAY[y], p, 1, q, y) for y, p, q in rows], schema.format(name))
    return Tables(fact_sales_monthly=frame(sales, "sold_quantity"), fact_forecast_monthly=frame(forecast, "forecast_quantity"))


SALES = [(1996, 1, 10), (1996, 2, 20), (1997, 1, 30), (1998, 1, 40)]
FORECAST = [(1996, 1, 11), (1997, 2, 5)]


@pytest.fixture
def db(spark, tmp_path):
    name = f"revlens_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / name}'")
    return name


def rows(df):
    return sorted((tuple(r[c] for c in ("date", "fiscal_year", "product_code", "customer_code", "sold_quantity", "forecast_quantity")) for r in df.collect()), key=str)


def check(spark, db, t):
    assert rows(spark.newSession().table(f"{db}.fact_actual_est")) == rows(actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly))


def files(spark, db):
    """Names and times of the files behind each year."""
    out = {}
    for r in spark.table(f"{db}.fact_actual_est").select("fiscal_year", F.input_file_name().alias("f")).distinct().collect():
        path = r.f.removeprefix("file://")
        out.setdefault(r.fiscal_year, set()).add((path, os.stat(path).st_mtime_ns))
    return out


def test_only_changed_years_are_written(spark, db):
    t = facts(spark, SALES, FORECAST)
    first = R.refresh_actual_est(t, db)
    assert (first.version, first.years) == (1, [1996, 1997, 1998]) and first.changes[1996] == {"added": 2}
    check(spark, db, t)
    before = files(spark, db)
    same = R.refresh_actual_est(t, db)
    assert (same.version, same.years) == (1, []) and files(spark, db) == before and R.versions(spark, db) == [1]
    # 1997: one value updated, one key gone, one new; the others as they were
    t = facts(spark, [(1996, 1, 10), (1996, 2, 20), (1997, 1, 31), (1997, 3, 7), (1998, 1, 40)], [(1996, 1, 11)])
    done = R.refresh_actual_est(t, db)
    assert done.version == 2 and done.changes == {1997: {"updated": 1, "removed": 1, "added": 1}}
    check(spark, db, t)
    after = files(spark, db)
    assert after[1996] == before[1996] and after[1998] == before[1998] and not after[1997] & before[1997]


def test_given_years_only(spark, db):
    t = facts(spark, SALES, FORECAST)
    R.refresh_actual_est(t, db)
    changed = facts(spark, [(1996, 1, 99), (1997, 1, 99)], [])
    done = R.refresh_actual_est(changed, db, [1997, 1998])
    assert done.changes == {1997: {"updated": 1, "removed": 1}, 1998: {"removed": 1}}
    got = rows(spark.table(f"{db}.fact_actual_est"))
    assert [r[1:5] for r in got] == [(1996, 1, 1, 10), (1996, 2, 1, 20), (1997, 1, 1, 99)]
    assert R.refresh_actual_est(changed, db, []).years == []
    scan = scans(spark.table(f"{db}.fact_actual_est").where("fiscal_year = 1997"))[0]
    assert "= 1997)" in scan.split("PartitionFilters:")[1]


@pytest.mark.parametrize("step", ["changed_rows", "_publish", "_point"])
def test_a_stopped_refresh_is_not_seen(spark, db, monkeypatch, step):
    t = facts(spark, SALES, FORECAST)
    R.refresh_actual_est(t, db)
    reader = spark.newSession().table(f"{db}.fact_actual_est")
    want = rows(reader)
    changed = facts(spark, [(1996, 1, 77)], [])
    with monkeypatch.context() as m:
        def stop(*args):
            raise RuntimeError("stopped")
        m.setattr(R, step, stop)
        with pytest.raises(RuntimeError):
            R.refresh_actual_est(changed, db)
    assert R.published(spark, db) == 1 and rows(spark.table(f"{db}.fact_actual_est")) == want == rows(reader)
    assert R.refresh_actual_est(changed, db).version > 1
    check(spark, db, changed)


def test_old_versions_go_with_their_files(spark, db, tmp_path):
    for n in range(4):
        t = facts(spark, [(1996, 1, 10), (1997, 1, n), (1998, 1, 40)], [])
        R.refresh_actual_est(t, db)
    assert R.versions(spark, db) == [1, 2, 3, 4]
    before = files(spark, db)
    assert R.drop_versions(spark, db, keep=1) == [1, 2, 3]
    check(spark, db, t)
    assert files(spark, db) == before
    kept = [p for p, _, names in os.walk(tmp_path / db) if any(x.endswith(".parquet") for x in names)]
    assert len(kept) == 3  # 1996 and 1998 of the first version, 1997 of the last
    assert R.refresh_actual_est(facts(spark, [(1996, 1, 1)], []), db).version == 5


def test_changed_rows_of_nulls_and_repeats(spark):
    schema = "k int, v int"
    old = spark.createDataFrame([(1, 1), (None, 1), (2, None), (3, 3), (3, 3), (4, 4), (4, 5), (6, 1)], schema)
    new = spark.createDataFrame([(1, 1), (None, 2), (2, None), (3, 3), (4, 5), (4, 4), (5, 1), (6, None)], schema)
    assert {tuple(r) for r in R.changed_rows(old, new, ["k"], ["v"]).collect()} == {(None, "updated"), (3, "updated"), (5, "added"), (6, "updated")}
    assert R.changed_rows(old, old, ["k"], ["v"]).count() == 0


def test_whole_table(spark, star, db):
    R.refresh_actual_est(star, db)
    check(spark, db, star)
    later = Tables(fact_sales_monthly=star.fact_sales_monthly.withColumn("sold_quantity", F.col("sold_quantity") + F.when(F.col("fiscal_year") == 1997, 1).otherwise(0)),
                   fact_forecast_monthly=star.fact_forecast_monthly)
    assert R.refresh_actual_est(later, db).years == [1997]
    check(spark, db, later)
