"""Results do not depend on the session time zone or timestamp inference."""

import datetime as dt

from revlens.reports import QUERIES

SF = "/root/testdata/sf0.001"


def test_dates_stable_under_other_time_zone(spark):
    base = QUERIES["fiscal_calendar"](spark, SF).orderBy("date").first()
    ns = sorted(map(tuple, QUERIES["net_sales_by_customer"](spark, SF).collect()))
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_ntz = spark.conf.get("spark.sql.parquet.inferTimestampNTZ.enabled")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    try:
        other = QUERIES["fiscal_calendar"](spark, SF).orderBy("date").first()
        assert other == base and other.date == dt.date(1995, 1, 1)
        assert sorted(map(tuple, QUERIES["net_sales_by_customer"](spark, SF).collect())) == ns
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", old_ntz)


def test_results_stable_with_ansi_off(spark):
    names = ["forecast_accuracy", "customer_contribution", "pl_matrix", "sc_measures"]
    base = {n: sorted(map(repr, QUERIES[n](spark, SF).collect())) for n in names}
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for n in names:
            assert sorted(map(repr, QUERIES[n](spark, SF).collect())) == base[n], n
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
