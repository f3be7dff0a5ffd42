import datetime as dt

import pytest

from conftest import Tables
from revlens.operators.forecast import accuracy_decline, actual_vs_forecast, forecast_accuracy
from revlens.operators.supply import forecast_measures

D1, D2 = dt.date(1997, 1, 1), dt.date(1997, 2, 1)
SALES = [(D1, 1997, 1, 100, 10), (D1, 1997, 2, 100, 20), (D1, 1997, 3, 100, 25), (D1, 1997, 4, 100, 5),
         (D1, 1997, 5, 100, 5), (D1, 1997, 7, 100, 10), (D2, 1997, 7, 100, 5)]
FORECAST = [(D1, 1997, 1, 100, 10), (D1, 1997, 2, 100, 10), (D1, 1997, 3, 100, 10), (D1, 1997, 4, 100, 0),
            (D1, 1997, 6, 100, 8), (D1, 1997, 7, 100, 12)]
KEYS = "date date, fiscal_year int, customer_code bigint, product_code bigint"


def _tables(spark):
    sales = spark.createDataFrame(SALES, KEYS + ", sold_quantity bigint")
    fc = spark.createDataFrame(FORECAST, KEYS + ", forecast_quantity bigint")
    cust = spark.createDataFrame([(c, f"C{c}", "M", "R", "ch") for c in range(1, 8)],
                                 "customer_code bigint, customer string, market string, region string, channel string")
    prod = spark.createDataFrame([(100, "P", "v", "S", "D")],
                                 "product_code bigint, product string, variant string, segment string, division string")
    return Tables(fact_sales_monthly=sales, fact_forecast_monthly=fc, dim_customer=cust, dim_product=prod)


def test_accuracy_edges_propagate(spark):
    got = {r.customer_code: r for r in forecast_accuracy(_tables(spark), 1997).collect()}
    assert (got[1].abs_error_pct, got[1].forecast_accuracy) == (0.0, 100.0)     # perfect
    assert (got[2].abs_error_pct, got[2].forecast_accuracy) == (100.0, 0.0)     # exactly 100 %
    assert (got[3].abs_error_pct, got[3].forecast_accuracy) == (150.0, 0.0)     # above 100 %: capped
    assert got[4].abs_error_pct is None and got[4].forecast_accuracy is None    # zero forecast
    assert got[5].total_forecast_quantity is None and got[5].forecast_accuracy is None  # only sales
    assert got[6].total_quantity is None and got[6].net_error is None           # only forecast
    assert (got[7].total_quantity, got[7].net_error, got[7].abs_error) == (15, 2, 2)
    assert (got[7].abs_error_pct, got[7].forecast_accuracy, got[7].net_error_pct) == (16.67, 83.33, 16.7)


def test_accuracy_edges_zero_policy(spark):
    got = {r.customer_code: r for r in forecast_accuracy(_tables(spark), 1997, "zero").collect()}
    assert (got[6].net_error, got[6].abs_error, got[6].forecast_accuracy) == (8, 8, 0.0)
    assert (got[7].net_error, got[7].abs_error, got[7].abs_error_pct, got[7].forecast_accuracy) == (-3, 7, 58.33, 41.67)
    assert got[5].forecast_accuracy is None  # forecast total 0 -> no percentage


def test_full_outer_equals_union_of_left_joins(spark, star):
    s, f = star.fact_sales_monthly, star.fact_forecast_monthly
    keys = ["date", "customer_code", "product_code"]
    left = s.join(f.select(*keys, "forecast_quantity"), keys, "left").select(
        "date", "fiscal_year", "product_code", "customer_code", "sold_quantity", "forecast_quantity")
    right = f.join(s.select(*keys, "sold_quantity"), keys, "left").select(
        "date", "fiscal_year", "product_code", "customer_code", "sold_quantity", "forecast_quantity")
    union = left.union(right).distinct()
    ours = actual_vs_forecast(s, f)
    assert ours.count() == union.count()
    assert ours.exceptAll(union).count() == 0 and union.exceptAll(ours).count() == 0


def test_accuracy_decline_matches_two_reports(spark, star):
    a = {r.customer_code: r.forecast_accuracy for r in forecast_accuracy(star, 1996).collect()}
    b = {r.customer_code: r.forecast_accuracy for r in forecast_accuracy(star, 1997).collect()}
    expect = {c for c in a.keys() & b.keys()
              if a[c] is not None and b[c] is not None and b[c] < a[c]}
    got = {r.customer_code for r in accuracy_decline(star, 1996, 1997).collect()}
    assert got == expect and got


def test_measure_accuracy_blank_rules(spark):
    t = _tables(spark)
    m = {r.customer: r for r in forecast_measures(t, ["customer"]).collect()}
    assert m["C1"].abs_error_pct == 0.0 and m["C1"].forecast_accuracy_pct is None   # perfect -> BLANK
    assert m["C4"].abs_error_pct == 0.0 and m["C4"].forecast_accuracy_pct is None   # no forecast -> BLANK
    assert m["C3"].forecast_accuracy_pct == pytest.approx(-0.5)                      # not capped
    assert m["C6"].risk == "EI" and m["C5"].risk == "OOS" and m["C1"].risk is None
    assert m["C7"].net_error == -3 and m["C7"].abs_error == 7
    one = {r.customer: r for r in forecast_measures(t, ["customer"], perfect_as_one=True).collect()}
    assert one["C1"].forecast_accuracy_pct == 1.0


def test_cells_net_off_customers(spark):
    # two customers in one month x product cell: +5 and -5 net to 0 at product level
    sales = spark.createDataFrame([(D1, 1997, 1, 100, 10), (D1, 1997, 2, 100, 10)], KEYS + ", sold_quantity bigint")
    fc = spark.createDataFrame([(D1, 1997, 1, 100, 15), (D1, 1997, 2, 100, 5)], KEYS + ", forecast_quantity bigint")
    t = _tables(spark)
    t.fact_sales_monthly, t.fact_forecast_monthly = sales, fc
    by_segment = forecast_measures(t, ["segment"]).first()
    by_customer = forecast_measures(t, ["customer"]).agg({"abs_error": "sum"}).first()[0]
    assert by_segment.abs_error == 0 and by_customer == 10


def test_forecast_after_last_sales_month_ignored(spark):
    t = _tables(spark)
    late = spark.createDataFrame([(dt.date(1997, 9, 1), 1998, 1, 100, 99)], KEYS + ", forecast_quantity bigint")
    t.fact_forecast_monthly = t.fact_forecast_monthly.unionByName(late)
    m = forecast_measures(t, ["fiscal_year", "customer"])
    assert m.filter("fiscal_year = 1998").count() == 0
