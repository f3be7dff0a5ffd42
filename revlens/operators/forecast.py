"""Actuals vs forecast: the unified table and forecast accuracy per customer.

Two accuracy definitions exist and are kept apart:

* this module (report SQL): line-grain errors summed per customer, accuracy in
  0..100, rounded, capped at 0 above 100 % error;
* ``operators.supply`` (dashboard measures): errors netted per month x product
  cell, accuracy in 0..1, uncapped, with BLANK rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import (ABS_ERROR_PCT_DIGITS, ACCURACY_CAP_PCT, ACCURACY_DIGITS,
                                   NET_ERROR_PCT_DIGITS)
from revlens.functions.arith import round_ratio, sql_div

KEYS = ["date", "customer_code", "product_code"]


def actual_vs_forecast(sales: DataFrame, forecast: DataFrame,
                       fiscal_years: list[int] | None = None, distinct: bool = False) -> DataFrame:
    """Every (date, customer, product) with its sold and forecast quantity.

    One full outer join replaces "left join both ways, then UNION": the two
    are equal when each key is unique on each side (true for monthly facts).
    Either quantity is NULL when the other side has no row; fiscal_year is
    taken from whichever side has the row.

    ``fiscal_years`` restricts the result to those years by filtering both
    inputs before the join (partition pruning, a smaller shuffle). That is
    exact because the fiscal year is a function of the date and the date is
    a join key: matching rows always share their fiscal year. An empty list
    keeps no year. ``distinct`` drops equal rows, which gives the UNION form
    for inputs whose keys repeat (``operators.checks`` tests for that).
    """
    if fiscal_years is not None:
        sales = sales.filter(F.col("fiscal_year").isin(*fiscal_years))
        forecast = forecast.filter(F.col("fiscal_year").isin(*fiscal_years))
    s = sales.select(*KEYS, F.col("fiscal_year").alias("_fy_sales"), "sold_quantity")
    f = forecast.select(*KEYS, F.col("fiscal_year").alias("_fy_forecast"), "forecast_quantity")
    out = (s.join(f, KEYS, "full_outer")
           .select("date", F.coalesce("_fy_sales", "_fy_forecast").alias("fiscal_year"),
                   "product_code", "customer_code", "sold_quantity", "forecast_quantity"))
    return out.distinct() if distinct else out


def key_duplicates(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys occurring more than once (lazy). ``actual_vs_forecast`` equals the
    "left joins + UNION" form only when this is empty on both inputs."""
    keys = keys or KEYS
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def _quantities(null_policy: str) -> tuple[Column, Column]:
    sold, fc = F.col("sold_quantity"), F.col("forecast_quantity")
    if null_policy == "zero":
        return F.coalesce(sold, F.lit(0)), F.coalesce(fc, F.lit(0))
    if null_policy != "propagate":
        raise ValueError("null_policy must be 'propagate' or 'zero'")
    return sold, fc


def error_sums(null_policy: str = "propagate", when: Column | None = None,
               suffix: str = "") -> list[Column]:
    """Aggregate expressions of the accuracy report, optionally conditional.

    With ``propagate`` a row missing either quantity adds to the totals but
    not to the errors (NULL arithmetic); ``zero`` counts it as 0.
    """
    sold, fc = _quantities(null_policy)
    err = fc - sold
    if when is not None:
        sold, fc, err = (F.when(when, x) for x in (sold, fc, err))
    return [F.sum(sold).alias(f"total_quantity{suffix}"),
            F.sum(fc).alias(f"total_forecast_quantity{suffix}"),
            F.sum(err).alias(f"net_error{suffix}"),
            F.sum(F.abs(err)).alias(f"abs_error{suffix}")]


def _pct(num: str, den: str, digits: int) -> Column:
    return round_ratio(sql_div(F.col(num) * F.lit(100.0).cast("decimal(4,1)"), F.col(den)), digits)


def accuracy_from(abs_error_pct: Column) -> Column:
    """0 when the error exceeds 100 %, else ROUND(100 - pct, 2); NULL stays NULL."""
    return (F.when(abs_error_pct > ACCURACY_CAP_PCT, F.lit(0))
            .otherwise(F.round(F.lit(100.0).cast("decimal(4,1)") - abs_error_pct, ACCURACY_DIGITS)))


def forecast_accuracy(t, fiscal_year: int, null_policy: str = "propagate") -> DataFrame:
    """Forecast accuracy report per customer for one fiscal year.

    Columns: customer_code, total_quantity, total_forecast_quantity,
    net_error, net_error_pct, abs_error, abs_error_pct, customer, market,
    forecast_accuracy.
    """
    ae = actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly, [fiscal_year])
    per_customer = (ae.groupBy("customer_code").agg(*error_sums(null_policy))
                    .withColumn("net_error_pct", _pct("net_error", "total_forecast_quantity", NET_ERROR_PCT_DIGITS))
                    .withColumn("abs_error_pct", _pct("abs_error", "total_forecast_quantity", ABS_ERROR_PCT_DIGITS)))
    out = (per_customer.join(t.dim_customer.select("customer_code", "customer", "market"),
                             "customer_code")
           .withColumn("forecast_accuracy", accuracy_from(F.col("abs_error_pct")))
           .select("customer_code", "total_quantity", "total_forecast_quantity", "net_error",
                   F.col("net_error_pct").cast("double").alias("net_error_pct"), "abs_error",
                   F.col("abs_error_pct").cast("double").alias("abs_error_pct"), "customer", "market",
                   F.col("forecast_accuracy").cast("double").alias("forecast_accuracy")))
    return out.orderBy(F.col("forecast_accuracy").desc_nulls_last(), "customer_code")


def accuracy_decline(t, fy_before: int, fy_after: int, null_policy: str = "propagate") -> DataFrame:
    """Customers whose forecast accuracy in ``fy_after`` is below ``fy_before``.

    One scan and one aggregation: the sums of both years are conditional
    aggregates of the same group-by, instead of two materialised per-year
    tables joined afterwards.
    """
    ae = actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly, [fy_before, fy_after])
    aggs = (error_sums(null_policy, F.col("fiscal_year") == fy_before, "_b")
            + error_sums(null_policy, F.col("fiscal_year") == fy_after, "_a"))
    acc_b, acc_a = f"forecast_acc_{fy_before}", f"forecast_acc_{fy_after}"
    per_customer = (ae.groupBy("customer_code").agg(*aggs)
                    .withColumn(acc_b, accuracy_from(_pct("abs_error_b", "total_forecast_quantity_b", ABS_ERROR_PCT_DIGITS)))
                    .withColumn(acc_a, accuracy_from(_pct("abs_error_a", "total_forecast_quantity_a", ABS_ERROR_PCT_DIGITS)))
                    .filter(F.col(acc_a) < F.col(acc_b)))
    out = (per_customer.join(t.dim_customer.select("customer_code", F.col("customer").alias("customer_name"),
                                                   "market"), "customer_code")
           .select("customer_code", "customer_name", "market",
                   F.col(acc_b).cast("double").alias(acc_b), F.col(acc_a).cast("double").alias(acc_a)))
    return out.orderBy(F.col(acc_b).desc(), "customer_code")
