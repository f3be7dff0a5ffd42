"""Supply-chain measures of the dashboard (forecast quantity, errors, accuracy, risk).

Semantics follow the measure language: BLANK is NULL; in +/- a BLANK acts as
0 unless both sides are BLANK; DIVIDE(a, b, 0) is 0 for a BLANK or zero b;
accuracy ``1 - abs_error_pct`` is BLANK when the percentage is BLANK *or 0*
(so a perfect forecast shows BLANK unless ``perfect_as_one``).

The absolute error is computed per month x product cell, where customers in
the same cell net off, and then summed. Both steps are hash aggregates with
map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import RISK_EXCESS_INVENTORY, RISK_OUT_OF_STOCK
from revlens.functions.arith import blank_sub, divide
from revlens.plans.periods import calendar_periods, with_prior_period

_CUSTOMER_ATTRS = {"customer", "market", "region", "channel"}
_PRODUCT_ATTRS = {"product", "variant", "segment", "division"}


def _with_dims(df: DataFrame, t, dims: list[str]) -> DataFrame:
    need_c = [d for d in dims if d in _CUSTOMER_ATTRS]
    need_p = [d for d in dims if d in _PRODUCT_ATTRS]
    if need_c:
        df = df.join(t.dim_customer.select("customer_code", *need_c), "customer_code")
    if need_p:
        df = df.join(t.dim_product.select("product_code", *need_p), "product_code")
    return df


def quantities(t, cutoff=None) -> DataFrame:
    """Sales and forecast rows stacked with the columns fq (forecast) and aq (actual).

    Forecast rows after the last sales month are dropped (the measure only
    counts forecasts up to that month). The cutoff defaults to the latest
    sales month, a scalar subquery evaluated once.
    """
    sales, fc = t.fact_sales_monthly, t.fact_forecast_monthly
    last = F.lit(cutoff) if cutoff is not None else sales.agg(F.max("date")).scalar()
    keys = ["date", "fiscal_year", "customer_code", "product_code"]
    f = fc.filter(F.col("date") <= last).select(
        *keys, F.col("forecast_quantity").alias("fq"), F.lit(None).cast("bigint").alias("aq"))
    s = sales.select(*keys, F.lit(None).cast("bigint").alias("fq"),
                     F.col("sold_quantity").alias("aq"))
    return f.unionByName(s)


def forecast_sums(t, dims: list[str], cutoff=None) -> DataFrame:
    """Forecast qty, actual qty and cell-level absolute error aggregated at ``dims``."""
    q = _with_dims(quantities(t, cutoff), t, dims)
    cells = (q.groupBy(*dims, "date", "product_code")
             .agg(F.sum("fq").alias("fq"), F.sum("aq").alias("aq")))
    return (cells.groupBy(*dims)
            .agg(F.sum("fq").alias("forecast_qty"), F.sum("aq").alias("actual_qty"),
                 F.sum(F.abs(blank_sub("fq", "aq"))).alias("abs_error")))


def forecast_drill(t, levels: list[str], fiscal_year: int, cutoff=None, perfect_as_one: bool = False) -> DataFrame:
    """Forecast measures at every level of a drill path (e.g. region > market > customer), with last year.

    The absolute error is not additive: customers of one month and product net
    off, so a market's error is less than the sum of its customers'. Quantities
    are summed to the leaf's cells (month x product) once; those sums are then
    taken to the cells of every level under grouping sets, the error is formed
    cell by cell at each level, and only then summed. ``level`` is the grouping
    id (0 = leaf, all bits set = grand total), as in ``pl.pl_drill``.
    """
    both_years = F.col("fiscal_year").isin(fiscal_year, fiscal_year - 1)
    q = _with_dims(quantities(t, cutoff).filter(both_years), t, levels)
    cell = ["fiscal_year", "date", "product_code"]
    leaf = q.groupBy(*levels, *cell).agg(F.sum("fq").alias("fq"), F.sum("aq").alias("aq"))
    paths = [[*levels[:n], *cell] for n in range(len(levels), -1, -1)]
    cells = leaf.groupingSets([[F.col(c) for c in path] for path in paths], *[*levels, *cell]).agg(
        # the cell's columns are in every set: their bits, the lowest, are 0
        F.expr(f"cast(shiftright(grouping_id(), {len(cell)}) AS int)").alias("level"), F.sum("fq").alias("fq"), F.sum("aq").alias("aq"))
    sums = []
    for year, suffix in ((fiscal_year, ""), (fiscal_year - 1, "_ly")):
        here = F.col("fiscal_year") == year
        sums += [F.sum(F.when(here, F.col(c))).alias(name + suffix) for c, name in (("fq", "forecast_qty"), ("aq", "actual_qty"))]
        sums.append(F.sum(F.when(here, F.abs(blank_sub("fq", "aq")))).alias(f"abs_error{suffix}"))
    out = cells.groupBy(*levels, "level").agg(*sums)
    out = derive_forecast(derive_forecast(out, "", perfect_as_one), "_ly", perfect_as_one)
    return out.select(*levels, "level", "forecast_qty", "actual_qty", "net_error", "net_error_pct", "abs_error", "abs_error_pct",
                      "forecast_accuracy_pct", "risk", "abs_error_ly", "forecast_accuracy_pct_ly")


def derive_forecast(df: DataFrame, suffix: str = "", perfect_as_one: bool = False) -> DataFrame:
    """Net error, percentages, accuracy and risk from the three sums."""
    fq, aq, ae = (F.col(f"{c}{suffix}") for c in ("forecast_qty", "actual_qty", "abs_error"))
    ne = blank_sub(fq, aq)
    ae_pct = divide(ae, fq, 0)
    keep = ae_pct.isNotNull() if perfect_as_one else (ae_pct.isNotNull() & (ae_pct != 0))
    return (df.withColumn(f"net_error{suffix}", ne)
            .withColumn(f"net_error_pct{suffix}", divide(ne, fq, 0))
            .withColumn(f"abs_error_pct{suffix}", ae_pct)
            .withColumn(f"forecast_accuracy_pct{suffix}", F.when(keep, F.lit(1.0) - ae_pct))
            .withColumn(f"risk{suffix}", F.when(ne > 0, F.lit(RISK_EXCESS_INVENTORY)).when(ne < 0, F.lit(RISK_OUT_OF_STOCK))))


def forecast_measures(t, dims: list[str], cutoff=None, perfect_as_one: bool = False) -> DataFrame:
    """Forecast Qty, Actual Qty, Net Error (%), ABS Error (%), Forecast Accuracy %, Risk."""
    return derive_forecast(forecast_sums(t, dims, cutoff), perfect_as_one=perfect_as_one)


def forecast_measures_ly(t, dims: list[str], period: str = "fiscal_year", cutoff=None,
                         perfect_as_one: bool = False) -> DataFrame:
    """Measures plus their same-period-last-year values (``*_ly`` columns).

    ``dims`` must contain ``period`` (``fiscal_year``, or ``date`` for months).
    The prior period comes from the same aggregate shifted one year forward
    (a calendar shift, so gaps give NULL, not the previous row), merged in
    without a self-join (``plans.periods``); the periods are those of the date
    dimension if there is one, so both facts are read once.
    """
    sums = forecast_sums(t, dims, cutoff)
    dim_date = getattr(t, "dim_date", None)
    known = None if dim_date is None else calendar_periods(dim_date, period)
    both = with_prior_period(sums, dims, period, ["forecast_qty", "actual_qty", "abs_error"], known=known)
    both = derive_forecast(both, perfect_as_one=perfect_as_one)
    return derive_forecast(both, suffix="_ly", perfect_as_one=perfect_as_one)
