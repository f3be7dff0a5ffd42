"""Named reports: each takes (spark, source folder) and returns a lazy DataFrame.

Default parameters of the test suite: fiscal year 1997 (prior 1996),
customer 7, customer list '7,8,9', brand 'Brand#1'.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.text import plain
from revlens.operators import (contribution as C, coverage as CV, finance as FN, forecast as FC, market as MK,
                               measures as M, pages as PG, pl as PL, ranking as R, supply as SC,
                               waterfall as W)
from revlens.operators.output import decimals_to_double
from revlens.plans.periods import calendar_periods
from revlens.session import shared_folder
from revlens.sources.catalog import register
from revlens.sources.lattice import Lattice
from revlens.sources.star import Star

FY = 1997
FY_PRIOR = 1996
CUSTOMER = 7
CUSTOMER_LIST = "7,8,9"
BRAND = "Brand#1"
GM_TOLERANCE = 0.001

_PL_MEASURE_COLS = ["gross_sales", "pre_invoice_deduction", "net_invoice_sales", "post_invoice_deduction",
                    "post_invoice_other_deduction", "net_sales", "manufacturing_cost", "freight_cost",
                    "other_cost", "total_cogs", "gross_margin", "gross_margin_pct", "sold_quantity",
                    "gm_per_unit", "ads_promotions", "other_operational_expense", "operational_expense",
                    "net_profit", "net_profit_pct"]


def _star(spark: SparkSession, root: str) -> Star:
    return Star.load(spark, root)


def fiscal_calendar(spark, root):
    return FN.fiscal_calendar(_star(spark, root))


def product_gross_sales(spark, root):
    return FN.product_gross_sales(_star(spark, root), CUSTOMER, FY)


def monthly_gross_sales(spark, root):
    return FN.monthly_gross_sales(_star(spark, root), CUSTOMER)


def yearly_gross_sales(spark, root):
    return FN.yearly_gross_sales(_star(spark, root), CUSTOMER)


def monthly_gross_sales_multi(spark, root):
    return FN.monthly_gross_sales(_star(spark, root), CUSTOMER_LIST)


def waterfall_gross(spark, root):
    return decimals_to_double(W.gross_sales(_star(spark, root)))


def net_invoice_sale_fy(spark, root):
    return decimals_to_double(W.net_invoice_sale_fy(_star(spark, root), FY))


def waterfall_net_invoice(spark, root):
    t = _star(spark, root)
    pre = W.with_pre_invoice(W.gross_sales(t), t)
    return decimals_to_double(pre.withColumn("net_invoice_sale", W.net_invoice_sale()))


def waterfall_post_invoice(spark, root):
    return decimals_to_double(W.post_invoice_sales(_star(spark, root)))


def waterfall_net_sales(spark, root):
    return decimals_to_double(W.net_sales(_star(spark, root), keep_components=False))


def net_sales_by_customer(spark, root):
    out = C.net_sales_by(_star(spark, root), ["customer"], FY)
    return decimals_to_double(out).orderBy(F.desc("net_sales_mln"), "customer")


def net_sales_by_customer_region(spark, root):
    out = C.net_sales_by(_star(spark, root), ["customer", "region"], FY)
    return decimals_to_double(out).orderBy(F.desc("net_sales_mln"), "customer", "region")


def customer_contribution(spark, root):
    out = C.contribution(C.net_sales_by(_star(spark, root), ["customer"], FY), "net_sales_mln")
    return decimals_to_double(out).orderBy(F.desc("net_sales_mln"), "customer")


def customer_contribution_region(spark, root):
    by = C.net_sales_by(_star(spark, root), ["customer", "region"], FY)
    out = C.contribution(by, "net_sales_mln", within=["region"], alias="pct_by_region")
    return decimals_to_double(out).orderBy("region", F.desc("net_sales_mln"), "customer")


def market_contribution(spark, root):
    out = C.contribution(C.net_sales_by(_star(spark, root), ["market"], FY), "net_sales_mln")
    return decimals_to_double(out).orderBy(F.desc("net_sales_mln"), "market")


def top_products(spark, root):
    by = C.net_sales_by(_star(spark, root), ["product"], FY)
    return decimals_to_double(R.top_n(by, "net_sales_mln", 5, tie_break=["product"]))


def top_markets_per_region(spark, root):
    by = C.gross_sales_by(_star(spark, root), ["market", "region"], FY)
    out = R.top_k_per_group(by, ["region"], "gross_sales_mln", 2, method="dense_rank", rank_col="rnk")
    return decimals_to_double(out).orderBy("region", F.desc("gross_sales_mln"), "market")


def top_products_per_division(spark, root):
    qty = C.quantity_by(_star(spark, root), ["division", "product"], FY)
    out = R.top_k_per_group(qty, ["division"], "total_quantity", 3, method="dense_rank", rank_col="drank")
    return out.orderBy("division", "drank", "product")


def ranking_compare(spark, root):
    out = R.ranking_compare(_star(spark, root).expenses, "category", "amount", 4, tie_break=["expense_id"])
    return out.orderBy("category", "rn")


def expense_ranks(spark, root):
    return R.all_ranks(_star(spark, root).expenses, "category", "amount", tie_break=["expense_id"])


def actual_est(spark, root):
    t = _star(spark, root)
    return FC.actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly)


def forecast_accuracy(spark, root):
    return FC.forecast_accuracy(_star(spark, root), FY)


def forecast_accuracy_zero(spark, root):
    return FC.forecast_accuracy(_star(spark, root), FY, null_policy="zero")


def accuracy_decline(spark, root):
    return FC.accuracy_decline(_star(spark, root), FY_PRIOR, FY)


def pl_measures(spark, root):
    t = _star(spark, root)
    dims = ["fiscal_year", "market"]
    return M.output(M.measures(t.fact_actuals_estimates, dims), dims + _PL_MEASURE_COLS)


def pl_last_year(spark, root):
    t = _star(spark, root)
    dims = ["fiscal_year", "market"]
    known = calendar_periods(t.dim_date, "fiscal_year")
    m = M.with_benchmark(M.measures_ly(t.fact_actuals_estimates, dims, known=known), "ly")
    return M.output(m, dims + ["net_sales", "net_sales_ly", "gross_margin_pct", "gross_margin_pct_ly",
                               "net_profit_pct", "net_profit_pct_ly", "net_sales_bm",
                               "gross_margin_pct_bm", "net_profit_pct_bm"])


def _lattice(spark: SparkSession, t: Star, sets: list[tuple[str, ...]]) -> Lattice:
    """Sums of the P&L fact, written to the shared folder under a name of their own."""
    return Lattice.build(spark, t.fact_actuals_estimates, f"{shared_folder(spark)}/lattice-{uuid.uuid4().hex}", sets)


def pl_vs_target(spark, root):
    """Amounts and targets by market and year; those of a derived star both come from sums
    that are written to the shared folder first, so that the lines are joined once."""
    t = _star(spark, root)
    dims = ["fiscal_year", "market"]
    if t.derives_targets_from(t.fact_actuals_estimates):
        t = _lattice(spark, t, [("market",)]).star_for(t, dims)
    m = M.with_benchmark(M.with_targets(M.measures(t.fact_actuals_estimates, dims), t, dims), "target")
    return M.output(m, dims + ["net_sales", "ns_target", "gm_target", "np_target", "gross_margin_pct",
                               "gross_margin_pct_target", "net_profit_pct", "net_profit_pct_target",
                               "net_sales_bm", "gross_margin_pct_bm", "net_profit_pct_bm"])


def gm_gap_flag(spark, root):
    t = _star(spark, root)
    dims = ["fiscal_year", "market"]
    known = calendar_periods(t.dim_date, "fiscal_year")
    m = M.gap_flag(M.with_benchmark(M.measures_ly(t.fact_actuals_estimates, dims, known=known), "ly"), GM_TOLERANCE)
    return M.output(m, dims + ["gross_margin_pct", "gross_margin_pct_bm", "gross_margin_pct_variance",
                               "gross_margin_pct_flag"])


def sc_measures(spark, root):
    dims = ["fiscal_year", "customer"]
    m = SC.forecast_measures(_star(spark, root), dims)
    return m.select(*dims, "forecast_qty", "actual_qty", "net_error", "net_error_pct", "abs_error",
                    "abs_error_pct", "forecast_accuracy_pct", "risk")


def sc_last_year(spark, root):
    dims = ["fiscal_year", "customer"]
    m = SC.forecast_measures_ly(_star(spark, root), dims)
    return m.select(*dims, "abs_error", "abs_error_ly", "forecast_accuracy_pct", "forecast_accuracy_pct_ly")


def risk_flags(spark, root):
    dims = ["fiscal_year", "segment"]
    m = SC.forecast_measures_ly(_star(spark, root), dims)
    return m.select(*dims, "forecast_qty", "actual_qty", "net_error", "forecast_accuracy_pct",
                    "forecast_accuracy_pct_ly", "risk")


def market_share(spark, root):
    return MK.market_share(_star(spark, root).marketshare, ["fiscal_year", "manufacturer"])


def own_market_share(spark, root):
    return MK.own_market_share(_star(spark, root).marketshare, ["fiscal_year"], BRAND)


def pl_rows(spark, root):
    t = _star(spark, root)
    return PL.pl_rows(t.fact_actuals_estimates, t, ["fiscal_year"])


def pl_matrix(spark, root):
    t = _star(spark, root)
    return PL.pl_statement(t.fact_actuals_estimates, t, FY, benchmark="ly")


def pl_matrix_target(spark, root):
    t = _star(spark, root)
    return PL.pl_statement(t.fact_actuals_estimates, t, FY, dims=["market"], benchmark="target")


def pl_drill(spark, root):
    return PL.pl_drill(_star(spark, root).fact_actuals_estimates, ["region", "market", "product"], FY)


def performance_matrix(spark, root):
    return PG.performance_matrix(_star(spark, root).fact_actuals_estimates, ["customer"], FY)


def performance_matrix_product(spark, root):
    return PG.performance_matrix(_star(spark, root).fact_actuals_estimates, ["product"], FY)


def segment_scorecard(spark, root):
    return PG.segment_scorecard(_star(spark, root).fact_actuals_estimates, ["segment"], FY)


def segment_scorecard_market(spark, root):
    return PG.segment_scorecard(_star(spark, root).fact_actuals_estimates, ["market"], FY)


def segment_scorecard_market_target(spark, root):
    t = _star(spark, root)
    return PG.segment_scorecard(t.fact_actuals_estimates, ["market"], FY, "target", t)


def kpi_trend_ly(spark, root):
    t = _star(spark, root)
    return PG.kpi_trend_ly(t.fact_actuals_estimates, known=calendar_periods(t.dim_date, "date"))


def sc_kpis_customer(spark, root):
    return PG.supply_kpis(_star(spark, root), ["fiscal_year", "customer"])


def sc_kpis_segment(spark, root):
    return PG.supply_kpis(_star(spark, root), ["fiscal_year", "segment"])


def pl_drill_ly(spark, root):
    return PL.pl_drill_ly(_star(spark, root).fact_actuals_estimates, ["region", "market"], FY)


def pl_drill_target(spark, root):
    t = _star(spark, root)
    return PL.pl_drill_target(t.fact_actuals_estimates, t, ["region", "market"], FY)


def revenue_split(spark, root):
    return PG.revenue_split(_star(spark, root).fact_actuals_estimates, ["channel"], FY)


def revenue_split_division(spark, root):
    return PG.revenue_split(_star(spark, root).fact_actuals_estimates, ["division"], FY)


def region_scorecard(spark, root):
    t = _star(spark, root)
    return PG.region_scorecard(t.fact_actuals_estimates, t, FY)


def kpi_trend(spark, root):
    return PG.kpi_trend(_star(spark, root).fact_actuals_estimates)


def kpi_series_channel_market(spark, root):
    t = _star(spark, root)
    return PG.kpi_series(t.fact_actuals_estimates, ["channel", "market"], t.dim_date)


def sc_drill(spark, root):
    return SC.forecast_drill(_star(spark, root), ["region", "market", "customer"], FY)


def region_scorecard_lattice(spark, root):
    """The region page from a stored lattice (written to the shared folder first)."""
    t = _star(spark, root)
    lattice = _lattice(spark, t, [("region", "market", "date"), ("region", "market")])
    small = lattice.star_for(t, ["region"], ["net_sales", "gross_margin_pct", "net_profit_pct"])
    return PG.region_scorecard(small.fact_actuals_estimates, small, FY)


def _mixed_case(spark, root) -> Star:
    """The star with the markets of odd customer codes written in lower case, compared without case."""
    t = _star(spark, root)
    odd = F.col("customer_code") % 2 == 1
    t.dim_customer = t.dim_customer.withColumn("market", F.when(odd, F.lower("market")).otherwise(F.col("market")))
    return t.caseless()


def market_contribution_caseless(spark, root):
    out = C.contribution(C.net_sales_by(_mixed_case(spark, root), ["market"], FY), "net_sales_mln")
    return decimals_to_double(plain(out)).orderBy(F.desc("net_sales_mln"), "market")


def top_markets_per_region_caseless(spark, root):
    by = C.gross_sales_by(_mixed_case(spark, root), ["market", "region"], FY)
    out = R.top_k_per_group(by, ["region"], "gross_sales_mln", 2, method="dense_rank", rank_col="rnk")
    return decimals_to_double(plain(out)).orderBy("region", F.desc("gross_sales_mln"), "market")


def sales_coverage(spark, root):
    return CV.coverage_report(_star(spark, root))


def unpriced_sales(spark, root):
    lost = CV.lost_lines(_star(spark, root), FY, step="price")
    return lost.groupBy("product_code").agg(F.count("*").alias("lines"), F.sum("sold_quantity").alias("sold_quantity"))


def call_forecast_accuracy(spark, root):
    register(spark, _star(spark, root))
    return spark.sql(f"SELECT * FROM get_forecast_accuracy({FY})")


def call_monthly_gross_sales(spark, root):
    register(spark, _star(spark, root))
    return spark.sql(f"SELECT * FROM get_monthly_gross_sales_for_customer({CUSTOMER})")


def call_monthly_gross_sales_multi(spark, root):
    register(spark, _star(spark, root))
    return spark.sql(f"SELECT * FROM get_monthly_gross_sales_for_customer_multi('{CUSTOMER_LIST}')")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in [
    fiscal_calendar, product_gross_sales, monthly_gross_sales, yearly_gross_sales,
    monthly_gross_sales_multi, waterfall_gross, net_invoice_sale_fy, waterfall_net_invoice,
    waterfall_post_invoice, waterfall_net_sales, net_sales_by_customer, net_sales_by_customer_region,
    customer_contribution, customer_contribution_region, market_contribution, top_products,
    top_markets_per_region, top_products_per_division, ranking_compare, actual_est, forecast_accuracy,
    forecast_accuracy_zero, accuracy_decline, pl_measures, pl_last_year, pl_vs_target, gm_gap_flag,
    sc_measures, sc_last_year, risk_flags, market_share, own_market_share, pl_rows, pl_matrix,
    pl_matrix_target, pl_drill, performance_matrix, performance_matrix_product, segment_scorecard,
    segment_scorecard_market, revenue_split, revenue_split_division, region_scorecard, kpi_trend,
    segment_scorecard_market_target, kpi_trend_ly, sc_kpis_customer, sc_kpis_segment, pl_drill_ly, pl_drill_target,
    region_scorecard_lattice, expense_ranks, sc_drill, kpi_series_channel_market, market_contribution_caseless, top_markets_per_region_caseless, sales_coverage, unpriced_sales, call_forecast_accuracy, call_monthly_gross_sales, call_monthly_gross_sales_multi,
]}
