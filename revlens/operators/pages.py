"""Datasets behind the dashboard pages (scorecards, matrices, splits, trends)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.arith import divide
from revlens.operators.measures import (BASE, base_sums, measures, measures_ly, measures_with_prior, with_benchmark,
                                        with_derived, with_last_year, with_targets)
from revlens.operators.output import decimals_to_double
from revlens.operators.supply import forecast_measures_ly
from revlens.plans.joins import attach_row
from revlens.plans.periods import calendar_periods
from revlens.plans.spine import with_every_month


def performance_matrix(fact: DataFrame, dims: list[str], fiscal_year: int) -> DataFrame:
    """Net sales and GM % per group next to the overall GM % of the year."""
    fy = fact.filter(F.col("fiscal_year") == fiscal_year)
    groups = measures(fy, dims)
    # the overall figure sums the group sums (exact decimals), so it reuses the
    # group aggregate instead of scanning the fact a second time
    overall = with_derived(groups.agg(*[F.sum(c).alias(c) for c in BASE])).select(
        F.col("gross_margin_pct").alias("overall_gross_margin_pct"))
    out = (attach_row(groups, overall)
           .withColumn("gm_pct_vs_overall", F.col("gross_margin_pct") - F.col("overall_gross_margin_pct"))
           .select(*dims, "net_sales", "gross_margin", "gross_margin_pct", "overall_gross_margin_pct",
                   "gm_pct_vs_overall"))
    return decimals_to_double(out)


def segment_scorecard(fact: DataFrame, dims: list[str], fiscal_year: int, benchmark: str = "ly",
                      t=None) -> DataFrame:
    """Net profit % and gross margin % against a benchmark, with changes and a decline flag.

    ``benchmark`` is ``ly`` or ``target`` (needs the star ``t``; NULL for dims
    without targets). The flag is 1 when net profit % fell short, and for a
    group that sold last year and nothing this year. A group with a target and
    no sales is a row.
    """
    m = measures_with_prior(fact, dims, fiscal_year)
    if benchmark == "target":
        m = with_targets(m, t, dims, blank_ratio=True, fiscal_year=fiscal_year)
    m = with_benchmark(m, benchmark)
    np_change = F.col("net_profit_pct") - F.col("net_profit_pct_bm")
    gm_change = F.col("gross_margin_pct") - F.col("gross_margin_pct_bm")
    lapsed = F.col("net_sales").isNull() & F.col("net_sales_ly").isNotNull()
    out = m.select(*dims, "net_sales", "net_profit_pct", "net_profit_pct_bm",
                   np_change.alias("net_profit_pct_change"), "gross_margin_pct", "gross_margin_pct_bm",
                   gm_change.alias("gross_margin_pct_change"),
                   F.when(lapsed | (np_change < 0), 1).otherwise(0).alias("decline_flag"))
    return decimals_to_double(out)


def revenue_split(fact: DataFrame, dims: list[str], fiscal_year: int) -> DataFrame:
    """Net sales per group and its share of the year's total (DIVIDE semantics)."""
    fy = fact.filter(F.col("fiscal_year") == fiscal_year)
    groups = fy.groupBy(*dims).agg(F.sum("net_sales_amount").alias("net_sales"))
    total = groups.agg(F.sum("net_sales").alias("total_net_sales"))
    out = (attach_row(groups, total)
           .withColumn("share", divide("net_sales", "total_net_sales", 0))
           .select(*dims, "net_sales", "share"))
    return decimals_to_double(out)


def region_scorecard(fact: DataFrame, t, fiscal_year: int, dims: list[str] | None = None) -> DataFrame:
    """One row per region that sold this year or last or has a target: NS, GM %, NP % with last-year and target values."""
    dims = dims or ["region"]
    m = measures_with_prior(fact, dims, fiscal_year)
    m = with_targets(m, t, dims, fiscal_year=fiscal_year)
    out = m.select(*dims, "net_sales", "net_sales_ly", F.col("ns_target").alias("net_sales_target"),
                   "gross_margin_pct", "gross_margin_pct_ly", "gross_margin_pct_target",
                   "net_profit_pct", "net_profit_pct_ly", "net_profit_pct_target")
    return decimals_to_double(out)


def kpi_trend(fact: DataFrame, period: str = "date") -> DataFrame:
    """Monthly KPI series: net sales, GM %, NP % and quantity per month."""
    m = measures(fact, [period])
    return decimals_to_double(m.select(period, "net_sales", "gross_margin_pct", "net_profit_pct",
                                       "sold_quantity")).orderBy(period)


def kpi_series(fact: DataFrame, dims: list[str], dim_date: DataFrame) -> DataFrame:
    """The monthly KPI series of each ``dims`` group with last year's values, without gaps.

    Every month between a group's first and last is a row. A month without sales
    has NULL amounts and ratios (no sales is not a margin of 0); its last-year
    values are those of the month a year before. The series of a group that sold
    a year ago and not since goes on as long as there is a month to compare with.
    """
    keys = [*dims, "date"]
    sums = fact.groupBy(*keys).agg(*base_sums())
    both = with_last_year(sums, keys, "date", list(BASE), known=calendar_periods(dim_date, "date"))
    months = with_every_month(both, dim_date, dims)
    m = with_derived(with_derived(months, "", blank_ratio=True), "_ly", blank_ratio=True)
    kpis = ["net_sales", "gross_margin_pct", "net_profit_pct", "sold_quantity"]
    return decimals_to_double(m.select(*keys, *[c for k in kpis for c in (k, f"{k}_ly")]))


def direction(current: str, prior: str) -> Column:
    """``up``, ``down`` or ``flat`` against the prior value; NULL when either is missing."""
    return (F.when(F.col(current) > F.col(prior), "up").when(F.col(current) < F.col(prior), "down")
            .when(F.col(current) == F.col(prior), "flat"))


def kpi_trend_ly(fact: DataFrame, period: str = "date", known: DataFrame | None = None) -> DataFrame:
    """The KPI series with the same month of last year, the change and its direction."""
    m = measures_ly(fact, [period], period=period, blank_ratio=True, known=known)
    kpis = ["net_sales", "gross_margin_pct", "net_profit_pct"]
    cols = [period]
    for k in kpis:
        cols += [F.col(k), F.col(k + "_ly"), (F.col(k) - F.col(k + "_ly")).alias(k + "_change"),
                 direction(k, k + "_ly").alias(k + "_direction")]
    return decimals_to_double(m.select(*cols)).orderBy(period)


def supply_kpis(t, dims: list[str]) -> DataFrame:
    """Forecast accuracy, net error and absolute error per group with last year, direction and risk."""
    m = forecast_measures_ly(t, dims)
    return m.select(*dims, "forecast_accuracy_pct", "forecast_accuracy_pct_ly",
                    direction("forecast_accuracy_pct", "forecast_accuracy_pct_ly").alias("accuracy_direction"),
                    "net_error", "net_error_ly", direction("net_error", "net_error_ly").alias("net_error_direction"),
                    "abs_error", "abs_error_ly", direction("abs_error", "abs_error_ly").alias("abs_error_direction"),
                    "risk", "risk_ly")
