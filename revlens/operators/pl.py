"""The profit-and-loss statement: 17 line items x (value, benchmark, change, change %).

The statement is computed as one wide aggregation (every line item's sums as
columns), then turned into rows with ``inline`` over an array of structs:
one job for the whole matrix instead of one evaluation per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import MILLION, PL_TARGET_LINES, PL_TOTAL_LABEL
from revlens.functions.arith import blank_add, divide
from revlens.operators.measures import (base_sums, measures, measures_with_prior, targets_at, with_benchmark,
                                        with_derived, with_targets)
from revlens.operators.output import decimals_to_double
from revlens.plans.joins import null_safe_join

MLN = float(MILLION)


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def line_values(suffix: str = "") -> list[Column]:
    """Value of line items 1..17 from wide measure columns carrying ``suffix``.

    Money lines are in millions, percentage lines x100, GM / unit unscaled.
    """
    m = {n: _d(n + suffix) for n in (
        "gross_sales", "pre_invoice_deduction", "net_invoice_sales", "post_invoice_deduction",
        "post_invoice_other_deduction", "net_sales", "manufacturing_cost", "freight_cost",
        "other_cost", "total_cogs", "gross_margin", "operational_expense", "net_profit")}
    return [
        m["gross_sales"] / MLN,
        m["pre_invoice_deduction"] / MLN,
        m["net_invoice_sales"] / MLN,
        m["post_invoice_deduction"] / MLN,
        m["post_invoice_other_deduction"] / MLN,
        blank_add(m["post_invoice_deduction"] / MLN, m["post_invoice_other_deduction"] / MLN),
        m["net_sales"] / MLN,
        m["manufacturing_cost"] / MLN,
        m["freight_cost"] / MLN,
        m["other_cost"] / MLN,
        m["total_cogs"] / MLN,
        m["gross_margin"] / MLN,
        F.col("gross_margin_pct" + suffix) * 100,
        F.col("gm_per_unit" + suffix),
        m["operational_expense"] / MLN,
        m["net_profit"] / MLN,
        F.col("net_profit_pct" + suffix) * 100,
    ]


def target_values() -> list[Column]:
    """Target of each line item: only net sales, gross margin, GM % and NP % have one."""
    none = F.lit(None).cast("double")
    vals = [none] * 17
    targets = {7: _d("ns_target") / MLN, 12: _d("gm_target") / MLN,
               13: F.col("gross_margin_pct_target") * 100, 17: F.col("net_profit_pct_target") * 100}
    assert set(targets) == set(PL_TARGET_LINES)
    for line, value in targets.items():
        vals[line - 1] = value
    return vals


def _lines(values: list[Column], bms: list[Column] | None, total: Column,
           total_bm: Column | None) -> Column:
    """Array of (ord, value, bm) structs: the 17 lines plus the total (ord NULL).

    The total line carries net sales, as the statement's grand total does,
    not a sum of the lines."""
    none = F.lit(None).cast("double")
    bms = bms or [none] * 17
    items = [F.struct(F.lit(i + 1).alias("ord"), v.alias("value"), b.alias("bm"))
             for i, (v, b) in enumerate(zip(values, bms))]
    items.append(F.struct(F.lit(None).cast("int").alias("ord"), total.alias("value"),
                          (total_bm if total_bm is not None else none).alias("bm")))
    return F.array(*items)


def _describe(long: DataFrame, t) -> DataFrame:
    return (long.join(t.pl_rows, "ord", "left")
            .withColumn("description", F.coalesce("description", F.lit(PL_TOTAL_LABEL))))


def pl_rows(fact: DataFrame, t, dims: list[str], fiscal_year: int | None = None) -> DataFrame:
    """Line items 1..17 (plus the total line) per ``dims`` group: dims, ord, description, value."""
    wide = measures(fact, dims, fiscal_year)
    long = wide.select(*dims, F.inline(_lines(line_values(), None, _d("net_sales") / MLN, None)))
    return _describe(long, t).select(*dims, "ord", "description", "value")


def pl_statement(fact: DataFrame, t, fiscal_year: int, dims: list[str] | None = None,
                 benchmark: str | None = "ly", blank_ratio: bool = False) -> DataFrame:
    """The P&L matrix for one fiscal year: value, bm, chg, chg_pct per line item.

    ``benchmark``: ``"ly"`` (same lines one year earlier), ``"target"`` (only
    lines with a target), or None. chg is NULL when either side is NULL;
    chg_pct = DIVIDE(chg, bm, 0).
    """
    dims = list(dims or [])
    wide = measures_with_prior(fact, dims, fiscal_year, blank_ratio)
    if benchmark == "ly":
        bms, total_bm = line_values("_ly"), _d("net_sales_ly") / MLN
    elif benchmark == "target":
        wide = with_targets(wide, t, dims, blank_ratio, fiscal_year=fiscal_year, blank_actual=blank_ratio)
        bms, total_bm = target_values(), _d("ns_target") / MLN
    elif benchmark is None:
        bms, total_bm = None, None
    else:
        raise ValueError("benchmark must be 'ly', 'target' or None")
    long = wide.select(*dims, F.inline(_lines(line_values(), bms, _d("net_sales") / MLN, total_bm)))
    chg = F.col("value") - F.col("bm")
    return (_describe(long, t)
            .withColumn("chg", chg)
            .withColumn("chg_pct", divide(chg, "bm", 0))
            .select(*dims, "ord", "description", "value", "bm", "chg", "chg_pct"))


def pl_drill_ly(fact: DataFrame, levels: list[str], fiscal_year: int) -> DataFrame:
    """The drill with last year as the benchmark: both years in one aggregation, then rolled up."""
    fy = F.col("fiscal_year")
    leaf = (fact.filter(fy.isin(fiscal_year, fiscal_year - 1)).groupBy(*levels)
            .agg(*base_sums("", fy == fiscal_year), *base_sums("_ly", fy == fiscal_year - 1)))
    rolled = leaf.rollup(*levels).agg(F.grouping_id().cast("int").alias("level"),
                                      *[F.sum(c).alias(c) for c in leaf.columns if c not in levels])
    out = with_benchmark(with_derived(with_derived(rolled), "_ly"), "ly")
    return decimals_to_double(out.select(
        *levels, "level", "net_sales", "net_sales_ly", "gross_margin_pct", "gross_margin_pct_ly", "net_profit_pct",
        "net_profit_pct_ly", "net_sales_bm", "gross_margin_pct_bm", "net_profit_pct_bm"))


def pl_drill_target(fact: DataFrame, t, levels: list[str], fiscal_year: int) -> DataFrame:
    """The drill with the year's targets as the benchmark, for levels of market and region.

    Targets are summed at the leaf level and rolled up like the actuals; a group
    with targets and no sales keeps a row.
    """
    targets = targets_at(t, levels, fiscal_year)
    if targets is None:
        raise ValueError("targets exist by fiscal_year, market and region only")
    leaf = fact.filter(F.col("fiscal_year") == fiscal_year).groupBy(*levels).agg(*base_sums())
    names = [c for c in [*leaf.columns, *targets.columns] if c not in levels]
    both = null_safe_join(leaf, targets, levels, "full_outer")
    rolled = both.rollup(*levels).agg(F.grouping_id().cast("int").alias("level"), *[F.sum(c).alias(c) for c in names])
    out = with_derived(rolled).withColumns({
        "gross_margin_pct_target": divide("gm_target", "ns_target", None),
        "net_profit_pct_target": divide("np_target", "ns_target", None)})
    return decimals_to_double(with_benchmark(out, "target").select(
        *levels, "level", "net_sales", "gross_margin_pct", "net_profit_pct", "net_sales_bm", "gross_margin_pct_bm",
        "net_profit_pct_bm"))


def pl_drill(fact: DataFrame, levels: list[str], fiscal_year: int) -> DataFrame:
    """Key P&L figures at every level of a drill path (e.g. region > market > product).

    Sums are first aggregated at the leaf level (one shuffle of the fact),
    then rolled up on that much smaller result; ``level`` is the grouping id
    (0 = leaf, all bits set = grand total).
    """
    leaf = fact.filter(F.col("fiscal_year") == fiscal_year).groupBy(*levels).agg(*base_sums())
    rolled = leaf.rollup(*levels).agg(F.grouping_id().cast("int").alias("level"),
                                      *[F.sum(c).alias(c) for c in leaf.columns if c not in levels])
    out = with_derived(rolled).select(*levels, "level", "net_sales", "gross_margin", "gross_margin_pct",
                                      "net_profit", "net_profit_pct")
    return decimals_to_double(out)
