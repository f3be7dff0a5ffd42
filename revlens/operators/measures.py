"""Profit-and-loss measures over the actuals fact, at any grouping.

Base amounts are summed at the requested dims (exact DECIMAL); derived
measures (margins, percentages) are computed from those sums, never summed
themselves. Benchmarks are the same measures one year earlier (``ly``) or
the yearly targets (``target``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.arith import blank_add, blank_sub, divide
from revlens.operators.output import decimals_to_double
from revlens.plans.joins import attach_row, null_safe_join
from revlens.plans.periods import with_prior_period

# output name -> fact column
BASE = {
    "gross_sales": "gross_sales_amount",
    "pre_invoice_deduction": "pre_invoice_deduction",
    "net_invoice_sales": "net_invoice_sales_amount",
    "post_invoice_deduction": "post_invoice_deduction",
    "post_invoice_other_deduction": "post_invoice_other_deduction",
    "net_sales": "net_sales_amount",
    "manufacturing_cost": "manufacturing_cost",
    "freight_cost": "freight_cost",
    "other_cost": "other_cost",
    "ads_promotions": "ads_promotions",
    "other_operational_expense": "other_operational_expense",
    "sold_quantity": "sold_quantity",
}
DERIVED = ["total_cogs", "gross_margin", "gross_margin_pct", "gm_per_unit", "operational_expense",
           "net_profit", "net_profit_pct"]
RATIOS = ["gross_margin_pct", "gm_per_unit", "net_profit_pct"]
TARGET_DIMS = {"fiscal_year", "market", "region"}


def base_sums(suffix: str = "", when: Column | None = None) -> list[Column]:
    """SUM of every base amount, optionally restricted to rows where ``when`` holds."""
    out = []
    for name, col in BASE.items():
        c = F.col(col) if when is None else F.when(when, F.col(col))
        out.append(F.sum(c).alias(name + suffix))
    return out


def derived(suffix: str = "", blank_ratio: bool = False) -> dict[str, Column]:
    """Derived measures from base sums carrying ``suffix``.

    Ratios use DIVIDE(a, b, 0): a period with no sales gives 0, not NULL
    (``blank_ratio=True`` gives NULL instead). Sums and differences follow the
    measure rule: a BLANK term counts as 0 unless all terms are BLANK.
    """
    c = {n: F.col(n + suffix) for n in BASE}
    alt = None if blank_ratio else 0
    # measure arithmetic: a BLANK term counts as 0 unless every term is BLANK
    cogs = blank_add(c["manufacturing_cost"], c["freight_cost"], c["other_cost"])
    gm = blank_sub(c["net_sales"], cogs)
    opex = -blank_add(c["ads_promotions"], c["other_operational_expense"])
    np_ = blank_add(gm, opex)
    return {
        "total_cogs": cogs,
        "gross_margin": gm,
        "gross_margin_pct": divide(gm, c["net_sales"], alt),
        "gm_per_unit": divide(gm, c["sold_quantity"], alt),
        "operational_expense": opex,
        "net_profit": np_,
        "net_profit_pct": divide(np_, c["net_sales"], alt),
    }


def with_derived(df: DataFrame, suffix: str = "", blank_ratio: bool = False) -> DataFrame:
    return df.withColumns({k + suffix: v for k, v in derived(suffix, blank_ratio).items()})


def measures(fact: DataFrame, dims: list[str], fiscal_year: int | None = None,
             blank_ratio: bool = False) -> DataFrame:
    """All base and derived P&L measures grouped by ``dims`` (DECIMAL money)."""
    if fiscal_year is not None:
        fact = fact.filter(F.col("fiscal_year") == fiscal_year)
    return with_derived(fact.groupBy(*dims).agg(*base_sums()), blank_ratio=blank_ratio)


def measures_with_prior(fact: DataFrame, dims: list[str], fiscal_year: int,
                        blank_ratio: bool = False) -> DataFrame:
    """Measures of ``fiscal_year`` and of the year before (``*_ly``) in one pass.

    Both years come from one scan (pruned to the two fiscal-year partitions)
    and one aggregation with conditional sums; no self-join. A group present
    only in the prior year is kept with NULL current values.
    """
    fy = F.col("fiscal_year")
    sums = (fact.filter(fy.isin(fiscal_year, fiscal_year - 1))
            .groupBy(*dims)
            .agg(*base_sums("", fy == fiscal_year), *base_sums("_ly", fy == fiscal_year - 1)))
    return with_derived(with_derived(sums, "", blank_ratio), "_ly", blank_ratio)


def with_last_year(agg: DataFrame, dims: list[str], period: str = "fiscal_year",
                   columns: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """Add ``<col>_ly`` = the value of the same dims one year earlier (calendar
    shift; a missing prior period gives NULL). See ``plans.periods``."""
    columns = columns or [c for c in agg.columns if c not in dims]
    return with_prior_period(agg, dims, period, columns, known=known)


def measures_ly(fact: DataFrame, dims: list[str], period: str = "fiscal_year",
                blank_ratio: bool = False, known: DataFrame | None = None) -> DataFrame:
    """Measures for every period with their last-year values (base sums shifted,
    derived measures recomputed from the shifted sums). ``known``: the periods
    there are (``plans.periods``); with it the fact is read once."""
    sums = fact.groupBy(*dims).agg(*base_sums())
    both = with_last_year(sums, dims, period, list(BASE), known)
    return with_derived(with_derived(both, "", blank_ratio), "_ly", blank_ratio)


def targets_at(t, dims: list[str], fiscal_year: int | None = None) -> DataFrame | None:
    """Targets summed to ``dims`` (of one fiscal year if given), or None when the
    dims filter below the target grain (a customer / product attribute other
    than market and region). A target of a market without customers has no
    region; it stays, under a NULL one."""
    if not set(dims) <= TARGET_DIMS:
        return None
    tg = t.ns_gm_target
    if fiscal_year is not None:
        tg = tg.filter(F.col("fiscal_year") == fiscal_year)
    if "region" in dims:
        regions = t.dim_customer.select("market", "region").distinct()
        tg = tg.join(regions, "market", "left")
    return tg.groupBy(*dims).agg(F.sum("ns_target").alias("ns_target"),
                                 F.sum("gm_target").alias("gm_target"),
                                 F.sum("np_target").alias("np_target"))


def with_targets(agg: DataFrame, t, dims: list[str], blank_ratio: bool = False,
                 fiscal_year: int | None = None, blank_actual: bool = False) -> DataFrame:
    """Add ns_target, gm_target, np_target and the target ratios (NULL money where none).

    A target needs no sales to exist: a group with a target and no actual row
    is kept, with NULL amounts and the ratios of an empty period (0, or NULL
    with ``blank_actual``). NULL groups match NULL groups.
    """
    tg = targets_at(t, dims, fiscal_year)
    if tg is None:
        agg = agg.withColumns({c: F.lit(None).cast("decimal(34,2)")
                               for c in ("ns_target", "gm_target", "np_target")})
    elif dims:
        ratios = [c for c in agg.columns if c.removesuffix("_ly") in RATIOS]
        agg = null_safe_join(agg.withColumn("__sold", F.lit(True)), tg, dims, "full_outer")
        if not blank_actual:
            agg = agg.withColumns({c: F.when(F.col("__sold").isNull(), 0.0).otherwise(F.col(c)) for c in ratios})
        agg = agg.drop("__sold")
    else:
        agg = attach_row(agg, tg)  # targets at no dims: a global aggregate, one row
    alt = None if blank_ratio else 0
    return agg.withColumns({
        "gross_margin_pct_target": divide("gm_target", "ns_target", alt),
        "net_profit_pct_target": divide("np_target", "ns_target", alt),
    })


def with_benchmark(agg: DataFrame, benchmark: str | None) -> DataFrame:
    """``*_bm`` columns: last year (``ly``), target (``target``) or NULL (None)."""
    src = {"ly": {"net_sales": "net_sales_ly", "gross_margin_pct": "gross_margin_pct_ly",
                  "net_profit_pct": "net_profit_pct_ly"},
           "target": {"net_sales": "ns_target", "gross_margin_pct": "gross_margin_pct_target",
                      "net_profit_pct": "net_profit_pct_target"}}
    if benchmark is None:
        return agg.withColumns({f"{m}_bm": F.lit(None).cast("double")
                                for m in ("net_sales", "gross_margin_pct", "net_profit_pct")})
    return agg.withColumns({f"{m}_bm": F.col(c) for m, c in src[benchmark].items()})


def gap_flag(agg: DataFrame, tolerance: float, measure: str = "gross_margin_pct") -> DataFrame:
    """variance = benchmark - actual (positive = short of benchmark); flag 1 when
    variance >= tolerance, else 0 (a BLANK variance gives 0)."""
    variance = F.col(f"{measure}_bm") - F.col(measure)
    return (agg.withColumn(f"{measure}_variance", variance)
            .withColumn(f"{measure}_flag", F.when(variance >= tolerance, 1).otherwise(0)))


def output(df: DataFrame, columns: list[str]) -> DataFrame:
    return decimals_to_double(df.select(*columns))
