"""Coverage: which sales lines the waterfall's inner joins keep, and what the others lack.

A sale without a product, customer, price or deduction row drops out of every
net-sales report without a trace. This report makes the loss visible: one pass
over the sales marks, by outer joins, which rows a line finds, and sums lines
and quantity by fiscal year.

A line is lost at the first step that lacks its row, in the order of the
waterfall (``STEPS``), so that kept and lost lines add up to all lines. What a
step lacks altogether, lost earlier or not, is counted beside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.arith import divide
from revlens.operators.waterfall import _post_invoice, _sales

KEPT = "kept"
#: The waterfall's steps: what a line has to find.
STEPS = ("product", "customer", "price", "pre_invoice", "post_invoice")


def marked_lines(t, fiscal_year: int | None = None) -> DataFrame:
    """Every sales line (keys, fiscal_year, sold_quantity) with a flag ``has_<step>`` for each step.

    No line is lost or doubled: keys that repeat on a looked-up side count once.
    A NULL key finds nothing. The fact-sized post-invoice side comes first, so
    that facts bucketed alike are joined where they lie.
    """
    def of_year(df: DataFrame) -> DataFrame:
        return df if fiscal_year is None else df.filter(F.col("fiscal_year") == fiscal_year)

    looked_up = {
        "post_invoice": (_post_invoice(t, fiscal_year), ["date", "product_code", "customer_code"]),
        "price": (of_year(t.fact_gross_price), ["product_code", "fiscal_year"]),
        "pre_invoice": (of_year(t.fact_pre_invoice_deductions), ["customer_code", "fiscal_year"]),
        "product": (t.dim_product, ["product_code"]),
        "customer": (t.dim_customer, ["customer_code"]),
    }
    lines = _sales(t, fiscal_year).select("date", "fiscal_year", "product_code", "customer_code", "sold_quantity")
    for step, (table, keys) in looked_up.items():
        found = table.select(*keys).distinct().withColumn(f"has_{step}", F.lit(True))
        lines = lines.join(found, keys, "left").withColumn(f"has_{step}", F.coalesce(f"has_{step}", F.lit(False)))
    return lines


def first_lack() -> Column:
    """The first step whose row a marked line lacks, or ``kept``."""
    return reduce(lambda rest, step: F.when(~F.col(f"has_{step}"), F.lit(step)).otherwise(rest), reversed(STEPS), F.lit(KEPT))


def coverage_report(t, fiscal_year: int | None = None) -> DataFrame:
    """fiscal_year, step, lines, quantity, share_of_quantity, lines_lacking, quantity_lacking.

    One row per fiscal year and step, ``kept`` included, also where nothing was
    lost. ``lines`` and ``quantity`` of a year add up to all its sales;
    ``lines_lacking`` counts every line without the step's row, those lost
    earlier too (0 for ``kept``). Quantities of NULL count as 0.
    """
    lines = marked_lines(t, fiscal_year).withColumn("step", first_lack())
    quantity = F.coalesce("sold_quantity", F.lit(0))
    sums = [F.sum(quantity).alias("year_quantity")]
    for step in (*STEPS, KEPT):
        here = F.col("step") == step
        lacking = ~F.col(f"has_{step}") if step != KEPT else F.lit(False)
        sums += [F.count_if(here).alias(f"{step}_lines"), F.sum(F.when(here, quantity).otherwise(0)).alias(f"{step}_quantity"),
                 F.count_if(lacking).alias(f"{step}_lacking"), F.sum(F.when(lacking, quantity).otherwise(0)).alias(f"{step}_quantity_lacking")]
    wide = lines.groupBy("fiscal_year").agg(*sums)
    rows = [F.struct(F.lit(step).alias("step"), F.col(f"{step}_lines").alias("lines"), F.col(f"{step}_quantity").alias("quantity"),
                     divide(f"{step}_quantity", "year_quantity", 0).alias("share_of_quantity"),
                     F.col(f"{step}_lacking").alias("lines_lacking"), F.col(f"{step}_quantity_lacking").alias("quantity_lacking"))
            for step in (KEPT, *STEPS)]
    return wide.select("fiscal_year", F.inline(F.array(*rows)))


def lost_lines(t, fiscal_year: int | None = None, step: str | None = None) -> DataFrame:
    """The lines themselves that drop out (of one step if given), with the step that lacks their row."""
    if step is not None and step not in STEPS:
        raise ValueError(f"step must be one of {STEPS}")
    lines = marked_lines(t, fiscal_year).withColumn("step", first_lack())
    lines = lines.filter(F.col("step") != KEPT if step is None else F.col("step") == step)
    return lines.select("date", "fiscal_year", "product_code", "customer_code", "sold_quantity", "step")
