"""Sales totals by any dimensions and their share of a (grand or group) total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import MILLION, MONEY_DIGITS
from revlens.functions.arith import round_ratio, sql_div
from revlens.operators.waterfall import CUSTOMER_ATTRS, PRODUCT_ATTRS, gross_sales, net_sales, net_sales_lines
from revlens.plans.joins import join_totals


def sales_by(df: DataFrame, dims: list[str], value: str = "net_sales", fiscal_year: int | None = None,
             unit: int = MILLION, digits: int = MONEY_DIGITS, alias: str | None = None) -> DataFrame:
    """ROUND(SUM(value) / unit, digits) grouped by ``dims`` (DECIMAL result).

    The sum is exact; the quotient is fixed at 10 decimals before rounding.
    Aggregation is partial per partition before the shuffle, so a customer
    holding a large share of the rows costs one partial row per partition.
    """
    if fiscal_year is not None:
        df = df.filter(F.col("fiscal_year") == fiscal_year)
    alias = alias or f"{value}_mln"
    return df.groupBy(*dims).agg(
        round_ratio(sql_div(F.sum(value), F.lit(unit)), digits).alias(alias))


def contribution(df: DataFrame, value: str, within: list[str] | None = None, digits: int = 2,
                 alias: str = "pct_contribution") -> DataFrame:
    """Percentage of ``value`` in the total over ``within`` groups (all rows if None).

    ``ROUND(value * 100.0 / SUM(value) OVER (PARTITION BY within), digits)``
    planned as an aggregate joined back: the grand total is a one-row
    broadcast, group totals an equi-join, so no single-partition window.
    """
    within = list(within or [])
    total = f"__total_{value}"
    totals = df.groupBy(*within).agg(F.sum(value).alias(total))
    pct = round_ratio(sql_div(F.col(value) * F.lit(100.0).cast("decimal(4,1)"), F.col(total)), digits)
    return join_totals(df, totals, within).withColumn(alias, pct).drop(total)


def net_sales_by(t, dims: list[str], fiscal_year: int) -> DataFrame:
    """Net sales in millions by ``dims`` for one fiscal year (decimal).

    Line amounts are summed by customer and product code first (exact
    decimals), and attributes join that much smaller result.
    """
    customer, product = ([d for d in dims if d in attrs] for attrs in (CUSTOMER_ATTRS, PRODUCT_ATTRS))
    codes = ["customer_code"] * bool(customer) + ["product_code"] * bool(product)
    if set(dims) - set(customer) - set(product) - {"date", "fiscal_year"}:
        return sales_by(net_sales(t, fiscal_year), dims, "net_sales")
    own = [d for d in dims if d in ("date", "fiscal_year")]
    lines = net_sales_lines(t, fiscal_year, known_products=not product, known_customers=not customer)
    sums = lines.groupBy(*codes, *own).agg(F.sum("net_sales").alias("net_sales"))
    if customer:
        sums = sums.join(t.dim_customer.select("customer_code", *customer), "customer_code")
    if product:
        sums = sums.join(t.dim_product.select("product_code", *product), "product_code")
    return sales_by(sums, dims, "net_sales")


def gross_sales_by(t, dims: list[str], fiscal_year: int) -> DataFrame:
    return sales_by(gross_sales(t, fiscal_year), dims, "gross_price_total", alias="gross_sales_mln")


def quantity_by(t, dims: list[str], fiscal_year: int) -> DataFrame:
    """Total sold quantity by product attributes for one fiscal year (all sales,
    priced or not)."""
    return (t.fact_sales_monthly.filter(F.col("fiscal_year") == fiscal_year)
            .join(t.dim_product.select("product_code", *dims), "product_code")
            .groupBy(*dims).agg(F.sum("sold_quantity").alias("total_quantity")))
