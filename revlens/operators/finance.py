"""Finance reports: gross sales by line, month and fiscal year for chosen customers.

The fiscal year of these reports is derived from the sale date (not the
stored column), as the original procedures did; the fiscal-year predicate is
written as a date range so it reaches the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.fiscal import (FY_START_MONTH, fiscal_quarter, fiscal_year,
                                      fiscal_year_filter)
from revlens.functions.sets import restrict_to_codes
from revlens.operators.output import decimals_to_double


def _priced(t, sales: DataFrame, start_month: int) -> DataFrame:
    """Sales joined to the gross price of the fiscal year computed from the date."""
    sales = sales.drop("fiscal_year").withColumn("fiscal_year", fiscal_year("date", start_month))
    return sales.join(t.fact_gross_price, ["product_code", "fiscal_year"])


def product_gross_sales(t, customer_code: int, fiscal_year_: int,
                        start_month: int = FY_START_MONTH) -> DataFrame:
    """Line-level gross sales of one customer in one fiscal year, by date."""
    sales = (t.fact_sales_monthly
             .filter(F.col("customer_code") == customer_code)
             .filter(fiscal_year_filter("date", fiscal_year_, start_month)))
    if start_month == FY_START_MONTH:
        # the stored fiscal_year is the same function of the date; naming it
        # too lets the scan skip the other years' partitions
        sales = sales.filter(F.col("fiscal_year") == fiscal_year_)
    out = (_priced(t, sales, start_month)
           .join(t.dim_product, "product_code")
           .select("date", "product_code", "product", "variant", "sold_quantity", "gross_price",
                   F.round(F.col("gross_price") * F.col("sold_quantity"), 2).alias("gross_price_total")))
    return decimals_to_double(out).orderBy("date", "product_code")


def monthly_gross_sales(t, customer_codes: int | str | Iterable,
                        start_month: int = FY_START_MONTH) -> DataFrame:
    """Monthly gross sales summed over one or several customers.

    ``customer_codes`` may be an int, an iterable of ints, or comma-separated
    text with FIND_IN_SET matching rules (see ``functions.sets``).
    """
    sales = restrict_to_codes(t.fact_sales_monthly, "customer_code", customer_codes)
    out = (_priced(t, sales, start_month)
           .groupBy("date")
           .agg(F.sum(F.round(F.col("gross_price") * F.col("sold_quantity"), 2)).alias("monthly_sales")))
    return decimals_to_double(out).orderBy("date")


def yearly_gross_sales(t, customer_code: int, start_month: int = FY_START_MONTH) -> DataFrame:
    """Gross sales per fiscal year for one customer; rounds the yearly sum once."""
    sales = t.fact_sales_monthly.filter(F.col("customer_code") == customer_code)
    out = (_priced(t, sales, start_month)
           .groupBy(F.col("fiscal_year").alias("financial_year"))
           .agg(F.round(F.sum(F.col("sold_quantity") * F.col("gross_price")), 2)
                .alias("total_gross_sales")))
    return decimals_to_double(out).orderBy("financial_year")


def fiscal_calendar(t, start_month: int = FY_START_MONTH) -> DataFrame:
    """Every calendar date of the date dimension with month, fiscal year and quarter."""
    return t.dim_date.select("date", F.trunc("date", "month").alias("month"),
                             fiscal_year("date", start_month).alias("fiscal_year"),
                             fiscal_quarter("date", start_month).alias("fiscal_quarter"))
