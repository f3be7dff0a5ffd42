"""Materialised tables.

``write_actual_est`` stores the unified actuals/forecast table partitioned by
fiscal year. Given ``fiscal_years``, only those years are recomputed and only
their partitions are replaced (dynamic partition overwrite), so a monthly
refresh touches one or two years, not the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.forecast import actual_vs_forecast
from revlens.sources.raw import remove_path

ACTUAL_EST_COLUMNS = ["date", "product_code", "customer_code", "sold_quantity", "forecast_quantity",
                      "fiscal_year"]


def years_with_rows(t, fiscal_years: list[int]) -> DataFrame:
    """The given fiscal years that either fact has rows of, read from the year column alone (no join)."""
    facts = [x.select("fiscal_year").filter(F.col("fiscal_year").isin(*fiscal_years))
             for x in (t.fact_sales_monthly, t.fact_forecast_monthly)]
    return facts[0].unionByName(facts[1]).distinct()


def write_actual_est(t, path: str, fiscal_years: list[int] | None = None) -> DataFrame:
    """Write fact_actual_est under ``path`` and return a reader of the stored table.

    Rows are rebalanced by year first, so a year is a few files of even size
    and a large year is split. A refreshed year that has no rows any more
    loses its old partition; an empty list of years changes nothing. The outer
    join runs once. ``sources.refresh`` instead writes changed years only and
    keeps the old rows readable until it is done.
    """
    spark = t.fact_sales_monthly.sparkSession
    df = actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly, fiscal_years)
    writer = df.select(*ACTUAL_EST_COLUMNS).hint("rebalance", "fiscal_year").write.partitionBy("fiscal_year")
    writer = writer.mode("overwrite")
    if fiscal_years is not None:
        present = {r[0] for r in years_with_rows(t, fiscal_years).collect()}  # at most the years given
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        for year in set(fiscal_years) - present:
            remove_path(spark, f"{path.rstrip('/')}/fiscal_year={year}")
    else:
        writer.parquet(path)
    return spark.read.parquet(path)
