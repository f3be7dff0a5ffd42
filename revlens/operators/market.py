"""Market share measures over the (fiscal year x category x manufacturer) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.arith import divide
from revlens.functions.text import equals_ci


def market_share(ms: DataFrame, dims: list[str]) -> DataFrame:
    """Market Share = DIVIDE(SUM(sales), SUM(total_market_sales), 0) by ``dims``."""
    return (ms.groupBy(*dims)
            .agg(F.sum("sales").alias("sales"), F.sum("total_market_sales").alias("total_market_sales"))
            .withColumn("market_share", divide("sales", "total_market_sales", 0))
            .select(*dims, F.col("sales").cast("double").alias("sales"),
                    F.col("total_market_sales").cast("double").alias("total_market_sales"),
                    "market_share"))


def own_market_share(ms: DataFrame, dims: list[str], brand: str) -> DataFrame:
    """Share of one manufacturer (case-insensitive name), replacing any filter on
    manufacturer: both sums are restricted to the brand's rows, so the total
    market is counted once per row the brand has (one row per category)."""
    dims = [d for d in dims if d != "manufacturer"]
    own = equals_ci("manufacturer", brand)
    return (ms.groupBy(*dims)
            .agg(F.sum(F.when(own, F.col("sales"))).alias("own_sales"),
                 F.sum(F.when(own, F.col("total_market_sales"))).alias("own_total_market_sales"))
            .withColumn("own_market_share", divide("own_sales", "own_total_market_sales", 0))
            .select(*dims, "own_market_share"))
