"""Refresh of the stored ``fact_actual_est`` by what changed, published in one step.

The table is a view over a numbered version: ``fact_actual_est`` selects from
``fact_actual_est_v3``, say, an external table partitioned by fiscal year whose
partitions lie wherever the refresh that last changed them wrote them. A refresh

1. writes the rows of the asked years, joined once, to a new folder;
2. compares them with the stored rows by key and row hash (``changed_rows``);
3. makes the next version's table of the new folders of the changed years and
   the old folders of all others, whose files stay as they are;
4. points the view to it: the only step that readers see.

A refresh that stops anywhere before leaves the view on the old version, and
the next one starts over. Versions no reader needs any more are dropped by
``drop_versions``, with the folders that no kept version uses.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.forecast import actual_vs_forecast
from revlens.plans.joins import null_safe_join
from revlens.sources.raw import remove_path

TABLE = "fact_actual_est"
KEYS = ["fiscal_year", "date", "product_code", "customer_code"]
VALUES = ["sold_quantity", "forecast_quantity"]
COLUMNS = "date DATE, product_code BIGINT, customer_code BIGINT, sold_quantity BIGINT, forecast_quantity BIGINT, fiscal_year INT"


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``keys`` and ``change`` (added, removed or updated) of the rows that differ between two tables.

    Equal rows are matched by key and a hash of their values, NULL keys and
    values included; a key that repeats is compared as the set of its rows.
    Both sides are reduced to keys and hash before the one shuffle of the join.
    """
    def hashed(df: DataFrame, side: str) -> DataFrame:
        return (df.select(*keys, F.xxhash64(*values).alias("row_hash")).groupBy(*keys)
                .agg(F.sum(F.col("row_hash").cast("decimal(38,0)")).alias(f"{side}_sum"), F.count("*").alias(f"{side}_rows")))

    both = null_safe_join(hashed(old, "old"), hashed(new, "new"), keys, "full_outer")
    change = (F.when(F.col("old_rows").isNull(), "added").when(F.col("new_rows").isNull(), "removed")
              .when((F.col("old_rows") != F.col("new_rows")) | (F.col("old_sum") != F.col("new_sum")), "updated"))
    return both.withColumn("change", change).where("change IS NOT NULL").select(*keys, "change")


@dataclass
class Refresh:
    """What a refresh did: the version that readers now see, the years it wrote, the counts of changed keys by year."""

    version: int
    years: list[int] = field(default_factory=list)
    changes: dict[int, dict[str, int]] = field(default_factory=dict)


def versions(spark: SparkSession, database: str, table: str = TABLE) -> list[int]:
    """Numbers of the versions whose tables exist, published or not."""
    names = [x.name for x in spark.catalog.listTables(database)]
    return sorted(int(m[1]) for x in names if (m := re.fullmatch(rf"{table}_v(\d+)", x)))


def published(spark: SparkSession, database: str, table: str = TABLE) -> int | None:
    """The version that the view names, or None before the first refresh."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return None
    text = spark.sql(f"SHOW CREATE TABLE {database}.{table}").first()[0]
    found = re.search(rf"{table}_v(\d+)", text)
    if found is None:
        raise ValueError(f"{database}.{table} is not a view over versions")
    return int(found[1])


def _folders(spark: SparkSession, name: str) -> dict[int, str]:
    """The folder of each fiscal year of a version's table."""
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        year = int(row[0].split("=")[1])
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION (fiscal_year = {year})").collect()
        out[year] = next(x.data_type for x in detail if x.col_name == "Location")
    return out


def _root(spark: SparkSession, database: str, table: str) -> str:
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}_files"


def refresh_actual_est(t, database: str, fiscal_years: list[int] | None = None, table: str = TABLE) -> Refresh:
    """Bring the stored table up to date for the given fiscal years (all years if None).

    Only years with a changed key get new files; a year without rows any more
    loses its partition. Nothing is published if nothing changed.
    """
    spark = t.fact_sales_monthly.sparkSession
    old_version = published(spark, database, table)
    old_folders = {} if old_version is None else _folders(spark, f"{database}.{table}_v{old_version}")
    number = max([0, *versions(spark, database, table)]) + 1
    written = f"{_root(spark, database, table)}/{number}-{uuid.uuid4().hex[:8]}"

    # the join runs once; everything after it reads the written rows
    new = actual_vs_forecast(t.fact_sales_monthly, t.fact_forecast_monthly, fiscal_years)
    (new.select(*[c.split()[0] for c in COLUMNS.split(", ")]).hint("rebalance", "fiscal_year")
     .write.partitionBy("fiscal_year").mode("error").parquet(written))
    new = spark.read.schema(COLUMNS).parquet(written)
    old = spark.table(f"{database}.{table}") if old_version is not None else new.limit(0)
    if fiscal_years is not None:
        old = old.where(F.col("fiscal_year").isin(*fiscal_years))
    counted = changed_rows(old, new, KEYS, VALUES).groupBy("fiscal_year", "change").count().collect()  # three rows a year at most
    changes: dict[int, dict[str, int]] = {}
    for year, change, n in counted:
        changes.setdefault(year, {})[change] = n
    if old_version is not None and not changes:
        remove_path(spark, written)
        return Refresh(old_version)

    rows_left = {r[0] for r in new.select("fiscal_year").distinct().collect()}
    folders = {y: f for y, f in old_folders.items() if y not in changes}
    folders |= {y: f"{written}/fiscal_year={y}" for y in changes if y in rows_left}
    _publish(spark, database, table, number, written, folders)
    for year in rows_left - set(changes):
        remove_path(spark, f"{written}/fiscal_year={year}")
    return Refresh(number, sorted(changes), changes)


def _publish(spark: SparkSession, database: str, table: str, number: int, written: str, folders: dict[int, str]) -> None:
    """Make the version's table of the years' folders, then point the view to it."""
    name = f"{database}.{table}_v{number}"
    spark.sql(f"CREATE TABLE {name} ({COLUMNS}) USING parquet PARTITIONED BY (fiscal_year) LOCATION '{written}'")
    if folders:
        parts = " ".join(f"PARTITION (fiscal_year = {y}) LOCATION '{f}'" for y, f in sorted(folders.items()))
        spark.sql(f"ALTER TABLE {name} ADD {parts}")
    _point(spark, database, table, number)


def _point(spark: SparkSession, database: str, table: str, number: int) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {database}.{table}_v{number}")


def drop_versions(spark: SparkSession, database: str, keep: int = 2, table: str = TABLE) -> list[int]:
    """Drop all versions but the published one and the ``keep - 1`` before it, and the files only they used.

    Also drops what refreshes that stopped have left; none may be under way.
    """
    current = published(spark, database, table)
    every = versions(spark, database, table)
    before = [v for v in every if current is not None and v <= current]
    kept = set(before[-keep:]) if keep > 0 else set()
    if current is not None:
        kept.add(current)
    used = {f.removeprefix("file:").rstrip("/") for v in kept for f in _folders(spark, f"{database}.{table}_v{v}").values()}
    root = _root(spark, database, table)
    gone = [v for v in every if v not in kept]
    for v in gone:
        spark.sql(f"DROP TABLE {database}.{table}_v{v}")  # external: its files stay
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(path):
        for folder in [x.getPath() for x in files.listStatus(path)]:
            years = [x.getPath() for x in files.listStatus(folder) if x.isDirectory()]
            left = [y for y in years if y.toString().removeprefix("file:").rstrip("/") in used]
            for y in years if left else [folder]:
                if y not in left:
                    files.delete(y, True)
    return gone
