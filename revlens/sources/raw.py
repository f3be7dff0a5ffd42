"""Readers for the source tables, with only the needed columns selected.

Selecting the columns right at the read keeps the parquet ``ReadSchema``
narrow even before Catalyst's own pruning runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(spark: SparkSession, root: str, name: str) -> str:
    """Location of a table under ``root``: ``name.parquet`` or the folder ``name``, whichever exists
    on the path's own file system."""
    base = f"{root.rstrip('/')}/{name}"
    return base if path_exists(spark, base) and not path_exists(spark, base + ".parquet") else base + ".parquet"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (local, HDFS or object stores)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder through Hadoop's FileSystem; False if there is none."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None,
               schema: str | None = None) -> DataFrame:
    """Read a table, optionally with an explicit (partial) schema.

    An explicit schema skips inference and pins types, e.g. a wall-clock
    ``timestamp_ntz`` that must not move with the session time zone.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(table_path(spark, root, name))
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower_bound: int, upper_bound: int, num_partitions: int,
              properties: dict | None = None) -> DataFrame:
    """Parallel read of a warehouse table over JDBC (one range per partition).

    The reports originally ran against a relational warehouse; this is the
    same scan with the range split Spark needs to read it in parallel.
    """
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties or {})
