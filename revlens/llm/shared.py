"""Cutting lineage in the folder that all executors share, and connected components."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only for a session in one process (tests)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="revlens-llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder: later reads don't recompute it, and survive lost executors."""
    ensure_shared_folder(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that nothing refers to any more: it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def smallest(df: DataFrame, key: Column, count: int) -> DataFrame:
    """The `count` rows of `df` with the smallest values of `key`, a 64-bit hash that no two rows share; a bounded sample.

    All but about four times as many rows are left out where they lie, by a bound on the hash
    that follows from their number, so that no task hands `count` rows of its own to one place.
    """
    rows = df.withColumn("sample_key", key)
    total = df.count()
    if total > 4 * count:
        rows = rows.where(F.col("sample_key") < F.lit(-(2**63) + (2**64 * 4 * count) // total))
    return rows.orderBy("sample_key").limit(count).drop("sample_key")


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of undirected `edges` (a long, b long) as (node, root); root is the smallest node.

    Alternates large-star and small-star rounds: every round is two grouped minima and joins
    over the edges, never a collected component; a node with very many edges is aggregated
    map-side and its join partition is split at run time. Nodes without an edge are absent.
    """
    spark = edges.sparkSession
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        after = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(after.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
