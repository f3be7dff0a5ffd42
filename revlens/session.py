"""Session construction and the few session-level settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library expects; the values are sized for
# local testing and are meant to be overridden by the cluster's own config.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's own size check for broadcast joins; above it the planner falls
    # back to a shuffled join, so dimension sizes need no manual guard.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "revlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster, call ``SparkSession.builder.getOrCreate()`` yourself and
    pass the session around; this helper exists for tests and the bench.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the session names in ``spark.checkpoint.dir``, or None.

    No folder is invented: intermediate data must lie where every executor
    can read it, so a job that checkpoints has to be given one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which the driver and all executors share.

    Only a session in one process that names no folder (tests) gets a temporary one.
    """
    if ensure_checkpoint_dir(spark) is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="revlens-")
        spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def written_once(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder: later reads see the same rows in the
    same partitions, and survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def scale_conf(shuffle_bytes: int, total_cores: int,
               partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run (pass to the session builder).

    ``shuffle_bytes`` is the largest expected shuffle of the job -- for these
    reports the fact-to-fact join of one or two fiscal years (sales and
    post-invoice rows, ~60 bytes each after column pruning), since every
    aggregation is partial before its shuffle. Partitions are sized so one
    fits comfortably in a task's memory share; AQE starts from that count and
    coalesces small partitions, and splits skewed ones above 4x the median.
    """
    initial = max(total_cores * 2, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
