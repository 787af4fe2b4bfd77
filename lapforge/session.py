"""Spark session and shared-folder helpers.

Settings that matter at scale are set here once: UTC, ANSI (Spark 4 default),
adaptive execution with partition coalescing and skew-join splitting, and the
size threshold under which the planner and AQE may broadcast a join side.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Broadcast threshold used by the planner (file-size estimate) and by AQE
# (measured shuffle size).  A dimension is broadcast only when one of these two
# checks says it is below this many bytes; otherwise the join stays sort-merge.
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of encoded and compressed columns take several times their bytes in a file;
# the planner's estimate of a scan counts that.
FILE_COMPRESSION_FACTOR = 4.0

# Cluster defaults (applied only where the session leaves them unset): shuffles
# start from many partitions so a 100 TB join never puts hundreds of GB in one
# reducer, and AQE coalesces small shuffles back to the advisory size.
CLUSTER_INITIAL_SHUFFLE_PARTITIONS = 16384
ADVISORY_PARTITION_BYTES = 64 * 1024 * 1024
# A task that sorts or hashes what it scans holds rows, not column chunks (the result
# fact: 13 bytes a row in the file, about 240 in a sort).
SCAN_PARTITION_BYTES = 16 * 1024 * 1024

# A range sort sends a sample of its keys to the driver: three times the wanted points,
# which are a number per output partition.  This bounds them for all partitions together.
RANGE_SAMPLE_POINTS = 32768
RANGE_POINTS_PER_PARTITION = (2, 100)  # fewest; most, which is Spark's own default


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lapforge") -> SparkSession:
    """Create (or reuse) a session configured for this engine.

    ``master`` defaults to ``local[$BENCH_CPUS or 8]``; on a cluster pass the
    cluster master (or call ``configure`` on an existing session).
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or max(8, 2 * cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LAPFORGE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # pinned sorts (checkpoint files) are removed once their frames are gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on to an existing session."""
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.ansi.enabled", "true")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
    conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
    conf.set("spark.sql.sources.fileCompressionFactor", str(FILE_COMPRESSION_FACTOR))
    conf.set("spark.sql.parquet.filterPushdown", "true")
    if spark.sparkContext.master.split("[")[0] != "local":
        cluster_defaults(spark)
    _set_if_unset(spark, "spark.sql.execution.rangeExchange.sampleSizePerPartition", str(range_points(spark)))
    ensure_checkpoint_dir(spark)
    return spark


def cluster_defaults(spark: SparkSession) -> None:
    """Sizes of shuffle and scan tasks, where the session leaves them unset."""
    _set_if_unset(spark, "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                  str(CLUSTER_INITIAL_SHUFFLE_PARTITIONS))
    _set_if_unset(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                  str(ADVISORY_PARTITION_BYTES))
    _set_if_unset(spark, "spark.sql.files.maxPartitionBytes", str(SCAN_PARTITION_BYTES))


def range_points(spark: SparkSession) -> int:
    """Sample points per output partition of a range sort."""
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) \
        or spark.conf.get("spark.sql.shuffle.partitions")
    least, most = RANGE_POINTS_PER_PARTITION
    return max(least, min(most, RANGE_SAMPLE_POINTS // int(parts)))


def _set_if_unset(spark: SparkSession, key: str, value: str) -> None:
    if spark.conf.get(key, None) in (None, ""):
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is set.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system); a machine-local folder is used only for local masters
    (tests and the single-node bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.split("[")[0] != "local":  # local-cluster has executors of its own
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running lapforge jobs on a cluster")
        configured = tempfile.mkdtemp(prefix="lapforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex}"
