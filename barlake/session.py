"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  Time zone matters because
# timestamps become dates; AQE coalesces small shuffles and splits skewed
# sort-merge join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "barlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune_listing(spark)
    ensure_checkpoint_dir(spark)
    return spark


def tune_listing(spark: SparkSession) -> None:
    """Size the file-listing job to the cluster.

    A folder tree (one folder per symbol or per date), or a stream batch's
    list of new files, is listed by a Spark job with, by default, up to 10,000
    tasks: one per folder or file.  With many small
    folders the task overhead dominates, so unless the user set it, use two
    listing tasks per core of the cluster.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.sparkContext.getConf().get(key, None) is None and spark.conf.get(key, None) in (None, "10000"):
        spark.conf.set(key, str(max(8, 2 * spark.sparkContext.defaultParallelism)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder and
    is used as is.  Only when it is unset (a local test run) is a private
    folder created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="barlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for tables written by one job and read by the next (landing files,
    stream sinks and checkpoints, swapped rewrites).  Never a machine-local
    folder unless the session itself was configured that way.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/barlake/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` of input.

    Aim at ~``partition_bytes`` per task so partitions fit in executor memory
    without spilling: scans split files at that size; the initial shuffle
    partition count covers the input at that size (at least 2 waves of the
    cluster's cores), and AQE coalesces the small ones and splits skewed
    ones at run time.
    """
    parts = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(2 * cores),
    }
