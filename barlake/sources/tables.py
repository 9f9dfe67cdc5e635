"""Table scans and sinks (parquet, path-addressed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: File streams ignore files older than this against the newest one they saw
#: (Spark's default is a week): no back-fill is that old.
MAX_FILE_AGE = "36500d"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the driver's tables (``{dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan a path table.  Pass the schema for partitioned tables:
    partition values such as ``007`` would otherwise be inferred as INT."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def initialize_table(spark: SparkSession, path: str, schema: StructType,
                     partition_by: Sequence[str] = ()) -> bool:
    """Create an empty table at ``path`` unless one exists.
    Returns True when a table was created."""
    if path_exists(spark, path):
        return False
    writer = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return True


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by the table's partition columns before a partitioned write,
    so each partition folder gets a few large files instead of one small file
    per task.  ``rebalance`` (not ``repartition``) lets AQE split a partition
    value that holds a large share of the rows (a daily load is mostly one
    date) and merge small ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a path table (the insert half of an insert-only merge)."""
    writer = _rebalanced(df, partition_by).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full rewrite of rows and schema.  ``path`` must differ from every
    path ``df`` reads: write a new version and swap readers to it."""
    writer = _rebalanced(df, partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
