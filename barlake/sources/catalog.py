"""Bucketed tables of the session catalogue: series stored as windows need them.

A table bucketed by its key, each bucket one file sorted by key and order, is
read as already dealt and sorted: windows per key, and merges on the key, need
no exchange of the stored side, and windows no sort either.  The write pays
for one exchange once.

A bucket holds whole series.  Bars have one row per ticker and day, so a bucket
is bounded by its tickers' trading days; series without such a bound belong to
``operators.segmented``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import KEY, ORDER

#: Scans of sorted one-file buckets report their order to the planner.
SORTED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def save_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Store ``df`` as the external table ``name`` at ``path`` and read it.

    Rows are dealt by the hash buckets use, so each bucket is written by one
    task as one file."""
    (df.repartition(buckets, key).sortWithinPartitions(key, order).write.mode("errorifexists").format("parquet")
     .bucketBy(buckets, key).sortBy(key, order).option("path", path).saveAsTable(name))
    return bucketed(df.sparkSession, name)


def bucketed(spark: SparkSession, name: str) -> DataFrame:
    """The stored table, with its order made known."""
    spark.conf.set(SORTED_SCAN, "true")
    return spark.table(name)


def latest_by_merge(table: DataFrame, updates: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Rows of ``updates`` whose key and order are not stored: only the batch is
    dealt to the table's buckets."""
    return updates.join(table.select(key, order), [key, order], "left_anti")


def bucket_spread(table: DataFrame) -> DataFrame:
    """(file, rows) of each stored file, to see whether buckets are even."""
    return table.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
