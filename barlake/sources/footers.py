"""Last dates from Parquet footers: no row is read.

Spark's V2 Parquet reader answers MIN, MAX and COUNT from the statistics in
file footers when they are pushed down: over a whole table, or grouped by its
partition columns.  ``footer_scan`` reads a path table with that reader;
``last_dates`` and ``global_last_date`` are the ingest's high-water marks on
top of it, for tables partitioned by the key (the reference's layout) and for
any table.  The cost is one footer per file, whatever the rows.

Statistics exist for dates and numbers, not for values that are all NULL; a
table without rows gives no last date (the default, where one is asked for).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.config import DEFAULT_LAST_DATE
from barlake.schema import KEY, ORDER

_V1_SOURCES = "spark.sql.sources.useV1SourceList"
_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def _v2_parquet(spark: SparkSession):
    """Tables read here use the V2 reader; other formats stay as they are."""
    before = spark.conf.get(_V1_SOURCES)
    spark.conf.set(_V1_SOURCES, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(_V1_SOURCES, before)


def footer_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A path table whose aggregates are pushed to file footers."""
    spark.conf.set(_PUSHDOWN, "true")
    with _v2_parquet(spark):
        return spark.read.schema(schema).parquet(path)


def last_dates(spark: SparkSession, path: str, schema: StructType, key: str = KEY, order: str = ORDER) -> DataFrame:
    """A1 for a table partitioned by ``key``: (key, last_date)."""
    return footer_scan(spark, path, schema).groupBy(key).agg(F.max(order).alias("last_date"))


def global_last_date(spark: SparkSession, path: str, schema: StructType, order: str = ORDER, default=DEFAULT_LAST_DATE) -> DataFrame:
    """A2: the latest date of the table, or the default when it is empty.

    A table partitioned by ``order`` is answered from its folder names by
    ``spark.sql``'s metadata of partitions instead; this is for the others."""
    newest = footer_scan(spark, path, schema).agg(F.max(order).alias("newest"))
    return newest.select(F.coalesce("newest", F.lit(default).cast("date")).alias("last_date"))


def pushed_aggregates(df: DataFrame) -> bool:
    """Whether the plan takes its aggregates from footers."""
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    return "PushedAggregation: [MAX(" in plan
