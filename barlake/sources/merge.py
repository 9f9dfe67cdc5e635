"""Merging a batch into a stored, partitioned table, with corrections.

Only the partitions in which the batch changes something are rewritten, by
dynamic partition overwrite; every other file keeps its name and time, and a
batch that brings nothing new writes nothing.

The new content of those partitions is written to a folder of its own first
and noted as pending; only then is it put in place.  A merge that dies before
the note has changed nothing; one that dies after it, even while partitions
are exchanged, is finished from the noted folder by the next merge (or by
``finish_merge``), which gives the same table.  One merge runs at a time.

Edge cases: repeats of a key in the batch count once (``ingest.dedupe``); a
batch row equal to the stored one is no change, NULL equals NULL; a partition
value not stored yet becomes a new partition; an empty batch does nothing; a
batch with other columns than the table is refused; partition values are not
null.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.operators.ingest import dedupe
from barlake.schema import BARS_SCHEMA, KEY, ORDER
from barlake.sources.tables import path_exists, scan


def _aside(path: str, name: str) -> str:
    return f"{path.rstrip('/')}-{name}"


def finish_merge(spark: SparkSession, path: str, schema: StructType = BARS_SCHEMA, partition_by: Sequence[str] = (ORDER,)) -> bool:
    """Put the noted content of a merge in place; true if one was open."""
    note = _aside(path, "pending")
    if not path_exists(spark, note):
        return False
    rows = spark.read.schema("merge string, n long").parquet(note)
    done = rows.where("merge IS NULL").select("n")
    todo = rows.where("merge IS NOT NULL").join(done, "n", "left_anti").orderBy("n").collect()
    for row in todo:
        staged = spark.read.schema(schema).parquet(json.loads(row["merge"])["staged"])
        (staged.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))
        _note(spark, path, None, row["n"])
    return bool(todo)


def _note(spark: SparkSession, path: str, staged: str | None, n: int) -> None:
    said = None if staged is None else json.dumps({"staged": staged})
    spark.createDataFrame([(said, n)], "merge string, n long").coalesce(1).write.mode("append").parquet(_aside(path, "pending"))


def _cut_to(table: DataFrame, some: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows in the partitions of ``some``.  Its values per partition column (for
    dates, a set of calendar days) become a partition filter of the scan."""
    for c in by:
        table = table.where(F.array_contains(some.select(F.collect_set(c)).scalar(), F.col(c)))
    return table.join(some.select(*by).distinct(), list(by), "left_semi") if len(by) > 1 else table


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str] = (KEY, ORDER), on_match: str = "update",
                 schema: StructType = BARS_SCHEMA, partition_by: Sequence[str] = (ORDER,)) -> int:
    """Merge ``updates`` into the table at ``path``: new keys are inserted, and
    with ``on_match="update"`` a batch row replaces the stored row of an equal
    key.  Returns the number of partitions rewritten.

    The stored side is cut to the batch's own partitions before it is joined,
    and Spark may cut it further by a Bloom filter of the batch's keys."""
    if on_match not in ("update", "ignore"):
        raise ValueError(f"unknown on_match {on_match!r}")
    columns, by = schema.fieldNames(), list(partition_by)
    if sorted(updates.columns) != sorted(columns):
        raise ValueError(f"columns {updates.columns} do not fit the table's {columns}")
    finish_merge(spark, path, schema, partition_by)
    number = uuid.uuid4().int >> 66
    batch = dedupe(updates.select(*columns), keys)
    batch_path, staged_path = (f"{_aside(path, 'merges')}/n={number}/{x}" for x in ("batch", "staged"))
    batch.write.parquet(batch_path)
    batch = spark.read.schema(schema).parquet(batch_path)
    stored = _cut_to(scan(spark, path, schema), batch, by).select(*columns)
    old = stored.select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("__old"))
    new = batch.join(old.withColumn("__stored", F.lit(True)), list(keys), "left")
    rest = [c for c in columns if c not in keys]
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col("__old")[c]) for c in rest], F.lit(False))
    changed = F.col("__stored").isNull() | (differs if on_match == "update" else F.lit(False))
    changes = new.where(changed).select(*columns)
    changes.write.parquet(f"{batch_path}-changes")
    changes = spark.read.schema(schema).parquet(f"{batch_path}-changes")
    touched = changes.select(*by).distinct()
    n = touched.count()
    if not n:
        return 0
    kept = _cut_to(scan(spark, path, schema), touched, by).select(*columns).join(changes.select(*keys), list(keys), "left_anti").select(*columns)
    kept.unionByName(changes).write.parquet(staged_path)
    _note(spark, path, staged_path, number)
    finish_merge(spark, path, schema, partition_by)
    return n
