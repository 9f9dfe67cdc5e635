"""Rows of one global order, dealt by ranges.

``in_order`` puts rows in order over the whole table, not per key: each task
holds one range, a key with most of all rows spans many of them, and equal keys
may share one.  What a row needs from the rows before or after it is then a
window inside (key, range) plus a value per (key, range) from a small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.segmented import BLOCK_ROWS, SEG, materialize


def in_order(rows: DataFrame, order: list[Column], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows``, written down, with their range ``__seg``; about ``block_rows``
    a range.  The order should tell all rows apart: rows equal in it share a
    range."""
    base = materialize(rows)
    parts = max(1, -(-base.count() // max(1, block_rows)))
    return materialize(base.repartitionByRange(parts, *order).withColumn(SEG, F.spark_partition_id().cast("bigint")))


def sum_before(rows: DataFrame, key: str, order: list[Column], amount: Column, name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``name``, the sum of a whole ``amount`` over the rows of
    their key before them in order.  The key is never null and first in
    ``order``."""
    seg = in_order(rows.withColumn("__n", amount.cast("bigint")), order, block_rows)
    sums = seg.groupBy(key, SEG).agg(F.sum("__n").alias("__total"))
    earlier = Window.partitionBy(key).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(key, SEG, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(key, SEG).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = seg.join(starts, [key, SEG]).withColumn(name, F.col("__start") + F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    return out.select(*rows.columns, name)


def next_value(rows: DataFrame, key: str, order: list[Column], value: Column, name: str,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``name``, the first ``value`` that is not null of a later
    row of their key.  Ranges are read from their end, so that a row's frame
    grows by one row: a frame that shrinks towards the end is added up anew for
    every row."""
    seg = in_order(rows.withColumn("__v", value), order, block_rows)
    inside = Window.partitionBy(key, SEG).orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    own = seg.withColumn("__next", F.last("__v", ignorenulls=True).over(inside))
    # The first value of each range: that of its least row by order.
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    firsts = seg.where("__v IS NOT NULL").groupBy(key, SEG).agg(F.min_by("__v", place).alias("__f"))
    later = Window.partitionBy(key).orderBy(F.col(SEG).desc()).rowsBetween(Window.unboundedPreceding, -1)
    # Ranges without a value of their own still need the next one.
    spans = seg.select(key, SEG).distinct().join(firsts, [key, SEG], "left")
    after = spans.select(key, SEG, F.last("__f", ignorenulls=True).over(later).alias("__after"))
    out = own.join(after, [key, SEG]).withColumn(name, F.coalesce("__next", "__after"))
    return out.select(*rows.columns, name)

