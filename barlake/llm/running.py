"""Running totals within groups of any size.

Rows are put in order by ranges (``repartitionByRange`` over group and order
columns, so a group that holds most rows spans many ranges) and written down
with the number of their range.  A running total is then the total of a
group's earlier ranges, from a table of one row per (group, range), plus a
window inside (group, range).  No task holds more than one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.storage import materialise


def in_ranges(rows: DataFrame, group: list[str], order: list[Column], name: str, ranges: int | None = None) -> DataFrame:
    """``rows`` written down with ``range_no``, their range in the order of
    ``group``, then ``order``.  The order should tell all rows apart: rows
    equal in it share a range."""
    spark = rows.sparkSession
    width = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(width, *[F.col(g).asc_nulls_last() for g in group], *order)
    return materialise(spark, dealt.withColumn("range_no", F.spark_partition_id()), name)


def range_totals(ranged: DataFrame, group: list[str], total: Column, fold=F.sum) -> DataFrame:
    """(group, range_no, total, before): ``total`` of its rows folded per range
    of a group, and what the group's earlier ranges come to (null for the first).

    The window runs over ranges, not rows: a group has at most as many as
    there are partitions."""
    sums = ranged.groupBy(*group, "range_no").agg(fold(total).alias("total"))
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", fold("total").over(earlier))


def upto(group: list[str], order: list[Column]):
    """The window of a row's predecessors in its range, itself included."""
    return Window.partitionBy(*group, "range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
