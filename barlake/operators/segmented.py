"""Exact per-key windows for series too long (or too skewed) for one task.

A window ``partitionBy(key)`` sends a key's whole series to one task.  These
operators give the same results while no task holds more than a bounded slice
of any key:

* ``segmented`` puts the rows in (key, order) and cuts them into segments of
  at most ``block_rows / 2`` rows, whatever a key's share of the rows and
  however dense its order values are, and writes them down with their segment's
  number, so every later step sees the same segments.  A task deals a range of
  rows, which may hold many small segments.
* Forward fill: fill inside (key, segment), then fill what is still NULL at
  the start of a segment from a carry: the last non-NULL value of the
  preceding segments, found on a small per-segment summary table.
* Lag / SMA / crossover: number the rows of each key (segment row counts ->
  running offsets on the summary table -> ``row_number`` inside the segment),
  cut the numbering into blocks of ``block_rows``, and copy the last ``halo``
  rows of every block into the next one.  Frames reaching back at most
  ``halo`` rows are then complete inside every block; the copies are dropped
  afterwards.

Summaries hold one row per (key, segment).  Rows with a NULL key form a
series of their own, as in a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.refine import drop_incomplete, null_nonpositive
from barlake.schema import KEY, MEASURES, ORDER

SEG = "__seg"
IDX = "__idx"
BLK = "__blk"
HALO = "__halo"
BLOCK_ROWS = 1_000_000
# Rows a range that one task sorts and cuts into segments has at least: the
# ranges, their sample and their tasks follow the rows, not the segments.
RANGE_ROWS = 100_000


def segmented(df: DataFrame, key: str = KEY, order: str = ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``__seg``, written to the checkpoint folder; a frame that
    has segments keeps them."""
    if SEG in df.columns:
        return df
    base = materialize(df)
    size = max(1, block_rows // 2)
    parts = max(1, -(-base.count() // max(size, RANGE_ROWS)))
    ranges = base.repartitionByRange(parts, key, order).sortWithinPartitions(key, order)
    # The number of a row: its range in the upper bits, its place there in the lower 33.
    no, lower = F.monotonically_increasing_id(), F.lit((1 << 33) - 1)
    seg = F.shiftleft(F.shiftright(F.col("__no"), 33), 33) + F.floor(F.col("__no").bitwiseAND(lower) / F.lit(size)).cast("bigint")
    return materialize(ranges.withColumn("__no", no).withColumn(SEG, seg).drop("__no"))


def _same(a: str, b: str, key: str):
    return F.col(f"{a}.{key}").eqNullSafe(F.col(f"{b}.{key}")) & (F.col(f"{a}.{SEG}") == F.col(f"{b}.{SEG}"))


def forward_fill_long(df: DataFrame, columns: Sequence[str] = MEASURES, order: str = ORDER,
                      key: str = KEY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """W1 with the work split by (key, segment); equals ``forward_fill``."""
    return _filled(segmented(df, key, order, block_rows), columns, order, key).select(*df.columns)


def _filled(seg: DataFrame, columns: Sequence[str], order: str, key: str) -> DataFrame:
    cols = list(columns)
    w = (Window.partitionBy(key, SEG).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = seg.select(*[F.last(F.col(c), ignorenulls=True).over(w).alias(c) if c in cols
                         else F.col(c) for c in seg.columns])
    # A segment's last value; rows without an order come first, so theirs counts
    # if no other row has one.
    tail = seg.groupBy(key, SEG).agg(
        *[F.coalesce(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))),
                     F.max_by(F.col(c), F.when(F.col(c).isNotNull() & F.col(order).isNull(), F.lit(1)))).alias(c) for c in cols])
    before = Window.partitionBy(key).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    carry = tail.select(key, SEG, *[F.last(F.col(c), ignorenulls=True).over(before).alias(f"__c_{c}")
                                    for c in cols])
    joined = inner.alias("l").join(carry.alias("r"), _same("l", "r", key), "left")
    return joined.select(*[F.coalesce(F.col(f"l.{c}"), F.col(f"r.__c_{c}")).alias(c) if c in cols
                           else F.col(f"l.{c}").alias(c) for c in seg.columns])


def refine_prices_long(df: DataFrame, measures: Sequence[str] = MEASURES, key: str = KEY,
                       order: str = ORDER, block_rows: int = BLOCK_ROWS, keep_segments: bool = False) -> DataFrame:
    """Raw -> refined, split by (key, segment); equals ``refine_prices``.
    With ``keep_segments`` the rows stay tagged for the metrics to reuse."""
    seg = segmented(null_nonpositive(df, measures), key, order, block_rows)
    out = drop_incomplete(_filled(seg, measures, order, key), df.columns)
    return out if keep_segments else out.select(*df.columns)


def row_index(df: DataFrame, key: str = KEY, order: str = ORDER, block_rows: int = BLOCK_ROWS,
              with_total: bool = False, min_tail: int | None = None) -> DataFrame:
    """Adds ``__idx``: the 0-based position of the row in its key's series,
    without ever placing a whole key in one task.

    Segment row counts go into a small (key, segment) table; running sums over
    it give each segment's first position (and, with ``with_total``, the key's
    row count as ``__total``).  With ``min_tail`` only segments holding some
    of the last ``min_tail`` rows of their key are kept (before the join).
    """
    seg = segmented(df, key, order, block_rows)
    counts = seg.groupBy(key, SEG).agg(F.count(F.lit(1)).alias("__n"))
    by_key = Window.partitionBy(key).orderBy(SEG)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(key, SEG, "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
                            F.sum("__n").over(whole).alias("__total"))
    if min_tail is not None:
        offsets = offsets.where(F.col("__start") + F.col("__n") > F.col("__total") - min_tail)
    extra = ["__total"] if with_total or min_tail is not None else []
    w = Window.partitionBy(f"l.{key}", f"l.{SEG}").orderBy(f"l.{order}")
    joined = seg.alias("l").join(offsets.alias("r"), _same("l", "r", key))
    return joined.select("l.*", *[F.col(f"r.{c}") for c in extra],
                         (F.col("r.__start") + F.row_number().over(w) - 1).alias(IDX))


def blocks_with_halo(df: DataFrame, halo: int, key: str = KEY, order: str = ORDER,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows tagged with ``__blk``; the last ``halo`` rows of each block are
    copied into the next block with ``__halo = true``."""
    size = max(int(block_rows), int(halo), 1)
    idx = row_index(df, key, order, block_rows)
    blk = F.floor(F.col(IDX) / F.lit(size)).cast("bigint")
    in_tail = (F.col(IDX) % F.lit(size)) >= F.lit(size - halo) if halo > 0 else F.lit(False)
    copies = F.when(in_tail, F.array(F.struct(blk.alias("b"), F.lit(False).alias("h")),
                                     F.struct((blk + 1).alias("b"), F.lit(True).alias("h")))) \
        .otherwise(F.array(F.struct(blk.alias("b"), F.lit(False).alias("h"))))
    out = idx.withColumn("__copy", F.explode(copies))
    return out.select(*[c for c in df.columns if c != SEG], F.col("__copy.b").alias(BLK), F.col("__copy.h").alias(HALO))


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(BLK, HALO)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the session's reliable checkpoint
    folder (shared storage on a cluster) and continue from the written copy.
    Used before a pass that reads its input more than once, so a deep input
    plan is computed once and a lost executor does not recompute it."""
    from barlake.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
