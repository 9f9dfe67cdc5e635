"""Incremental refine + metrics: process only new days.

A full rewrite re-reads every ticker's whole history each day.  Because
ingest only appends days after a ticker's last loaded day, the metrics of
old rows never change, and a new row only needs:

* the last non-NULL value of every measure before it (the forward-fill
  carry; taken from raw rows, since rows dropped as incomplete still feed
  later fills), and
* the last ``lookback`` metric rows before it (lag, SMA frames and the
  previous above/below flag).

Both are kept as small state tables with a bounded number of rows per ticker
(1 and ``lookback``), so a daily run costs O(new rows + state), and no task
ever holds more than ``lookback`` + new rows of one ticker.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.config import DEFAULT_ALERTS
from barlake.operators.metrics import compute_metrics, compute_metrics_long, lookback_rows, metric_columns
from barlake.operators.refine import drop_incomplete, forward_fill, null_nonpositive
from barlake.operators.segmented import BLOCK_ROWS, IDX, SEG, forward_fill_long, row_index
from barlake.schema import KEY, MEASURES, ORDER

TAIL = "__tail"


def carry_state(raw: DataFrame, measures=MEASURES, key: str = KEY, order: str = ORDER) -> DataFrame:
    """One row per ticker: its last date and, per measure, the last value
    that survives P1 (non-NULL, > 0).  A partial aggregation."""
    clean = null_nonpositive(raw, measures)
    return clean.groupBy(key).agg(
        F.max(order).alias("last_date"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in measures])


def tail_state(metrics: DataFrame, lookback: int, key: str = KEY, order: str = ORDER,
               strategy: str = "key", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The last ``lookback`` rows of every ticker's metrics; ``"long"`` finds
    them by row numbers over bounded segments."""
    if strategy == "key":
        back = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
        return metrics.withColumn(IDX, back).where(F.col(IDX) <= lookback).drop(IDX)
    idx = row_index(metrics, key, order, block_rows, min_tail=lookback)
    return idx.where(F.col(IDX) >= F.col("__total") - lookback).drop(IDX, SEG, "__total")


def update_carry(carry: DataFrame, new_raw: DataFrame, measures=MEASURES, key: str = KEY,
                 order: str = ORDER) -> DataFrame:
    """Carry after ``new_raw``: a later non-NULL value replaces the old one."""
    fresh = carry_state(new_raw, measures, key, order)
    both = carry.select(key, "last_date", *measures).unionByName(fresh)
    return both.groupBy(key).agg(
        F.max("last_date").alias("last_date"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("last_date"))).alias(c)
          for c in measures])


def incremental_metrics(new_raw: DataFrame, carry: DataFrame, tails: DataFrame,
                        alerts: Iterable[tuple[str, int]] = DEFAULT_ALERTS, value_col: str = "close",
                        measures=MEASURES, key: str = KEY, order: str = ORDER,
                        strategy: str = "key", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Metrics rows for ``new_raw`` (days after each ticker's last day),
    equal to the rows a full recompute would give for those days.

    A ticker has one row a day, so ``"key"`` windows are bounded by the
    calendar; ``"long"`` runs both windows on bounded segments, for series
    without such a bound."""
    alerts = list(alerts)
    clean = null_nonpositive(new_raw, measures)
    # Fill: inside the new rows, then from the carry for what is still NULL.
    fill = {"key": lambda: forward_fill(clean, measures, order, key),
            "long": lambda: forward_fill_long(clean, measures, order, key, block_rows)}
    inner = fill[strategy]()
    c = carry.select(key, *[F.col(m).alias(f"__c_{m}") for m in measures])
    filled = inner.join(c, key, "left").select(
        *[F.coalesce(F.col(m), F.col(f"__c_{m}")).alias(m) if m in measures else F.col(m)
          for m in inner.columns])
    refined = drop_incomplete(filled)
    # Windows over the previous tail rows plus the new rows of each ticker.
    base_cols = refined.columns
    context = tails.select(*base_cols).withColumn(TAIL, F.lit(True))
    both = context.unionByName(refined.withColumn(TAIL, F.lit(False)))
    if strategy == "long":
        out = compute_metrics_long(both, alerts, value_col, key, order, block_rows=block_rows)
    else:
        out = compute_metrics(both, alerts, value_col, key, order)
    return out.where(~F.col(TAIL)).select(*base_cols, *metric_columns(alerts, value_col))


def next_tails(tails: DataFrame, new_metrics: DataFrame, lookback: int, key: str = KEY,
               order: str = ORDER, strategy: str = "key", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Tail state after the run: the last ``lookback`` rows of the old tail
    plus the new rows."""
    both = tails.unionByName(new_metrics.select(*tails.columns))
    return tail_state(both, lookback, key, order, strategy, block_rows)


def initial_state(raw: DataFrame, metrics: DataFrame, alerts=DEFAULT_ALERTS, key: str = KEY,
                  order: str = ORDER, strategy: str = "key") -> tuple[DataFrame, DataFrame]:
    """State after a full run: (carry, tails)."""
    lookback = max(lookback_rows(alerts), 1)
    return carry_state(raw, MEASURES, key, order), tail_state(metrics, lookback, key, order, strategy)
