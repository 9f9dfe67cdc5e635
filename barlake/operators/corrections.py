"""Corrections of loaded days that reach only the rows they change.

A corrected or back-dated raw row of a ticker changes

* its own fill and that of later rows up to the next row with an own value of
  the measure: the rows from its day to the farthest such next own value over
  all measures (``filled_anew``), and
* the windows of the ``lookback`` rows that follow a row filled anew.

``corrected_metrics`` recomputes exactly those rows, with the ``lookback`` rows
before them as context, in runs of neighbouring rows; everything else stays as
it is stored.  A full run over the corrected raw table gives the same rows.

Only corrected tickers' rows take part; a ticker is bounded by its trading
days.  Its raw rows are read for fills, its refined rows from the stored
metrics.

Edge cases: a correction may make a row complete (it appears) or incomplete (it
goes: ``gone``); a corrected row equal to the old one costs its recomputation
and changes nothing; corrections of tickers without raw rows do nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.config import DEFAULT_ALERTS
from barlake.operators.metrics import compute_metrics, lookback_rows, metric_columns
from barlake.operators.refine import drop_incomplete, forward_fill, null_nonpositive
from barlake.operators.segmented import materialize
from barlake.schema import KEY, MEASURES, ORDER

_END = "9999-12-31"


def filled_anew(raw: DataFrame, changes: DataFrame, measures: Sequence[str] = MEASURES, key: str = KEY, order: str = ORDER) -> DataFrame:
    """The rows of ``raw`` (which holds the changes) whose filled values may be
    new, filled: (columns of raw); rows may still be incomplete."""
    mine = raw.join(changes.select(key).distinct(), key, "left_semi")
    marked = mine.join(changes.select(key, order).distinct().withColumn("__changed", F.lit(True)), [key, order], "left")
    own = null_nonpositive(marked, measures)
    w = Window.partitionBy(key).orderBy(order)
    later = w.rowsBetween(1, Window.unboundedFollowing)
    # Where each measure has its next own value; a measure without one is open.
    nexts = [F.coalesce(F.first(F.when(F.col(m).isNotNull(), F.col(order)), ignorenulls=True).over(later), F.lit(_END).cast("date")) for m in measures]
    until = F.when(F.col("__changed"), F.greatest(*nexts) if len(nexts) > 1 else nexts[0])
    spans = own.withColumn("__until", until)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumn("__reach", F.max("__until").over(upto))
    filled = forward_fill(spans, measures, order, key)
    hit = F.coalesce(F.col("__reach") > F.col(order), F.lit(False)) | F.coalesce(F.col("__changed"), F.lit(False))
    return filled.where(hit).select(*raw.columns)


def corrected_metrics(stored: DataFrame, raw: DataFrame, changes: DataFrame, alerts: Iterable[tuple[str, int]] = DEFAULT_ALERTS,
                      value_col: str = "close", measures: Sequence[str] = MEASURES, key: str = KEY,
                      order: str = ORDER) -> tuple[DataFrame, DataFrame]:
    """(rows, gone): the metrics rows to put in place of the stored ones of
    equal key and order, and the (key, order) of stored rows that go.

    ``stored`` are the metrics before the changes, ``raw`` the raw rows with
    them, ``changes`` the (key, order) of the rows that came or changed."""
    alerts = list(alerts)
    back = max(lookback_rows(alerts), 1)
    columns = raw.columns
    anew = materialize(filled_anew(raw, changes, measures, key, order))
    fresh = drop_incomplete(anew).select(*columns)
    mine = stored.join(changes.select(key).distinct(), key, "left_semi").select(*columns)
    kept = mine.join(anew.select(key, order), [key, order], "left_anti")
    gone = mine.select(key, order).join(anew.select(key, order), [key, order], "left_semi").join(fresh.select(key, order), [key, order], "left_anti")
    # The new series of the tickers, and a mark on each day filled anew, also
    # where no row is left on it.
    rows = kept.withColumn("__mark", F.lit(False)).unionByName(fresh.withColumn("__mark", F.lit(True)))
    marks = gone.select(key, order, F.lit(True).alias("__mark"))
    both = rows.withColumn("__row", F.lit(1)).unionByName(marks.withColumn("__row", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(order)
    numbered = both.withColumn("__no", F.sum("__row").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last_mark = F.last(F.when(F.col("__mark"), F.col("__no")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    due = F.coalesce(F.col("__no") - last_mark <= back, F.lit(False)) & (F.col("__row") == 1)
    timed = numbered.withColumn("__due", due)
    next_due = F.first(F.when(F.col("__due"), F.col("__no")), ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    used = timed.withColumn("__next", next_due).where((F.col("__row") == 1) & (F.col("__next") - F.col("__no") <= back))
    starts = F.coalesce(F.col("__no") - F.lag("__no", 1).over(w) > 1, F.lit(False)).cast("int")
    runs = used.withColumn("__start", starts)
    runs = runs.withColumn("__run", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = compute_metrics(runs.select(*columns, "__due", "__run"), alerts, value_col, [key, "__run"], order)
    return out.where("__due").select(*columns, *metric_columns(alerts, value_col)), gone


def apply_corrections(stored: DataFrame, rows: DataFrame, gone: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """The metrics table with ``rows`` in place and ``gone`` left out."""
    replaced = rows.select(key, order).unionByName(gone.select(key, order))
    return stored.join(replaced, [key, order], "left_anti").select(*stored.columns).unionByName(rows.select(*stored.columns))

