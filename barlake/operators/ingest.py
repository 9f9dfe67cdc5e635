"""Incremental ingest: high-water marks, the load plan, de-duplication and the
insert-only merge.

The reference collects the last date of every ticker to the driver and loops
over tickers; here each step is a set operation on DataFrames, so the number
of tickers never reaches the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.config import DEFAULT_LAST_DATE
from barlake.schema import KEY, ORDER


def _date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat()[:10]
    return F.lit(value).cast("date")


def last_dates(raw: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """A1: last loaded date per ticker (partial aggregation, stays distributed)."""
    return raw.groupBy(key).agg(F.max(order).alias("last_date"))


def global_last_date(raw: DataFrame, order: str = ORDER, default=DEFAULT_LAST_DATE) -> DataFrame:
    """A2: latest date over the whole table, or the default when it is empty."""
    return raw.agg(F.coalesce(F.max(order), _date(default)).alias("last_date"))


def high_water_mark(universe: DataFrame, raw: DataFrame, default=DEFAULT_LAST_DATE,
                    key: str = KEY, order: str = ORDER) -> DataFrame:
    """Every configured ticker with its last loaded date, or ``default``
    when it has none.  A left join; Spark (AQE) broadcasts whichever side is
    small at run time."""
    return (universe.join(last_dates(raw, key, order), key, "left")
            .select(*universe.columns, F.coalesce(F.col("last_date"), _date(default)).alias("last_date")))


def symbol(ticker: Column, exchange: Column) -> Column:
    """Vendor symbol ``TICKER.EXCHANGE`` in upper case."""
    return F.concat_ws(".", F.upper(ticker), F.upper(exchange))


def ingest_plan(hwm: DataFrame, as_of=None) -> DataFrame:
    """P14 + F8/F9: which tickers need data and for which dates.

    ``as_of`` is the load date (the reference uses the machine's today; an
    explicit date keeps reruns deterministic).  Tickers already loaded up to
    ``as_of`` are skipped; the others are requested from the day after their
    last date up to ``as_of``.
    """
    today = F.current_date() if as_of is None else _date(as_of)
    return (hwm.where(today > F.col("last_date"))
            .select("exchange", KEY, "last_date",
                    symbol(F.col(KEY), F.col("exchange")).alias("symbol"),
                    F.date_add(F.col("last_date"), 1).alias("date_from"),
                    today.alias("date_to"),
                    F.date_format(F.date_add(F.col("last_date"), 1), "yyyy-MM-dd").alias("date_from_text"),
                    F.date_format(today, "yyyy-MM-dd").alias("date_to_text")))


def dedupe(batch: DataFrame, keys=(KEY, ORDER)) -> DataFrame:
    """A3: one row per key.  Among rows with equal keys the one with the most
    non-NULL values wins, then the smallest by the remaining columns in
    column order, NULL last, so a broken copy never beats a whole one.

    A partial aggregation: even a key repeated in a third of the batch is
    reduced on every mapper before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.select(*keys).distinct()
    gaps = sum((F.col(c).isNull().cast("int") for c in rest), F.lit(0))
    ranked = [x for c in rest for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    best = batch.groupBy(*keys).agg(F.min(F.struct(gaps.alias("__gaps"), *ranked)).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*batch.columns)


def new_rows(sink: DataFrame, updates: DataFrame, keys=(KEY, ORDER),
             dedupe_batch: bool = True) -> DataFrame:
    """Rows of ``updates`` whose key is not yet in ``sink``.

    Matched keys are left as they are (corrections to loaded days are
    ignored).  The sink side is first cut to the batch's own dates, so one
    back-dated row opens one date partition, not all since.
    """
    keys = list(keys)
    batch = dedupe(updates, keys) if dedupe_batch else updates
    target = sink.select(*keys)
    if ORDER in keys:
        # A set of calendar days: small whatever the batch.
        days = updates.select(F.collect_set(ORDER)).scalar()
        target = target.where(F.array_contains(days, F.col(ORDER)))
    return batch.join(target, keys, "left_anti")


def insert_only(sink: DataFrame, updates: DataFrame, keys=(KEY, ORDER)) -> DataFrame:
    """The sink as it is after the merge: old rows plus the new ones."""
    return sink.unionByName(new_rows(sink, updates, keys))


def upsert(sink: DataFrame, updates: DataFrame, keys=(KEY, ORDER), on_match: str = "ignore") -> DataFrame:
    """The sink after a merge of ``updates``: new keys are inserted; with
    ``on_match="update"`` the batch's row replaces the sink's row of an equal
    key (a correction of a loaded day), with ``"ignore"`` the sink's row
    stays."""
    if on_match == "ignore":
        return insert_only(sink, updates, keys)
    if on_match != "update":
        raise ValueError(f"unknown on_match {on_match!r}")
    keys = list(keys)
    batch = dedupe(updates, keys)
    return sink.join(batch.select(*keys), keys, "left_anti").select(*sink.columns).unionByName(batch.select(*sink.columns))
