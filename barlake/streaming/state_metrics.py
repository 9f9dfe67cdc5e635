"""Live metrics on keyed state: ``transformWithState`` holds what a series needs.

Each ticker has three pieces of state in the state store:

* ``fill`` (map state): per measure the last value that counts, the carry of
  the forward fill;
* ``ring`` (list state): the last ``lookback`` values of the metric column, no
  more, for previous values and moving averages;
* ``last`` (value state): the last day seen and, per trend line, whether the
  last row stood above it.

A micro-batch updates the state of the tickers it brings and nothing else, so
its cost follows the batch, not the history and not the number of tickers.
State is versioned with the checkpoint: a batch that is run again after a
crash starts from the state before it.

Rows that are not later than their ticker's last day cannot be worked into
kept state; they are put out with ``late`` set and without metrics, and
``run_state_metrics_once`` keeps them in a table of their own
(``barlake.streaming.metrics_stream`` is the job that recomputes their
tickers).  Repeats of a day in one batch count once, the copy with the most
values first, like ``barlake.operators.ingest.dedupe``.

``run_state_rearm_once`` runs the notices of rules on state: a kept notice
sets a timer that rearms its rule ``gap_days`` later in event time, and days
before the last one seen are late.

Edge cases: a null measure is filled, a NaN is a value that drops the row, as
in the batch operators; a row whose fill is still open is dropped but its
values stay in ``fill``; a ticker without any row has no state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barlake.config import DEFAULT_ALERTS, DEFAULT_REARM
from barlake.functions.names import change_name, crossover_name, previous_name, sma_name
from barlake.operators.metrics import lookback_rows, metric_columns
from barlake.schema import BARS_SCHEMA, KEY, MEASURES, ORDER
from barlake.session import tune_listing
from barlake.sources.tables import MAX_FILE_AGE, overwrite, path_exists

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = dt.date(1970, 1, 1)
_DAY_MS = 86_400_000


def output_schema(alerts: Iterable[tuple[str, int]], value_col: str = "close") -> str:
    """The bars columns, the metric columns of the rules, and ``late``."""
    bars = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BARS_SCHEMA)
    metrics = "".join(f", {c} {'int' if c.endswith('_co') else 'double'}" for c in metric_columns(alerts, value_col))
    return f"{bars}{metrics}, late boolean"


class SeriesProcessor(StatefulProcessor):
    """Fills, drops incomplete rows and computes every rule's columns, a day
    at a time."""

    def __init__(self, alerts: Iterable[tuple[str, int]], value_col: str = "close"):
        self.alerts, self.value_col = list(alerts), value_col
        self.lookback = max(lookback_rows(self.alerts) - 1, 1)
        self.trends = sorted({int(p) for kind, p in self.alerts if kind == "sma_crossover"})
        self.columns = metric_columns(self.alerts, value_col)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fill = handle.getMapState("fill", "measure string", "value double, whole long")
        self.ring = handle.getListState("ring", "value double")
        self.last = handle.getValueState("last", "day int, above array<int>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before, above = -10**9, None
        if self.last.exists():
            before, above = self.last.get()
        fill = {k[0]: tuple(v) for k, v in self.fill.iterator()}
        ring = [v[0] for v in self.ring.get()] if self.ring.exists() else []
        kept, day = dict(fill), before
        for row in first_of_days(rows):
            number = (row[ORDER] - _EPOCH).days
            if number <= before:
                yield self._row(row, late=True)
                continue
            day = number
            for m in MEASURES:
                v = row[m]
                if v is not None and (v > 0 or v != v):
                    fill[m] = (None, v) if m == "volume" else (v, None)
            values = {m: fill[m][m == "volume"] for m in MEASURES if m in fill}
            if len(values) == len(MEASURES) and all(v == v for v in values.values()):
                metrics, above = self._metrics(values[self.value_col], ring, above)
                ring = [*ring, values[self.value_col]][-self.lookback:]
                yield self._row({**row, **values, **metrics}, late=False)
        for m, v in fill.items():
            if kept.get(m) != v:
                self.fill.updateValue((m,), v)
        if ring:
            self.ring.put([(v,) for v in ring])
        if day > before:
            self.last.update((day, above))

    def _metrics(self, value: float, ring: list[float], above: list[int] | None) -> tuple[dict, list[int]]:
        out: dict = {}
        name = self.value_col
        if previous_name(name) in self.columns:
            before = ring[-1] if ring else None
            out[previous_name(name)] = before
            out[change_name(name)] = (value - before) / before * 100 if before else None
        flags = []
        for i, n in enumerate(self.trends):
            frame = [*ring[-n:], value] if n else [value]
            mean = sum(frame) / len(frame)
            flags.append(1 if value >= mean else -1)
            out[sma_name(name, n)] = mean
            out[crossover_name(sma_name(name, n))] = flags[i] if above is not None and above[i] != flags[i] else 0
        return out, flags

    def _row(self, values: dict, late: bool) -> Row:
        return Row(**{c: values.get(c) for c in (*BARS_SCHEMA.fieldNames(), *self.columns)}, late=late)

    def close(self) -> None:
        pass


def first_of_days(rows: Iterator[Row]) -> Iterator[dict]:
    """A key's rows by day; of repeats of a day the one with the most values,
    then the smallest by the measures in order."""
    best: dict = {}
    for r in rows:
        row = r.asDict()
        rank = (sum(row[m] is None for m in MEASURES), [(row[m] is None, row[m] != row[m], row[m] if row[m] == row[m] else 0) for m in MEASURES])
        if row[ORDER] not in best or rank < best[row[ORDER]][0]:
            best[row[ORDER]] = (rank, row)
    for day in sorted(best):
        yield best[day][1]


class RearmProcessor(StatefulProcessor):
    """A rule's notices: kept when ``gap_days`` have passed since the last kept
    one; the timer of a kept notice tells when its rule is armed again."""

    def __init__(self, gap_days: int):
        self.gap = gap_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "seen int, kept int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        seen, kept = self.last.get() if self.last.exists() else (None, None)
        start = seen
        for day in sorted({(r[ORDER] - _EPOCH).days for r in rows}):
            if start is not None and day <= start:
                yield Row(rule_id=key[0], date=_day(day), kind="late")
                continue
            seen = day
            if kept is None or day >= kept + self.gap:
                kept = day
                self.handle.registerTimer((kept + self.gap) * _DAY_MS)
                yield Row(rule_id=key[0], date=_day(day), kind="kept")
        if seen is not None:
            self.last.update((seen, kept))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # The next kept notice comes on this day at the earliest.
        yield Row(rule_id=key[0], date=_day(expiredTimerInfo.getExpiryTimeInMs() // _DAY_MS), kind="armed")

    def close(self) -> None:
        pass


def _day(number: int) -> dt.date:
    return _EPOCH + dt.timedelta(days=number)


# --- jobs --------------------------------------------------------------------------

def _run(spark: SparkSession, out: DataFrame, write, checkpoint: str, mode: str, partitions: int | None) -> None:
    """One availableNow run; state lives in RocksDB, under the checkpoint, in as
    many partitions as the first run shuffles to."""
    confs = {"spark.sql.streaming.stateStore.providerClass": PROVIDER}
    if partitions:
        confs["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        q = (out.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    if q.exception() is not None:
        raise q.exception()


def run_state_metrics_once(spark: SparkSession, raw_path: str, root: str, checkpoint: str,
                           alerts: Iterable[tuple[str, int]] = DEFAULT_ALERTS, partitions: int | None = None) -> None:
    """Work every raw file added since the last run into the metrics table,
    then stop.  Each batch writes folders named by its id, which a replay
    overwrites, and nothing older."""
    tune_listing(spark)
    alerts = list(alerts)
    bars = spark.readStream.schema(BARS_SCHEMA).option("maxFileAge", MAX_FILE_AGE).parquet(raw_path)
    out = bars.select(*BARS_SCHEMA.fieldNames()).groupBy(KEY).transformWithState(
        SeriesProcessor(alerts), output_schema(alerts), "Append", "None")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            overwrite(rows.where("NOT late").drop("late"), f"{root}/metrics/batch={batch_id}", [ORDER])
            overwrite(rows.where("late").select(*BARS_SCHEMA.fieldNames()), f"{root}/late/batch={batch_id}")
        finally:
            rows.unpersist()

    _run(spark, out, write, checkpoint, "append", partitions)


def state_metrics_table(spark: SparkSession, root: str, alerts: Iterable[tuple[str, int]] = DEFAULT_ALERTS) -> DataFrame:
    """The metrics rows of all batches so far."""
    columns = [*BARS_SCHEMA.fieldNames(), *metric_columns(alerts)]
    if not path_exists(spark, f"{root}/metrics"):
        return spark.createDataFrame([], output_schema(alerts)).select(*columns)
    schema = spark.createDataFrame([], output_schema(alerts)).drop("late").schema
    return spark.read.schema(schema.add("batch", "long")).parquet(f"{root}/metrics").select(*columns)


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that came after a later day of their ticker."""
    return spark.read.schema(BARS_SCHEMA).parquet(f"{root}/late").select(*BARS_SCHEMA.fieldNames())


NOTICES = "rule_id string, date date, kind string"


def run_state_rearm_once(spark: SparkSession, firings_dir: str, root: str, checkpoint: str, gap_days: int = DEFAULT_REARM,
                         partitions: int | None = None) -> None:
    """Notices of the firing days (rule_id, date) added since the last run:
    kept, late, and the days on which a rule is armed again."""
    tune_listing(spark)
    days = spark.readStream.schema("rule_id string, date date").option("maxFileAge", MAX_FILE_AGE).parquet(firings_dir)
    timed = days.withColumn("at", F.col(ORDER).cast("timestamp")).withWatermark("at", "0 seconds")
    out = timed.groupBy("rule_id").transformWithState(RearmProcessor(gap_days), NOTICES, "Append", "EventTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        overwrite(batch, f"{root}/notices/batch={batch_id}")

    _run(spark, out, write, checkpoint, "append", partitions)


def notices_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{NOTICES}, batch long").parquet(f"{root}/notices").drop("batch")
