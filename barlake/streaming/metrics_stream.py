"""Incremental metrics as a stream over the raw table.

Every ingest run appends new parquet files to the raw table; a file-source
stream over that table sees exactly those files.  Each micro-batch reads the
state of the newest commit below its batch id, and

1. checks for back-dated rows (a day not after its ticker's last processed
   day); the tickers that have any are recomputed from their whole raw history
   (rare: ingest only requests later days),
2. computes the metrics of the other new rows from the carry / tail state
   (``barlake.operators.incremental``),
3. writes metrics rows and next state to folders named by the batch id, and
4. makes them current, all three together, with one commit.

A batch that is run again after a crash anywhere starts from the same commit
and overwrites its own folders, never one it reads, so every crash ends in the
same tables.  The first batch (no commit yet) is a full computation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.config import DEFAULT_ALERTS
from barlake.operators import incremental as INC
from barlake.operators.metrics import lookback_rows
from barlake.plans.strategy import build_metrics
from barlake.schema import BARS_SCHEMA, KEY, ORDER
from barlake.session import tune_listing
from barlake.sources.commits import commit, committed
from barlake.sources.tables import MAX_FILE_AGE, overwrite, scan


def _rows(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{root}/metrics").parquet(*folders).drop("v")


def metrics_table(spark: SparkSession, root: str) -> DataFrame:
    """The current metrics rows."""
    return _rows(spark, root, committed(spark, root)["metrics"])


def state_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current ``carry`` or ``tails`` state."""
    return spark.read.parquet(*committed(spark, root)[name])


def process_batch(spark: SparkSession, raw_batch: DataFrame, root: str, batch_id: int,
                  alerts=DEFAULT_ALERTS, strategy: str = "key", raw_path: str | None = None) -> None:
    alerts = list(alerts)
    lookback = max(lookback_rows(alerts), 1)
    target = {name: f"{root}/{name}/v={batch_id}" for name in ("metrics", "carry", "tails")}
    raw_batch = raw_batch.select(*BARS_SCHEMA.fieldNames()).persist()
    before = committed(spark, root, before=batch_id)
    try:
        if before is None:
            overwrite(build_metrics(raw_batch, alerts, strategy), target["metrics"], ["date"])
            carry, tails = INC.initial_state(raw_batch, scan(spark, target["metrics"]), alerts, strategy=strategy)
            folders = [target["metrics"]]
        else:
            folders, carry, tails = _next(spark, root, raw_batch, before, target, alerts, strategy, raw_path, lookback)
        overwrite(carry, target["carry"])
        overwrite(tails, target["tails"])
        commit(spark, root, batch_id, metrics=folders, carry=[target["carry"]], tails=[target["tails"]])
    finally:
        raw_batch.unpersist()


def _next(spark, root, raw_batch, before, target, alerts, strategy, raw_path, lookback):
    """Write the batch's metrics; returns (metrics folders, carry, tails)."""
    carry, tails = scan(spark, before["carry"][0]), scan(spark, before["tails"][0])
    tagged = raw_batch.join(carry.select(KEY, "last_date"), KEY, "left")
    is_new = F.col("last_date").isNull() | (F.col(ORDER) > F.col("last_date"))
    late = tagged.where(~is_new).select(KEY).distinct()
    any_late = raw_path is not None and not late.isEmpty()
    batch = tagged.where(is_new).drop("last_date")
    if any_late:
        batch, carry_rest, tails_rest = (x.join(late, KEY, "left_anti") for x in (raw_batch, carry, tails))
    else:
        carry_rest, tails_rest = carry, tails
    fresh = INC.incremental_metrics(batch, carry_rest, tails_rest, alerts, strategy=strategy)
    if not any_late:
        overwrite(fresh, target["metrics"], ["date"])
        written = scan(spark, target["metrics"], fresh.schema)
        return ([*before["metrics"], target["metrics"]], INC.update_carry(carry, batch),
                INC.next_tails(tails, written, lookback, strategy=strategy))
    # Back-dated rows change the later fills and windows of their tickers
    # only: those are recomputed from the raw table (which holds this batch),
    # all other rows are taken over.
    raw_late = scan(spark, raw_path, BARS_SCHEMA).join(late, KEY, "left_semi")
    kept = _rows(spark, root, before["metrics"]).join(late, KEY, "left_anti")
    rebuilt = build_metrics(raw_late, alerts, strategy)
    overwrite(kept.unionByName(rebuilt).unionByName(fresh), target["metrics"], ["date"])
    written = scan(spark, target["metrics"], rebuilt.schema)
    next_carry = INC.update_carry(carry_rest, batch).unionByName(INC.carry_state(raw_late))
    return [target["metrics"]], next_carry, INC.tail_state(written.select(*tails.columns), lookback, strategy=strategy)


def run_metrics_once(spark: SparkSession, raw_path: str, root: str, checkpoint: str,
                     alerts=DEFAULT_ALERTS, strategy: str = "key") -> None:
    """Process every raw file added since the last run, then stop."""
    tune_listing(spark)  # a batch's new files are listed by a Spark job
    stream = spark.readStream.schema(BARS_SCHEMA).option("maxFileAge", MAX_FILE_AGE).parquet(raw_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch.sparkSession, batch, root, batch_id, alerts, strategy, raw_path)

    q = (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
