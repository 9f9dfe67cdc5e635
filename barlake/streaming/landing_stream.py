"""Incremental ingest as a file-source stream.

The landing folder is read as a text stream; each micro-batch holds whole
new files, so a file's header and its data lines arrive together.  Every
batch is parsed, de-duplicated and merged insert-only into the raw table of
one exchange; every other line goes to the quarantine table with the reason.
Run with ``trigger(availableNow=True)`` on a schedule: each run processes the
files that landed since the last one and stops; the checkpoint (in the shared
checkpoint folder) records which files are done.

A file source never reads a path twice, so a delivery must not reuse a path.
Each batch notes its files with their modification times, and a run that finds
a noted path with another time stops before it starts.

Replays are harmless: the anti join against the raw table drops what a first
attempt already wrote, and quarantine and file notes go to folders named by
the batch id, which a replay overwrites.  With ``on_match="update"`` the merge
rewrites days (``sources.merge``); a metrics run that died must then be
finished before the next ingest, as it may still read files of the old days.

The ``eod_landing`` loader tells deliveries apart by their time, so it notes no
files and takes a path that is delivered again as a new delivery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.ingest import new_rows
from barlake.schema import BARS_SCHEMA, QUARANTINE_SCHEMA
from barlake.sources import landing
from barlake.sources.landing import parse_lines
from barlake.sources.merge import upsert_table
from barlake.sources.tables import MAX_FILE_AGE, append, initialize_table, overwrite, path_exists, scan
from barlake.session import tune_listing

FILES_SCHEMA = "file string, modified timestamp"


class RewrittenFiles(ValueError):
    """A landed path was delivered again."""


def _reason(exchange: str, universe: DataFrame | None):
    """Why a parsed line does not belong in the raw table of ``exchange``."""
    reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(
        F.coalesce(F.upper(F.col("exchange")), F.lit("")) != exchange.upper(), F.lit("other exchange"))
    return reason.when(~F.col("configured"), F.lit("not configured")) if universe is not None else reason


def merge_batch(spark: SparkSession, lines: DataFrame, raw_path: str, quarantine_path: str,
                partition_by=("date",), exchange: str = "", universe: DataFrame | None = None,
                batch_id: int = 0, on_match: str = "ignore") -> None:
    """Parse one batch of landed lines and merge it into the raw table; with
    ``on_match="update"`` a landed row corrects the loaded row of its day.

    The parsed batch feeds two writes, so it is persisted for the duration of
    the batch (executor memory, spilling to disk; a lost executor's blocks
    are recomputed from the batch's files).
    """
    parsed = parse_lines(lines, split=False)
    if universe is not None:
        known = universe.select("ticker", F.lit(True).alias("configured")).distinct()
        parsed = parsed.join(known, "ticker", "left").withColumn("configured", F.coalesce("configured", F.lit(False)))
    parsed = parsed.withColumn("reason", _reason(exchange, universe)).persist()
    try:
        bars = parsed.where(F.col("reason").isNull()).select(*BARS_SCHEMA.fieldNames())
        if on_match == "update":
            upsert_table(spark, raw_path, bars, partition_by=partition_by)
        else:
            append(new_rows(scan(spark, raw_path, BARS_SCHEMA), bars), raw_path, partition_by)
        bad = parsed.where(F.col("reason").isNotNull()).select(*QUARANTINE_SCHEMA.fieldNames())
        overwrite(bad, f"{quarantine_path}/batch={batch_id}")
    finally:
        parsed.unpersist()


def check_delivery(spark: SparkSession, landing_dir: str, files_path: str) -> None:
    """Stop when a path that was loaded has changed since."""
    if not path_exists(spark, files_path) or not path_exists(spark, landing_dir):
        return
    now = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing_dir)
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("now")))
    noted = scan(spark, files_path, spark.createDataFrame([], FILES_SCHEMA).schema).select("file", "modified")
    changed = now.join(noted, "file").where("now != modified").select("file").limit(5).collect()
    if changed:
        raise RewrittenFiles("delivered again under a loaded path; use a new folder or name: "
                             + ", ".join(r["file"] for r in changed))


def start_landing_stream(spark: SparkSession, landing_dir: str, raw_path: str,
                         quarantine_path: str, checkpoint: str, available_now: bool = True,
                         max_files_per_trigger: int | None = None, partition_by=("date",),
                         exchange: str = "US", universe: DataFrame | None = None,
                         loader: str = "text", on_match: str = "ignore"):
    """Start the ingest stream of one exchange; returns the StreamingQuery.
    ``loader`` names the reader of landed files (``landing.LOADERS``)."""
    tune_listing(spark)  # a batch's new files are listed by a Spark job
    files_path = f"{raw_path.rstrip('/')}-files"
    if loader == "text":
        check_delivery(spark, landing_dir, files_path)
    initialize_table(spark, raw_path, BARS_SCHEMA, partition_by)
    stream = landing.loader(loader)[1](spark, landing_dir, max_files_per_trigger)

    def run(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        batch = batch.where(F.trim(F.col("line")) != "").persist()  # files are read once
        try:
            merge_batch(session, batch.drop("modified"), raw_path, quarantine_path, partition_by, exchange, universe, epoch_id, on_match)
            if "modified" in batch.columns:
                overwrite(batch.groupBy(landing.stored_file(F.col("file")).alias("file")).agg(F.max("modified").alias("modified")), f"{files_path}/batch={epoch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_once(spark: SparkSession, landing_dir: str, raw_path: str, quarantine_path: str,
             checkpoint: str, **kw) -> None:
    """One scheduled run: process everything that has landed, then stop."""
    q = start_landing_stream(spark, landing_dir, raw_path, quarantine_path, checkpoint,
                             available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
