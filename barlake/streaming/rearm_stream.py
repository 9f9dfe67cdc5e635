"""Alert rearm (R5) on a stream of firing days.

A rule's notice is kept only if it comes at least ``gap_days`` after the last
*kept* notice of the same rule.  A firing day that arrives late may change
which later days are kept, so each batch folds the whole firing history of the
rules it touches again (one entry per rule and day, bounded by the calendar)
and takes over the kept days of all other rules.  The result goes to a folder
named by the batch id and becomes current with one commit, so the kept days
always equal the batch operator's over everything seen, in whatever order it
came and however often a batch is run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.operators.alerts import rearm
from barlake.session import tune_listing
from barlake.sources.commits import commit, committed
from barlake.sources.tables import MAX_FILE_AGE, overwrite

FIRINGS_SCHEMA = "rule_id string, date date"


def kept_table(spark: SparkSession, out_dir: str) -> DataFrame:
    """(rule_id, date) of the notices kept so far."""
    now = committed(spark, out_dir)
    if now is None:
        return spark.createDataFrame([], FIRINGS_SCHEMA)
    return spark.read.schema(FIRINGS_SCHEMA).parquet(*now["kept"])


def run_rearm_once(spark: SparkSession, firings_dir: str, out_dir: str, checkpoint: str, gap_days: int) -> None:
    """Process every firing file added since the last run, then stop."""
    tune_listing(spark)  # a batch's new files are listed by a Spark job
    source = spark.readStream.schema(FIRINGS_SCHEMA).option("maxFileAge", MAX_FILE_AGE).parquet(firings_dir)

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        touched = batch.select("rule_id").distinct()
        history = session.read.schema(FIRINGS_SCHEMA).parquet(firings_dir).join(touched, "rule_id", "left_semi")
        kept = rearm(history.select("rule_id", "date"), gap_days)
        before = committed(session, out_dir, before=batch_id)
        if before is not None:
            rest = session.read.schema(FIRINGS_SCHEMA).parquet(*before["kept"]).join(touched, "rule_id", "left_anti")
            kept = kept.unionByName(rest)
        target = f"{out_dir}/kept/v={batch_id}"
        overwrite(kept, target)
        commit(session, out_dir, batch_id, kept=[target])

    q = (source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
