"""R1-R3 for very many rules: thresholds ranked once, hits by rank.

``alerts.rule_hits`` gives a row per rule and hit, which for many rules of one
metric is nearly all pairs.  Rules of a metric fire by threshold: a value fires
exactly those whose threshold is below its absolute value, a prefix of the
metric's thresholds in ascending order.  So the rules are ranked once
(``rule_ranks``), and a hit carries the length of its prefix (``ranked_hits``):
the result is as long as rules plus hits.  ``fired_counts`` tells per rule how
many hits it has, and ``hits_of`` expands the rules that are asked for.

Values and thresholds meet in one global order dealt by ranges, so neither a
metric with most of all rows nor one value that repeats fills a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from barlake.operators.alerts import latest_day, metric_long
from barlake.operators.ordered import sum_before
from barlake.operators.segmented import BLOCK_ROWS
from barlake.schema import KEY, ORDER


def rule_ranks(rules: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(metric, rank, rule_id, threshold): the rules of a metric by threshold,
    from rank 1; equal thresholds by rule_id.  Rules without a metric or a
    threshold never fire and have no rank."""
    some = rules.where("metric IS NOT NULL AND threshold IS NOT NULL AND NOT isnan(threshold)").select(
        "metric", F.col("threshold").cast("double").alias("threshold"), "rule_id")
    order = [F.col("metric"), F.col("threshold"), F.col("rule_id")]
    ranked = sum_before(some, "metric", order, F.lit(1), "before", block_rows)
    return ranked.select("metric", (F.col("before") + 1).alias("rank"), "rule_id", "threshold")


def ranked_hits(metrics: DataFrame, rules: DataFrame, key: str = KEY, order: str = ORDER, latest_only: bool = True,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(metric, key, order, value, n_rules): one row per value that fires a
    rule; it fires the rules of ranks 1 to ``n_rules`` of its metric.

    NaN is above every threshold, as in the comparison it stands for."""
    src = latest_day(metrics, order) if latest_only else metrics
    named = {f.name for f in metrics.schema if isinstance(f.dataType, NumericType) and f.name not in (key, order)}
    values = metric_long(src, sorted(named), key, order).where("value IS NOT NULL")
    values = values.join(rules.select("metric").distinct(), "metric", "left_semi")
    marks = rules.where("metric IS NOT NULL AND threshold IS NOT NULL AND NOT isnan(threshold)").select(
        "metric", F.lit(None).cast(values.schema[key].dataType).alias(key), F.lit(None).cast(values.schema[order].dataType).alias(order),
        F.lit(None).cast("double").alias("value"), F.col("threshold").cast("double").alias("x"), F.lit(1).alias("kind"),
        F.xxhash64("rule_id").alias("tie"))
    rows = values.select("metric", key, order, "value", F.abs(F.col("value")).alias("x"), F.lit(0).alias("kind"),
                         F.xxhash64(key, order).alias("tie"))
    # A threshold equal to a value comes after it: the comparison is strict.
    in_order: list[Column] = [F.col("metric"), F.col("x"), F.col("kind"), F.col("tie")]
    counted = sum_before(rows.unionByName(marks), "metric", in_order, F.col("kind"), "n_rules", block_rows)
    return counted.where("kind = 0 AND n_rules > 0").select("metric", key, order, "value", "n_rules")


def fired_counts(hits: DataFrame, ranks: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(rule_id, n_hits) of every ranked rule: the hits of its metric whose
    prefix reaches its rank."""
    lengths = hits.groupBy("metric", F.col("n_rules").alias("rank")).agg(F.count(F.lit(1)).alias("n"))
    both = ranks.join(lengths, ["metric", "rank"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # Those of the metric less those whose prefix ends at a lower rank.
    totals = both.groupBy("metric").agg(F.sum("n").alias("total"))
    before = sum_before(both, "metric", [F.col("metric"), F.col("rank")], F.col("n"), "below", block_rows)
    return before.join(totals, "metric").select("rule_id", (F.col("total") - F.col("below")).alias("n_hits"))


def hits_of(hits: DataFrame, ranks: DataFrame, rule_ids: list[str], key: str = KEY, order: str = ORDER) -> DataFrame:
    """(rule_id, key, order, value) of the rules asked for."""
    asked = ranks.where(F.col("rule_id").isin(rule_ids)).select("metric", "rank", "rule_id")
    return hits.join(asked, "metric").where("n_rules >= rank").select("rule_id", key, order, "value")
