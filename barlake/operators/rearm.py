"""R5 for any number of firings: rearm without a list per rule.

``alerts.rearm`` folds a rule's firing days in one array, which the calendar
bounds.  Firings of a tick series have no such bound.  Here each firing gets
its successor, the first firing of its rule at least ``gap`` later, from one
global order; the kept firings are those the successors lead to from the
rule's first one.  They are found by pointer doubling: a round follows all
jumps of 1, 2, 4, ... successors at once, so the rounds grow with the
logarithm of the longest chain, and every join is on (rule, time), which is
unique.

Edge cases: repeated firings count once; firings without a rule or a time are
left out; a gap of zero or less keeps every firing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from barlake.operators.ordered import next_value
from barlake.operators.segmented import BLOCK_ROWS, materialize
from barlake.schema import ORDER

_DAY = 86_400_000_000


def successors(firings: DataFrame, gap: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(rule_id, t, nxt) of distinct (rule_id, t) rows: the first t of the rule
    that is at least ``gap`` later, null if there is none."""
    at = firings.select("rule_id", F.col("t").alias("x"), F.lit(1).alias("kind"), "t")
    asked = firings.select("rule_id", (F.col("t") + gap).alias("x"), F.lit(0).alias("kind"), "t")
    order = [F.col("rule_id"), F.col("x"), F.col("kind"), F.col("t")]
    found = next_value(at.unionByName(asked), "rule_id", order, F.when(F.col("kind") == 1, F.col("x")), "nxt", block_rows)
    return found.where("kind = 0").select("rule_id", "t", "nxt")


def rearm_long(firings: DataFrame, gap_days: float, order: str = ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(rule_id, order) of the kept firings, like ``alerts.rearm``; ``order``
    is a date or a timestamp column."""
    is_date = isinstance(firings.schema[order].dataType, DateType)
    t = F.unix_date(order) if is_date else F.unix_micros(F.col(order).cast("timestamp"))
    gap = -int(-gap_days // 1) if is_date else round(gap_days * _DAY)
    whole = materialize(firings.where(F.col("rule_id").isNotNull() & F.col(order).isNotNull())
                        .select("rule_id", t.cast("bigint").alias("t")).distinct())
    kept = whole
    if gap > 0:
        kept = materialize(whole.groupBy("rule_id").agg(F.min("t").alias("t")))
        jump = materialize(successors(whole, gap, block_rows).where("nxt IS NOT NULL"))
        while True:
            found = materialize(kept.join(jump, ["rule_id", "t"]).select("rule_id", F.col("nxt").alias("t")))
            if found.isEmpty():
                break
            kept = materialize(kept.unionByName(found))
            far = jump.select("rule_id", F.col("t").alias("nxt"), F.col("nxt").alias("far"))
            jump = materialize(jump.join(far, ["rule_id", "nxt"]).select("rule_id", "t", F.col("far").alias("nxt")))
    back = F.date_from_unix_date(F.col("t").cast("int")) if is_date else F.timestamp_micros("t").cast(firings.schema[order].dataType)
    return kept.select("rule_id", back.alias(order))
