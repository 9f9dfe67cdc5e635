"""Alert rules evaluated on the metrics table.

The reference stores one SQL text per rule and lets a hosted service run it.
Here the two query shapes are DataFrame functions, and the general form
evaluates any number of rules in one scan: the metric columns are unpivoted
to (ticker, date, metric, value) and joined to the rules table on the metric
name with the threshold as a join condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from barlake.config import DEFAULT_EXCHANGE
from barlake.functions import text
from barlake.functions.exprs import to_decimal_10_3
from barlake.functions.names import change_name, crossover_name, sma_name
from barlake.operators.segmented import materialize
from barlake.schema import KEY, ORDER

# Rules and metric rows meet on (metric, bucket): few metrics exist, so the
# bucket spreads the rows of one metric when the rules are too many to broadcast.
RULE_BUCKETS = 16
# More rules than this meet the rows in cells of so many rules and rows: a hit is
# a row of the result, so the cells, not the bytes read, are the work to deal.
CELL_RULES, CELL_ROWS = 1024, 4096
# Tasks that share the cells out, at most.
CELL_TASKS = 20_000


def latest_day(df: DataFrame, order: str = ORDER) -> DataFrame:
    """Rows of the table-wide latest day (not per ticker).  Planned as an
    uncorrelated scalar subquery that runs before the main scan."""
    return df.where(F.col(order) == df.select(F.max(order)).scalar())


def latest_day_per_key(df: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Per-ticker variant (Q4): each ticker's own latest row, by one partial
    aggregation over one scan."""
    rest = [c for c in df.columns if c not in (key, order)]
    newest = df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("__row"))
    return newest.select(*[F.col(key) if c == key else F.col("__row")[c].alias(c) for c in df.columns])


def price_change_alert(metrics: DataFrame, threshold: float, value_col: str = "close",
                       key: str = KEY, order: str = ORDER) -> DataFrame:
    """R2: tickers whose change on the latest day is strictly above the
    threshold in absolute value; the change is reported as DECIMAL(10,3)."""
    change = change_name(value_col)
    today = latest_day(metrics.select(key, order, change), order)
    return (today.where(F.abs(F.col(change)) > F.lit(float(threshold)))
            .select(F.col(key), to_decimal_10_3(F.col(change)).alias(change)))


def sma_cross_alert(metrics: DataFrame, periods: int, value_col: str = "close",
                    key: str = KEY, order: str = ORDER) -> DataFrame:
    """Tickers that crossed their SMA on the latest day, with a label,
    "below" (-1) first.  The ticker is our tie-break for a stable order."""
    co = crossover_name(sma_name(value_col, periods))
    today = latest_day(metrics.select(key, order, co), order)
    return (today.where(F.abs(F.col(co)) > 0)
            .orderBy(F.col(co), F.col(key))
            .select(F.col(key), text.sma_text(F.col(co), periods).alias("sma_text")))


def metric_long(metrics: DataFrame, metric_cols: list[str], key: str = KEY,
                order: str = ORDER) -> DataFrame:
    """Metric columns as (ticker, date, metric, value) rows."""
    return metrics.select(key, order, *[F.col(c).cast("double").alias(c) for c in metric_cols]) \
        .unpivot([key, order], metric_cols, "metric", "value")


def rule_hits(metrics: DataFrame, rules: DataFrame, key: str = KEY, order: str = ORDER,
              latest_only: bool = True) -> DataFrame:
    """R1-R3 generalised: one row per (rule, ticker, date) that fires.

    A rule fires when ``abs(value) > threshold`` for its metric; crossover
    rules carry threshold 0.  With ``latest_only`` only the latest day is
    evaluated (the saved-query semantics); without it every day is, which is
    the history the rearm logic replays.

    Many rules fire on most rows, and the result is nearly all pairs: rules and
    rows are then dealt into cells of bounded size that any number of tasks
    work through, each row meeting each rule in one cell.
    """
    src = latest_day(metrics, order) if latest_only else metrics
    numbers = [f.name for f in metrics.schema if isinstance(f.dataType, NumericType) and f.name not in (key, order)]
    long = metric_long(src, numbers, key, order).where(F.col("value").isNotNull())
    r = rules.select("rule_id", F.col("metric").alias("__metric"), "threshold")
    n_rules = rules.count()
    fires = F.abs(F.col("value")) > F.col("threshold")
    if n_rules > CELL_RULES:
        long, r = _cells(long, r, n_rules, numbers, key, order)
        hits = long.join(r.hint("merge"), (F.col("__bucket") == F.col("__b")) & fires)
    else:
        long = long.withColumn("__bucket", F.pmod(F.xxhash64(key, order), F.lit(RULE_BUCKETS)))
        r = r.withColumn("__b", _upto(RULE_BUCKETS))
        hits = long.join(r, (F.col("metric") == F.col("__metric")) & (F.col("__bucket") == F.col("__b")) & fires)
    return hits.select("rule_id", key, order, "value")


def _upto(n: int) -> Column:
    """A row for each of 0 to n - 1."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _cells(long: DataFrame, rules: DataFrame, n_rules: int, metrics: list[str], key: str,
           order: str) -> tuple[DataFrame, DataFrame]:
    """Rows and rules with the cells (``__bucket``, ``__b``) in which they meet,
    each of one of ``metrics``, dealt alike to as many tasks as there are cells.
    Rows of metrics without a rule are left out.

    A cell is one number, by which both sides are dealt and joined: beside a
    metric that is the same in all rules, the planner would drop the metric
    from the join and deal the rows again, as many tasks to as many tasks, of
    which the driver keeps every pair.  Rules are copied to every block of rows, more
    than their size tells, so they are not broadcast."""
    # The metrics chain runs once, not again for the count.
    long = materialize(long.join(rules.select(F.col("__metric").alias("metric")).distinct(), "metric", "left_semi"))
    down, across = -(-n_rules // CELL_RULES), max(1, -(-long.count() // CELL_ROWS))
    tasks = min(down * across, CELL_TASKS)
    row_part = F.pmod(F.xxhash64(key, order), F.lit(across))
    rule_part = F.pmod(F.xxhash64("rule_id", "threshold"), F.lit(down))

    def cell(bucket: Column, metric: str) -> Column:
        """Null for a metric that no row has."""
        at = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col(metric))
        return F.when(at > 0, bucket * len(metrics) + at - 1)

    # Few tasks read them; the copies are made by more.
    width = min(tasks, int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    long, rules = long.repartition(width, key, order), rules.repartition(width, "rule_id", "threshold")
    long = long.withColumn("__rules", _upto(down)).withColumn("__bucket", cell(F.col("__rules") * across + row_part, "metric")).drop("__rules")
    rules = rules.withColumn("__rows", _upto(across)).withColumn("__b", cell(rule_part * across + F.col("__rows"), "__metric")).drop("__rows")
    return long.repartition(tasks, "__bucket"), rules.repartition(tasks, "__b")


def alert_state(rules: DataFrame, hits: DataFrame, exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    """One row per rule: its query and alert names, the number of
    hits, and the state: TRIGGERED when the query returns a row, UNKNOWN on an
    empty result (the reference's empty-result state; it sends no OK notice)."""
    counts = hits.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_hits"))
    ex = F.lit(exchange)
    qname = text.query_name(F.col("rule_type"), ex, F.col("metric"), F.col("threshold"))
    joined = rules.join(counts, "rule_id", "left")
    n = F.coalesce(F.col("n_hits"), F.lit(0).cast("bigint"))
    return joined.select(
        "rule_id",
        qname.alias("query_name"),
        text.alert_name(qname).alias("alert_name"),
        n.alias("n_hits"),
        F.when(n > 0, F.lit("TRIGGERED")).otherwise(F.lit("UNKNOWN")).alias("state"),
    )


def alert_messages(rules: DataFrame, hits: DataFrame, exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    """subject and first body line of every triggered alert."""
    state = alert_state(rules, hits, exchange).where(F.col("state") == "TRIGGERED")
    ex = F.lit(exchange)
    r = rules.select("rule_id", "rule_type", "threshold", "periods")
    return state.join(r, "rule_id").select(
        "rule_id", "alert_name", "n_hits",
        text.subject(F.col("rule_type"), ex, F.col("threshold"), F.col("periods")).alias("subject"),
        text.body(F.col("rule_type"), F.col("threshold"), F.col("periods")).alias("body"),
    )


def message_rows(rules: DataFrame, hits: DataFrame, exchange: str = DEFAULT_EXCHANGE, key: str = KEY,
                 order: str = ORDER) -> DataFrame:
    """every triggered alert's message as rows, (rule_id, part, ticker,
    text): part 0 the subject, 1 the first body line, 2 one line per hit, so
    that no rule's hits are gathered in one row."""
    head = alert_messages(rules, hits, exchange)
    none = F.lit(None).cast("string")
    lines = head.select("rule_id", F.lit(0).alias("part"), none.alias(key), F.col("subject").alias("text")).unionByName(
        head.select("rule_id", F.lit(1).alias("part"), none.alias(key), F.col("body").alias("text")))
    value = to_decimal_10_3(F.col("value")).cast("string")
    return lines.unionByName(hits.select("rule_id", F.lit(2).alias("part"), key, F.concat_ws(" ", key, F.col(order).cast("string"), value).alias("text")))


def firing_days(hits: DataFrame, order: str = ORDER) -> DataFrame:
    """Days on which each rule's query returned at least one row."""
    return hits.groupBy("rule_id", order).agg(F.count(F.lit(1)).alias("n_hits"))


def rearm(firings: DataFrame, gap_days: int, order: str = ORDER) -> DataFrame:
    """Keep a firing only if it is at least ``gap_days`` after the last
    *kept* firing of the same rule (greedy, in date order).

    Each rule's list holds one entry per firing day, so its length is bounded
    by the calendar, not by the data volume; the fold runs as one
    higher-order expression per rule, without a UDF.
    """
    days = F.array_sort(F.collect_set(F.col(order)))
    init = F.struct(F.lit(None).cast("date").alias("last"),
                    F.array().cast("array<date>").alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        keep = acc["last"].isNull() | (d >= F.date_add(acc["last"], gap_days))
        return F.when(keep, F.struct(d.alias("last"), F.array_append(acc["kept"], d).alias("kept"))) \
            .otherwise(acc)

    folded = firings.groupBy("rule_id").agg(F.aggregate(days, init, step)["kept"].alias("kept"))
    return folded.select("rule_id", F.explode("kept").alias(order))
