"""Rearm by pointer doubling and thresholds by rank, against the plain forms."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barlake.operators import alerts as A
from barlake.operators import ordered
from barlake.operators.rearm import rearm_long
from barlake.operators.rule_index import fired_counts, hits_of, ranked_hits, rule_ranks
from barlake.operators.segmented import SEG

DAY = dt.date(2024, 1, 1)


def kept_plainly(times, gap):
    out = []
    for t in sorted(set(times)):
        if not out or t >= out[-1] + gap:
            out.append(t)
    return out


@pytest.mark.parametrize("gap, block", [(1, 1000), (5, 7), (40, 3)])
def test_rearm_long_equals_the_fold(spark, gap, block):
    rng = random.Random(gap)
    rows = [(r, DAY + dt.timedelta(days=rng.randrange(200))) for r in ("a", "b", "c") for _ in range(60 if r != "c" else 1)]
    df = spark.createDataFrame([*rows, (None, DAY), ("d", None)], "rule_id string, date date")
    got = sorted(map(tuple, rearm_long(df, gap, block_rows=block).collect()))
    assert got == sorted((r, d) for r in ("a", "b", "c") for d in kept_plainly([x for q, x in rows if q == r], dt.timedelta(days=gap)))
    assert got == sorted(map(tuple, A.rearm(df.where("rule_id IS NOT NULL AND date IS NOT NULL"), gap).collect()))


def test_rearm_long_of_timestamps_and_one_hot_rule(spark):
    rng = random.Random(8)
    start = dt.datetime(2024, 1, 1)
    times = [start + dt.timedelta(seconds=rng.randrange(200_000)) for _ in range(3000)]
    df = spark.createDataFrame([("hot", t) for t in times] + [("cold", start)], "rule_id string, ts timestamp")
    got = rearm_long(df, 0.01, order="ts", block_rows=100)
    want = kept_plainly(times, dt.timedelta(seconds=864))
    assert sorted(r["ts"] for r in got.where("rule_id = 'hot'").collect()) == want and got.where("rule_id = 'cold'").count() == 1
    spread = ordered.in_order(df, [F.col("rule_id"), F.col("ts")], 100).groupBy(SEG).count()
    assert spread.agg(F.max("count")).first()[0] < 400, "a range holds about a block of the hot rule"
    assert rearm_long(df.limit(0), 1, order="ts").collect() == []


def _metrics(spark):
    rng = random.Random(2)
    rows = [(f"t{i}", DAY + dt.timedelta(days=i % 2), rng.choice([None, 0.0, -3.0, 3.0, float("nan"), rng.uniform(-9, 9)]), rng.choice([-1, 0, 1])) for i in range(300)]
    return spark.createDataFrame(rows, "ticker string, date date, close_change double, close_sma_20_co int")


@pytest.mark.parametrize("block, latest", [(1000, True), (10, False)])
def test_ranked_hits_are_the_rule_hits(spark, block, latest):
    rng = random.Random(3)
    rules = [(f"r{i}", "close_change", rng.choice([0.0, 3.0, rng.uniform(0, 9)])) for i in range(50)]
    rules += [("co", "close_sma_20_co", 0.0), ("none", "close_change", None), ("far", "close_change", 1e9), ("other", "no_such", 1.0)]
    rules, metrics = spark.createDataFrame(rules, "rule_id string, metric string, threshold double"), _metrics(spark)
    plain = [tuple(r) for r in A.rule_hits(metrics, rules, latest_only=latest).collect()]
    ranks = rule_ranks(rules, block)
    hits = ranked_hits(metrics, rules, latest_only=latest, block_rows=block)
    expanded = hits.join(ranks, "metric").where("rank <= n_rules").select("rule_id", "ticker", "date", "value")
    assert sorted(map(str, map(tuple, expanded.collect()))) == sorted(map(str, plain))
    count = Counter(r for r, *_ in plain)
    got = {r["rule_id"]: r["n_hits"] for r in fired_counts(hits, ranks, block).collect()}
    assert got == {r["rule_id"]: count[r["rule_id"]] for r in ranks.collect()}
    some = sorted(map(str, map(tuple, hits_of(hits, ranks, ["co", "r7"]).collect())))
    assert some == sorted(str(x) for x in plain if x[0] in ("co", "r7"))


def test_next_value_skips_empty_ranges(spark):
    rows = [("a", i, i if i % 40 == 39 else None) for i in range(100)] + [("b", i, None) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    got = {(r["k"], r["i"]): r["nxt"] for r in ordered.next_value(df, "k", [F.col("k"), F.col("i")], F.col("v"), "nxt", 5).collect()}
    assert got == {(k, i): next((j for j in range(i + 1, 100) if j % 40 == 39), None) if k == "a" else None for k, i, _ in rows}


def test_next_value_reads_no_shrinking_frame(spark, capsys):
    """A frame to the end of a range is added up anew for every row."""
    df = spark.createDataFrame([("a", None, 1), ("a", 1, None), ("a", 2, 5), ("a", 3, None)], "k string, i int, v int")
    out = ordered.next_value(df, "k", [F.col("k"), F.col("i")], F.col("v"), "nxt", 2)
    out.explain(True)
    assert "unboundedfollowing" not in capsys.readouterr().out.lower()
    assert {r["i"]: r["nxt"] for r in out.collect()} == {None: 5, 1: 5, 2: None, 3: None}


def test_many_rules_meet_rows_in_bounded_cells(spark, monkeypatch):
    monkeypatch.setattr(A, "CELL_RULES", 8)
    monkeypatch.setattr(A, "CELL_ROWS", 10)
    metrics = _metrics(spark)
    rules = spark.createDataFrame([(f"r{i}", "close_change", i / 10) for i in range(60)] + [("co", "close_sma_20_co", 0.0), ("none", "close_change", None),
                                  (None, "close_change", 2.0), ("r1", "close_change", 2.0), ("r1", "close_change", 2.0)], "rule_id string, metric string, threshold double")
    got = A.rule_hits(metrics, rules, latest_only=False)
    above = lambda v, t: t is not None and v is not None and (v != v or abs(v) > t)
    want = [(r["rule_id"], m["ticker"], m["date"], float(m[r["metric"]])) for r in rules.collect() for m in metrics.collect() if above(m[r["metric"]], r["threshold"])]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 100 and max(sizes) < len(want) / 20, "the hits are dealt to many tasks"


def test_many_rules_of_one_metric_are_dealt_once(spark, monkeypatch):
    """The planner knows that all rules are of one metric: cells are dealt once
    all the same, and neither side is broadcast."""
    monkeypatch.setattr(A, "CELL_RULES", 4)
    monkeypatch.setattr(A, "CELL_ROWS", 10)
    metrics = _metrics(spark)
    rules = spark.range(40).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("rule_id"), F.lit("close_change").alias("metric"),
                                   (F.col("id") / 5).alias("threshold"))
    got = A.rule_hits(metrics, rules, latest_only=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "ENSURE_REQUIREMENTS" not in plan
    want = [(f"r{i}", m["ticker"], m["date"], m["close_change"]) for i in range(40) for m in metrics.collect()
            if m["close_change"] is not None and (m["close_change"] != m["close_change"] or abs(m["close_change"]) > i / 5)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    other = A.rule_hits(metrics, rules.withColumn("metric", F.lit("no_such")), latest_only=False)
    assert other.collect() == []
