"""Metrics and notices on keyed state equal the batch operators."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from barlake.operators import alerts as A
from barlake.operators.metrics import compute_metrics
from barlake.operators.refine import refine_prices
from barlake.schema import BARS_SCHEMA
from barlake.sources import fixtures as FX
from barlake.streaming import state_metrics as S

RULES = [("eod_change", 5), ("sma_crossover", 3), ("sma_crossover", 12)]


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)) for r in df.collect()), key=str)


def _chunks(spark, raw, root, cuts):
    for i, (lo, hi) in enumerate(cuts):
        raw.where((F.col("date") > lo) & (F.col("date") <= hi)).write.parquet(f"{root}/raw/run={i}")
        yield i


def test_state_metrics_equal_batch_also_after_a_crash(spark, sf_small, monkeypatch):
    root = tempfile.mkdtemp(prefix="barlake-state-")
    raw = FX.dirty_bars(spark, sf_small, "user").select(*BARS_SCHEMA.fieldNames())
    cuts = [("1900-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2999-12-31")]
    for i in _chunks(spark, raw, root, cuts):
        if i == 1:  # the batch's rows are written, then the job dies before it is done
            whole = S.overwrite

            def dies(df, path, *rest):
                whole(df, path, *rest)
                if "/late/" in path:
                    raise RuntimeError("killed")
            monkeypatch.setattr(S, "overwrite", dies)
            with pytest.raises(Exception, match="killed"):
                S.run_state_metrics_once(spark, f"{root}/raw", f"{root}/out", f"{root}/ck", RULES)
            monkeypatch.undo()
        S.run_state_metrics_once(spark, f"{root}/raw", f"{root}/out", f"{root}/ck", RULES)
    got = S.state_metrics_table(spark, f"{root}/out", RULES)
    assert _rows(got) == _rows(compute_metrics(refine_prices(raw), RULES))
    assert S.late_rows(spark, f"{root}/out").count() == 0


def test_state_metrics_late_repeated_and_broken_rows(spark):
    root, nan = tempfile.mkdtemp(prefix="barlake-state-"), float("nan")
    day = lambda n: dt.date(2024, 1, n)
    first = [("A", day(2), 1.0, 1.0, 1.0, 10.0, 5), ("A", day(2), None, None, None, 99.0, 5), ("A", day(3), 0.0, -1.0, None, 20.0, None),
             ("B", day(2), None, 1.0, 1.0, 10.0, 5)]
    second = [("A", day(3), 1.0, 1.0, 1.0, 30.0, 5), ("A", day(4), 1.0, 1.0, 1.0, nan, 5), ("A", day(5), 1.0, 1.0, 1.0, 30.0, 2**40),
              ("B", day(3), 7.0, None, None, None, None), ("C", day(9), 1.0, 1.0, 1.0, 1.0, 1)]
    for i, rows in enumerate((first, second)):
        spark.createDataFrame(rows, BARS_SCHEMA).write.parquet(f"{root}/raw/run={i}")
        S.run_state_metrics_once(spark, f"{root}/raw", f"{root}/out", f"{root}/ck", [("eod_change", 5)])
    got = {(r["ticker"], r["date"].day): (r["open"], r["close"], r["volume"], r["close_previous"], r["close_change"])
           for r in S.state_metrics_table(spark, f"{root}/out", [("eod_change", 5)]).collect()}
    assert got == {("A", 2): (1.0, 10.0, 5, None, None), ("A", 3): (1.0, 20.0, 5, 10.0, 100.0), ("A", 5): (1.0, 30.0, 2**40, 20.0, 50.0),
                   ("B", 3): (7.0, 10.0, 5, None, None), ("C", 9): (1.0, 1.0, 1, None, None)}
    assert [(r["ticker"], r["date"], r["close"]) for r in S.late_rows(spark, f"{root}/out").collect()] == [("A", day(3), 30.0)]


def test_state_rearm_equals_batch_and_timers_arm_again(spark):
    root = tempfile.mkdtemp(prefix="barlake-rearm-")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in (0, 1, 3, 4, 9, 10, 20, 29)]
    firings = spark.createDataFrame([(r, d) for r in ("x", "y") for d in (days if r == "x" else days[2:])], "rule_id string, date date")
    firings.write.parquet(f"{root}/all")
    for i, (lo, hi) in enumerate([("2023-01-01", "2024-01-05"), ("2024-01-05", "2024-01-15"), ("2024-01-15", "2025-01-01")]):
        firings.where((F.col("date") > lo) & (F.col("date") <= hi)).write.parquet(f"{root}/in/run={i}")
        S.run_state_rearm_once(spark, f"{root}/in", f"{root}/out", f"{root}/ck", 5)
    got = S.notices_table(spark, f"{root}/out")
    assert _rows(got.where("kind = 'kept'").drop("kind")) == _rows(A.rearm(firings, 5))
    armed = {(r["rule_id"], r["date"]) for r in got.where("kind = 'armed'").collect()}
    assert ("x", dt.date(2024, 1, 15)) in armed and ("x", dt.date(2024, 1, 26)) in armed
    assert got.where("kind = 'late'").count() == 0
