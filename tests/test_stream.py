"""Stream = batch: the landing folder ingested in several runs gives the
same raw table as one batch read of all files."""

import datetime as dt
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from barlake.schema import BARS_SCHEMA, QUARANTINE_SCHEMA
from barlake.sources import fixtures as FX
from barlake.sources.landing import read_landing
from barlake.sources.tables import scan
from barlake.streaming.landing_stream import RewrittenFiles, run_once


def test_stream_runs_equal_batch(spark, sf_small):
    root = tempfile.mkdtemp(prefix="barlake-stream-")
    landing = f"{root}/landing"
    cuts = [("2024-01-01", "2024-01-10"), ("2024-01-08", "2024-01-20"), ("2024-01-21", "2024-01-30")]
    for i, (lo, hi) in enumerate(cuts):
        FX.write_fixture_landing(spark, sf_small, f"{landing}/run={i}",
                                 (F.col("date") >= lo) & (F.col("date") <= hi), with_stub=(i == 0))
        run_once(spark, landing, f"{root}/raw", f"{root}/q", f"{root}/ck")
    # A run with no new files changes nothing.
    run_once(spark, landing, f"{root}/raw", f"{root}/q", f"{root}/ck")
    raw = scan(spark, f"{root}/raw", BARS_SCHEMA).select(*BARS_SCHEMA.fieldNames())
    good, _ = read_landing(spark, landing)
    batch = good.select(*BARS_SCHEMA.fieldNames()).distinct()
    assert raw.count() == batch.count()
    assert raw.exceptAll(batch).count() == 0 and batch.exceptAll(raw).count() == 0


def _land(path, name, *lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(["Date,Open,High,Low,Close,Volume", *lines]) + "\n")


def test_every_landed_line_is_loaded_or_quarantined(spark):
    root = tempfile.mkdtemp(prefix="barlake-ex-")
    _land(f"{root}/landing", "ABC.US.csv", "2024-01-02,1,1,1,1.0,1", "Date,1,2,3,4,5", "bad,1,1,1,1,1", "bad,1,1,1,1,1")
    _land(f"{root}/landing", "ABC.LSE.csv", "2024-01-02,1,1,1,2.0,1")
    _land(f"{root}/landing", "XYZ.US.csv", "2024-01-02,1,1,1,5.0,1")
    _land(f"{root}/landing", "NOEX.csv", "2024-01-02,1,1,1,5.0,1")
    from barlake.config import universe
    run_once(spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck", exchange="US",
             universe=universe(spark, ["ABC", "NVDA", "NOEX"]))
    got = [(r.ticker, r.close) for r in scan(spark, f"{root}/raw", BARS_SCHEMA).collect()]
    assert got == [("ABC", 1.0)]
    bad = sorted((r.ticker, r.reason) for r in scan(spark, f"{root}/q", QUARANTINE_SCHEMA).collect())
    assert bad == [("ABC", "bad date"), ("ABC", "bad date"), ("ABC", "other exchange"), ("ABC", "stray header"),
                   ("NOEX", "other exchange"), ("XYZ", "not configured")]


def test_old_files_load_and_rewritten_paths_stop_the_run(spark):
    root = tempfile.mkdtemp(prefix="barlake-old-")
    args = (spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck")
    _land(f"{root}/landing/1", "A.US.csv", "2024-01-02,1,1,1,1.0,1")
    run_once(*args)
    _land(f"{root}/landing/2", "B.US.csv", "2024-01-02,1,1,1,1.0,1")
    os.utime(f"{root}/landing/2/B.US.csv", (1_600_000_000, 1_600_000_000))  # years before the first file
    run_once(*args)
    raw = scan(spark, f"{root}/raw", BARS_SCHEMA)
    assert sorted(r.ticker for r in raw.collect()) == ["A", "B"]
    _land(f"{root}/landing/1", "A.US.csv", "2024-01-02,1,1,1,1.0,1", "2024-01-03,1,1,1,1.0,1")
    os.utime(f"{root}/landing/1/A.US.csv", (1_900_000_000, 1_900_000_000))
    with pytest.raises(RewrittenFiles, match="A.US.csv"):
        run_once(*args)


def test_metrics_stream_is_exact_after_a_crash_anywhere(spark, monkeypatch):
    """The job dies at each write and at the commit of its second batch; run
    again and one more day on, the tables equal a full computation."""
    from barlake.operators.metrics import compute_metrics
    from barlake.operators.refine import refine_prices
    from barlake.streaming import metrics_stream as MS

    alerts = [("eod_change", 5), ("sma_crossover", 3)]
    days = [f"2024-01-0{i},1,2,1,{c},10" for i, c in enumerate([1.5, 1.7, 1.2, 1.9, 2.5, 1.1], 1)]
    real = {"overwrite": MS.overwrite, "commit": MS.commit}
    for name, at in [("overwrite", 1), ("overwrite", 2), ("overwrite", 3), ("commit", 1), ("after commit", 1)]:
        root = tempfile.mkdtemp(prefix="barlake-crash-")

        def step(i, lines):
            _land(f"{root}/landing/{i}", "A.US.csv", *lines)
            run_once(spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck")

        def metrics():
            MS.run_metrics_once(spark, f"{root}/raw", f"{root}/inc", f"{root}/ck-m", alerts)

        step(0, days[:4])
        metrics()
        step(1, days[4:5])
        calls = []

        def broken(*a, **k):
            calls.append(1)
            if len(calls) == at and name != "after commit":
                raise RuntimeError("crash")
            real[name.split()[-1]](*a, **k)
            if name == "after commit":
                raise RuntimeError("crash")

        monkeypatch.setattr(MS, name.split()[-1], broken)
        with pytest.raises(Exception, match="crash"):
            metrics()
        monkeypatch.setattr(MS, name.split()[-1], real[name.split()[-1]])
        metrics()
        step(2, days[5:])
        metrics()
        want = compute_metrics(refine_prices(scan(spark, f"{root}/raw", BARS_SCHEMA)), alerts)
        got = MS.metrics_table(spark, f"{root}/inc").select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), name


def test_rearm_stream_with_late_days_equals_batch(spark):
    from barlake.operators.alerts import rearm
    from barlake.streaming.rearm_stream import FIRINGS_SCHEMA, kept_table, run_rearm_once

    root = tempfile.mkdtemp(prefix="barlake-rearm-")
    day = lambda i: dt.date(2024, 1, i)
    chunks = [[("r", day(10)), ("s", day(3))], [("r", day(2)), ("r", day(14))], [("r", day(8)), ("s", day(4))]]
    for i, rows in enumerate(chunks):
        spark.createDataFrame(rows, FIRINGS_SCHEMA).write.parquet(f"{root}/firings/run={i}")
        run_rearm_once(spark, f"{root}/firings", f"{root}/out", f"{root}/ck", 3)
        seen = spark.createDataFrame([r for c in chunks[:i + 1] for r in c], FIRINGS_SCHEMA)
        assert sorted(map(tuple, kept_table(spark, f"{root}/out").collect())) == sorted(map(tuple, rearm(seen, 3).collect()))


def test_metrics_stream_back_dated_rows_rebuild(spark):
    """A day that lands after later days of its ticker makes the metrics
    stream recompute that ticker; the other ticker goes on incrementally, and
    a later ordinary run reads the state the recompute wrote.  After every run
    the metrics equal a full computation over the raw table."""
    from barlake.operators.metrics import compute_metrics
    from barlake.operators.refine import refine_prices
    from barlake.streaming import metrics_stream as MS

    root = tempfile.mkdtemp(prefix="barlake-late-")
    runs = [
        {"A": ["2024-01-01,1,2,1,1.5,10", "2024-01-02,1,2,1,1.7,10", "2024-01-04,1,2,1,1.2,10"],
         "B": ["2024-01-01,1,2,1,2.5,10", "2024-01-02,1,2,1,0,10", "2024-01-03,1,2,1,2.9,10"]},
        # A's 2024-01-03 is back-dated; B only moves forward.
        {"A": ["2024-01-03,1,2,1,9.0,10", "2024-01-05,1,2,1,1.1,10"],
         "B": ["2024-01-04,1,2,1,3.5,10", "2024-01-05,1,2,1,2.0,10"]},
        {"A": ["2024-01-06,1,2,1,1.9,10", "2024-01-07,1,2,1,2.4,10"],
         "B": ["2024-01-06,1,2,1,1.8,10", "2024-01-07,1,2,1,2.2,10"]},
    ]
    for i, files in enumerate(runs):
        for t, lines in files.items():
            _land(f"{root}/landing/run={i}", f"{t}.US.csv", *lines)
        run_once(spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck")
        MS.run_metrics_once(spark, f"{root}/raw", f"{root}/inc", f"{root}/ck-m")
        got = MS.metrics_table(spark, f"{root}/inc")
        want = compute_metrics(refine_prices(scan(spark, f"{root}/raw", BARS_SCHEMA)))
        assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == \
            sorted(tuple(r) for r in want.collect())
    carry = MS.state_table(spark, f"{root}/inc", "carry")
    assert sorted((r.ticker, str(r.last_date)) for r in carry.collect()) == \
        [("A", "2024-01-07"), ("B", "2024-01-07")]


def test_daily_full_and_incremental_modes_agree(spark, sf_small):
    from barlake.plans.pipeline import run_daily

    root = tempfile.mkdtemp(prefix="barlake-daily-")
    FX.write_fixture_landing(spark, sf_small, f"{root}/landing")
    full = run_daily(spark, f"{root}/landing", f"{root}/full", "r1", mode="full")
    inc = run_daily(spark, f"{root}/landing", f"{root}/inc", "r1", mode="incremental")
    a = sorted(tuple(r) for r in full.collect())
    assert a and a == sorted(tuple(r) for r in inc.collect())
