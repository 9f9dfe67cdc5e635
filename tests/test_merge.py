"""Merges into stored tables and bucketed tables."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from barlake.operators.ingest import upsert
from barlake.operators.metrics import compute_metrics
from barlake.operators.refine import refine_prices
from barlake.schema import BARS_SCHEMA
from barlake.sources import catalog, fixtures as FX, merge
from barlake.sources.tables import overwrite, scan

COLUMNS = BARS_SCHEMA.fieldNames()


def _rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def _files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[f"{folder}/{n}"] = os.stat(f"{folder}/{n}").st_mtime_ns
    return out


def _bar(ticker, day, close, volume=1):
    return (ticker, dt.date(2024, 1, day), 1.0, 1.0, 1.0, close, volume)


def _table(spark, path, rows):
    overwrite(spark.createDataFrame(rows, BARS_SCHEMA), path, ["date"])


def test_upsert_table_equals_upsert_and_leaves_other_files(spark, sf_small, tmp_path):
    path = f"{tmp_path}/raw"
    sink, batch = FX.sink_bars(spark, sf_small), FX.corrected_bars(spark, sf_small)
    overwrite(sink, path, ["date"])
    before, want = _files(path), _rows(upsert(sink, batch, on_match="update"))
    days = merge.upsert_table(spark, path, batch)
    assert _rows(scan(spark, path, BARS_SCHEMA)) == want
    after = _files(path)
    changed = {f for f in before if before[f] != after.get(f)}
    assert {f.split("date=")[1][:10] for f in changed} == {FX.CHANGED_DAY}
    assert days == len({f.split("date=")[1][:10] for f in after if f not in before})
    assert merge.upsert_table(spark, path, batch) == 0 and _files(path) == after


def test_upsert_table_nulls_repeats_and_insert_only(spark, tmp_path):
    path = f"{tmp_path}/raw"
    _table(spark, path, [_bar("A", 2, 10.0), _bar("B", 2, None), _bar("A", 3, 30.0)])
    batch = spark.createDataFrame([_bar("A", 2, 11.0), _bar("A", 2, None), _bar("B", 2, None), _bar("C", 2, 5.0), _bar("D", 4, None, None)], BARS_SCHEMA)
    same = spark.createDataFrame([_bar("B", 2, None), _bar("A", 3, 30.0)], BARS_SCHEMA)
    assert merge.upsert_table(spark, path, same) == 0
    assert merge.upsert_table(spark, path, batch.limit(0)) == 0
    assert merge.upsert_table(spark, path, batch, on_match="ignore") == 2
    ignored = {("A", 2): 10.0, ("B", 2): None, ("A", 3): 30.0, ("C", 2): 5.0, ("D", 4): None}
    close = lambda: {(r["ticker"], r["date"].day): r["close"] for r in scan(spark, path, BARS_SCHEMA).collect()}
    assert close() == ignored
    assert merge.upsert_table(spark, path, batch) == 1
    assert close() == ignored | {("A", 2): 11.0}
    with pytest.raises(ValueError):
        merge.upsert_table(spark, path, batch.drop("volume"))


def test_a_merge_that_died_while_exchanging_partitions_is_finished(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/raw"
    _table(spark, path, [_bar("A", 2, 10.0), _bar("A", 3, 30.0)])
    batch = spark.createDataFrame([_bar("A", 2, 11.0), _bar("A", 3, 31.0)], BARS_SCHEMA)
    real = merge.finish_merge
    calls = []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return real(*args)
    monkeypatch.setattr(merge, "finish_merge", dies)
    with pytest.raises(RuntimeError):
        merge.upsert_table(spark, path, batch)
    monkeypatch.undo()
    # One of the two partitions was already gone when the job died.
    for f in os.listdir(f"{path}/date=2024-01-02"):
        os.remove(f"{path}/date=2024-01-02/{f}")
    assert merge.upsert_table(spark, path, spark.createDataFrame([_bar("B", 5, 1.0)], BARS_SCHEMA)) == 1
    assert _rows(scan(spark, path, BARS_SCHEMA)) == [_bar("A", 2, 11.0), _bar("A", 3, 31.0), _bar("B", 5, 1.0)]
    assert merge.finish_merge(spark, path) is False
    notes = spark.read.schema("merge string, n long").parquet(f"{path}-pending").collect()
    assert all("staged" in json.loads(r["merge"]) for r in notes if r["merge"]) and len(notes) == 4


def test_upsert_table_reads_touched_partitions_only(spark, tmp_path):
    path = f"{tmp_path}/raw"
    _table(spark, path, [_bar("A", d, 1.0) for d in range(1, 29)])
    some = spark.createDataFrame([_bar("A", 7, 2.0)], BARS_SCHEMA)
    cut = merge._cut_to(scan(spark, path, BARS_SCHEMA), some, ["date"])
    cut.collect()
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [array_contains" in plan
    assert cut.count() == 1


def test_windows_over_a_bucketed_table_need_no_exchange(spark, sf_small, tmp_path):
    raw = FX.dirty_bars(spark, sf_small, "user").select(*COLUMNS)
    table = catalog.save_bucketed(raw, "bars_bucketed_test", f"{tmp_path}/t", 4)
    try:
        out = compute_metrics(refine_prices(table))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort [" not in plan and "Bucketed: true" in plan
        assert catalog.bucket_spread(table).count() <= 4
        rows = lambda df: sorted(map(str, df.collect()))
        assert rows(out) == rows(compute_metrics(refine_prices(raw)))
        batch = FX.update_bars(spark, sf_small).select(*COLUMNS)
        fresh = catalog.latest_by_merge(table, batch.hint("shuffle_merge"))
        scan_side = fresh._jdf.queryExecution().executedPlan().toString().split("Bucketed: true")[0]
        assert scan_side.count("Exchange hashpartitioning(ticker") == 1 or "Exchange" not in scan_side
        stored = table.select("ticker", "date").distinct()
        assert fresh.count() == batch.join(stored, ["ticker", "date"], "left_anti").count()
    finally:
        spark.sql("DROP TABLE bars_bucketed_test")
