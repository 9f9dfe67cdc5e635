"""The landing data source: same rows as the text reader, ranges, filters, streams."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from barlake.schema import BARS_SCHEMA, QUARANTINE_SCHEMA
from barlake.sources import eod_source as E
from barlake.sources import fixtures as FX
from barlake.sources import landing as L
from barlake.sources.tables import scan
from barlake.streaming.landing_stream import run_once


def _land(path, name, *lines, end="\n", last=True):
    os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
    with open(f"{path}/{name}", "wb") as f:
        f.write((end.join(lines) + (end if last else "")).encode("utf-8", "surrogateescape"))


def _same(a, b, drop=()):
    for x, y in zip(a, b):
        x, y = x.drop(*drop), y.drop(*drop)
        assert x.columns == y.columns
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


@pytest.fixture()
def folder(spark, sf_small, tmp_path):
    path = FX.write_fixture_landing(spark, sf_small, f"{tmp_path}/landing")
    _land(path, "AAA.US.csv", "Date,Open,High,Low,Close,Volume", "2024-01-02,1,2,0.5,1.5,10", " 2024-01-03 , 1 ,2,0.5,1.5,1e3", "", "   ",
          "not a date,1,2,3,4,5", "Date,1,2,3,4,5", last=False)
    _land(path, "BRK%2FB.LSE.csv", "Close,Extra,Date", "7,x,2024-01-02", "8,y", end="\r\n")
    _land(path, "NOEX.csv", "Date,Close", "2024-01-02,5")
    _land(path, "HEADLESS.US.csv", "2024-01-02,1,2,0.5,1.5,10")
    _land(path, "ÜML.US.csv", "Date,Close", "2024-01-02,\udcff", "2024-01-04,3")
    _land(path, "EMPTY.US.csv", "Value")
    _land(path, "_hidden/X.US.csv", "Date,Close", "2024-01-02,5")
    return path


def test_source_gives_the_text_reader_s_rows(spark, folder):
    _same(L.read_landing(spark, folder), L.read_landing_source(spark, folder), drop=("file",))
    assert L.read_landing_source(spark, folder)[0].count() > 100
    with pytest.raises(ValueError):
        L.loader("nobody")


@pytest.mark.parametrize("size", [7, 64, 300])
def test_files_in_ranges(spark, folder, size):
    E.register(spark)
    rows = spark.read.format("eod_landing").option("partition_bytes", size).option("tickers", "AAA,BRK/B,NOEX,ÜML").load(folder)
    whole = spark.read.format("eod_landing").option("tickers", "AAA,BRK/B,NOEX,ÜML").load(folder)
    assert rows.exceptAll(whole).count() == 0 and rows.count() == whole.count() > 5
    parts = E.LandingReader({"path": folder, "partition_bytes": str(size)}).partitions()
    assert max(r.end - r.start for p in parts for r in p.ranges) <= size


def test_ticker_filter_opens_that_ticker_s_files_only(spark, folder):
    everything = E.LandingReader({"path": folder}).partitions()
    assert len({r.path for p in everything for r in p.ranges}) > 20
    reader = E.LandingReader({"path": folder})
    assert list(reader.pushFilters([EqualTo(("ticker",), "AAA"), GreaterThan(("line",), "x")])) == [GreaterThan(("line",), "x")]
    assert [os.path.basename(r.path) for p in reader.partitions() for r in p.ranges] == ["AAA.US.csv"]
    reader = E.LandingReader({"path": folder})
    assert list(reader.pushFilters([In(("ticker",), ("AAA", "NOEX", "BRK/B")), EqualTo(("exchange",), "US")])) == []
    assert [os.path.basename(r.path) for p in reader.partitions() for r in p.ranges] == ["AAA.US.csv"]
    E.register(spark)
    one = spark.read.format("eod_landing").load(folder).where("ticker = 'AAA'")
    assert "PushedFilters" not in one._jdf.queryExecution().optimizedPlan().toString()
    assert one.rdd.getNumPartitions() == 1
    assert {r["ticker"] for r in one.collect()} == {"AAA"}
    assert spark.read.format("eod_landing").load(folder).where("ticker = 'nobody'").count() == 0


def test_stream_of_the_source_equals_batch(spark, sf_small, tmp_path):
    root = str(tmp_path)
    cuts = [("2024-01-01", "2024-01-10"), ("2024-01-08", "2024-01-20"), ("2024-01-21", "2024-01-30")]
    for i, (lo, hi) in enumerate(cuts):
        FX.write_fixture_landing(spark, sf_small, f"{root}/landing/run={i}", (F.col("date") >= lo) & (F.col("date") <= hi), with_stub=(i == 0))
        run_once(spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck", loader="eod_landing", max_files_per_trigger=25)
    run_once(spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck", loader="eod_landing")
    raw = scan(spark, f"{root}/raw", BARS_SCHEMA).select(*BARS_SCHEMA.fieldNames())
    good, bad = L.read_landing(spark, f"{root}/landing")
    batch = good.select(*BARS_SCHEMA.fieldNames()).distinct()
    assert raw.count() == batch.count()
    assert raw.exceptAll(batch).count() == 0 and batch.exceptAll(raw).count() == 0
    assert scan(spark, f"{root}/q", QUARANTINE_SCHEMA).count() == bad.count()


@pytest.mark.parametrize("loader", ["text", "eod_landing"])
def test_landed_corrections_reach_raw_and_metrics(spark, tmp_path, loader):
    from barlake.plans.pipeline import run_daily
    from barlake.streaming.metrics_stream import metrics_table
    root = str(tmp_path)
    _land(f"{root}/landing/a", "ABC.US.csv", "Date,Open,High,Low,Close,Volume", "2024-01-02,1,1,1,10,1", "2024-01-03,1,1,1,20,1")
    run_daily(spark, f"{root}/landing", root, "r0", loader=loader, on_match="update").count()
    _land(f"{root}/landing/b", "ABC.US.csv", "Date,Open,High,Low,Close,Volume", "2024-01-02,1,1,1,5,1", "2024-01-04,1,1,1,40,1")
    run_daily(spark, f"{root}/landing", root, "r1", loader=loader, on_match="update").count()
    got = {r["date"].day: (r["close"], r["close_change"]) for r in metrics_table(spark, f"{root}/incremental").collect()}
    assert got == {2: (5.0, None), 3: (20.0, 300.0), 4: (40.0, 100.0)}


def test_paths_and_lines(tmp_path):
    assert E.split_path("/x/NVDA.US.csv") == ("NVDA", "US")
    assert E.split_path("/x/symbol=BRK%2FB.US/part-1.txt") == ("BRK/B", "US")
    assert E.split_path("/x/NOEX.csv") == ("NOEX", None) and E.split_path("/x/other.txt") == (None, None)
    data = b"a\nbb\r\n\nccc\nd"
    (tmp_path / "f").write_bytes(data)
    for size in range(1, 14):
        got = []
        for start in range(0, len(data), size):
            with open(tmp_path / "f", "rb") as f:
                got += list(E._lines(f, start, min(start + size, len(data)), block=3))
        assert got == ["a", "bb", "", "ccc", "d"], size
