"""Union of unlike files by name, and last dates from footers."""

import datetime as dt

from pyspark.sql import functions as F

from barlake.operators import ingest as I
from barlake.schema import BARS_SCHEMA
from barlake.sources import fixtures as FX
from barlake.sources import footers, landing

COLUMNS = BARS_SCHEMA.fieldNames()


def _land(path, name, *lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_files_with_extra_missing_and_repeated_columns(spark, tmp_path):
    _land(tmp_path / "l", "A.US.csv", "Date,Open,High,Low,Close,Volume", "2024-01-02,1,2,0.5,1.5,10")
    _land(tmp_path / "l", "B.US.csv", "Adj,Date,Close,Note", "9,2024-01-02,7,hello", "8,2024-01-03,6")
    _land(tmp_path / "l", "C.US.csv", "Date,X,X,,Close", "2024-01-02,first,second,third,5")
    good, bad = landing.union_landing(spark, str(tmp_path / "l"))
    rows = {(r["ticker"], r["date"].day): (r["close"], r["volume"], r["extra"]) for r in good.collect()}
    assert rows == {("A", 2): (1.5, 10, {}), ("B", 2): (7.0, None, {"Adj": "9", "Note": "hello"}), ("B", 3): (6.0, None, {"Adj": "8"}),
                    ("C", 2): (5.0, None, {"X": "first"})}
    assert bad.count() == 0
    assert {(r["name"], r["n_rows"]) for r in landing.extra_names(good).collect()} == {("Adj", 2), ("Note", 1), ("X", 1)}
    wide = landing.widened(good, ["Adj", "Note"])
    assert wide.columns == [*good.columns[:-1], "Adj", "Note"]
    assert {(r["ticker"], r["Adj"]) for r in wide.collect()} == {("A", None), ("B", "9"), ("B", "8"), ("C", None)}
    plain = landing.read_landing(spark, str(tmp_path / "l"))[0]
    assert plain.exceptAll(good.drop("extra")).count() == 0 and plain.count() == good.count()


def test_last_dates_from_footers_equal_the_aggregates(spark, sf_small, tmp_path):
    bars = FX.bars(spark, sf_small, "event_type").select(*COLUMNS)
    bars.write.partitionBy("ticker").parquet(f"{tmp_path}/t")
    got = footers.last_dates(spark, f"{tmp_path}/t", BARS_SCHEMA)
    assert footers.pushed_aggregates(got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, I.last_dates(bars).collect()))
    newest = footers.global_last_date(spark, f"{tmp_path}/t", BARS_SCHEMA)
    assert footers.pushed_aggregates(newest)
    assert newest.collect() == I.global_last_date(bars).collect()
    # Other reads keep the V1 reader.
    assert not footers.pushed_aggregates(spark.read.schema(BARS_SCHEMA).parquet(f"{tmp_path}/t").agg(F.max("date")))


def test_last_date_of_an_empty_table_is_the_default(spark, tmp_path):
    spark.createDataFrame([], BARS_SCHEMA).write.parquet(f"{tmp_path}/t")
    assert footers.global_last_date(spark, f"{tmp_path}/t", BARS_SCHEMA).first()[0] == dt.date(2023, 1, 1)
    assert footers.last_dates(spark, f"{tmp_path}/t", BARS_SCHEMA).collect() == []
