"""Landed files in bundles: the rows of one file per symbol, in few files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from barlake.schema import BARS_SCHEMA
from barlake.sources import fixtures as FX
from barlake.sources import landing as L
from barlake.sources.tables import scan
from barlake.streaming.landing_stream import RewrittenFiles, run_once

NAMES = ["NVDA.US", "BRK/B.US", "A B.US", "A%2B.US", "ÜML.LSE", "#1.US", "NOEX"]


def _rows(spark):
    """Symbols with headers of their own, a stray header, a bad date, a stub."""
    rows = []
    for i, name in enumerate(NAMES):
        rows.append((name, 0, None, "Close,Date,More" if i % 2 else "Date,Close"))
        rows += [(name, 1, f"2024-01-0{d}", f"{d}.5,2024-01-0{d},x" if i % 2 else f"2024-01-0{d}, {d}.5") for d in (2, 3, 4)]
    rows += [("NVDA.US", 1, "2024-01-05", "Date,1"), ("A B.US", 1, "2024-01-06", "05/01/2024,1"), ("NONE.US", 0, None, "Value"),
             ("HEADLESS.US", 1, "2024-01-02", "2024-01-02,1"), ("NVDA.US", 1, "2024-01-07", "")]
    return spark.createDataFrame(rows, "symbol string, part int, day string, line string").select("symbol", "part", F.to_date("day").alias("date"), "line")


def _sorted(df):
    return sorted(str(r) for r in df.drop("file").collect())


@pytest.mark.parametrize("read", [L.read_landing, L.read_landing_source])
def test_bundles_give_the_rows_of_single_files(spark, tmp_path, read):
    L.write_symbol_files(_rows(spark), f"{tmp_path}/files")
    L.write_bundles(_rows(spark), f"{tmp_path}/bundles")
    files, bundles = (read(spark, f"{tmp_path}/{x}") for x in ("files", "bundles"))
    assert [_sorted(x) for x in files] == [_sorted(x) for x in bundles]
    assert {r["ticker"] for r in bundles[0].collect()} == {"NVDA", "BRK/B", "A B", "A%2B", "ÜML", "#1", "NOEX"}
    assert {r["reason"] for r in bundles[1].collect()} == {"stray header", "bad date", "no header"}


def test_the_source_reads_the_asked_members(spark, tmp_path):
    L.write_bundles(_rows(spark), str(tmp_path))
    got = L.read_landing_source(spark, str(tmp_path), ["BRK/B", "NOEX"])[0]
    assert {r["ticker"] for r in got.collect()} == {"BRK/B", "NOEX"}


def test_a_line_of_no_member_is_kept_apart(spark, tmp_path):
    os.makedirs(f"{tmp_path}/{L.BUNDLE}")
    with open(f"{tmp_path}/{L.BUNDLE}/b.txt", "w") as f:
        f.write("A.US\tDate,Close\nA.US\t2024-01-02,1\nstray\nB.US\tClose,Date\nB.US\t2,2024-01-02\n")
    for read in (L.read_landing, L.read_landing_source):
        good, bad = read(spark, str(tmp_path))
        assert {(r["ticker"], r["close"]) for r in good.collect()} == {("A", 1.0), ("B", 2.0)}
        assert [(r["line"], r["reason"]) for r in bad.collect()] == [("stray", "no header")]


def test_queries_land_in_files_that_do_not_grow_with_the_symbols(spark, sf_small, tmp_path):
    """One file per symbol was listed again and again through the driver."""
    FX.write_fixture_landing(spark, sf_small, f"{tmp_path}/bundles", bundled=True)
    FX.write_fixture_landing(spark, sf_small, f"{tmp_path}/files")
    found = glob.glob(f"{tmp_path}/bundles/**/*.txt", recursive=True)
    assert len(found) <= int(spark.conf.get("spark.sql.shuffle.partitions")) < len(glob.glob(f"{tmp_path}/files/**/*.txt", recursive=True))
    for a, b in zip(L.read_landing(spark, f"{tmp_path}/files"), L.read_landing(spark, f"{tmp_path}/bundles")):
        assert _sorted(a) == _sorted(b)


@pytest.mark.parametrize("loader", ["text", "eod_landing"])
def test_streams_of_bundles(spark, tmp_path, loader):
    root = str(tmp_path)
    L.write_bundles(_rows(spark), f"{root}/landing/1")
    run_once(spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck", loader=loader)
    assert scan(spark, f"{root}/raw", BARS_SCHEMA).count() == 5 * 3
    run_once(spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck", loader=loader)
    assert scan(spark, f"{root}/raw", BARS_SCHEMA).count() == 5 * 3
    if loader == "text":
        one = glob.glob(f"{root}/landing/1/**/*.txt", recursive=True)[0]
        os.utime(one, (1_900_000_000, 1_900_000_000))
        with pytest.raises(RewrittenFiles):
            run_once(spark, f"{root}/landing", f"{root}/raw", f"{root}/q", f"{root}/ck", loader=loader)
