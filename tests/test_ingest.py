"""A1-A3, J1-J3, P14, S4, S8 and landed files."""

import datetime as dt
import os
import tempfile


from barlake.config import universe
from barlake.operators import ingest as I
from barlake.schema import BARS_SCHEMA
from barlake.sources.landing import read_landing, write_landing
from barlake.sources.tables import append, initialize_table, scan


def d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def bars(spark, data):
    return spark.createDataFrame(data, BARS_SCHEMA)


def test_high_water_mark_and_plan(spark):
    raw = bars(spark, [("NVDA", d(0), 1.0, 1.0, 1.0, 1.0, 1), ("NVDA", d(3), 1.0, 1.0, 1.0, 1.0, 1),
                       ("AMD", d(9), 1.0, 1.0, 1.0, 1.0, 1)])
    u = universe(spark, ["NVDA", "AMD", "TSM"])
    hwm = {r.ticker: r.last_date for r in I.high_water_mark(u, raw).collect()}
    assert hwm == {"NVDA": d(3), "AMD": d(9), "TSM": dt.date(2023, 1, 1)}
    plan = {r.ticker: r for r in I.ingest_plan(I.high_water_mark(u, raw), d(9)).collect()}
    assert set(plan) == {"NVDA", "TSM"}  # AMD is loaded up to the as-of date
    assert plan["NVDA"].symbol == "NVDA.US" and plan["NVDA"].date_from_text == "2024-01-05"
    assert plan["TSM"].date_from == dt.date(2023, 1, 2) and plan["TSM"].date_to_text == "2024-01-10"


def test_dedupe_and_insert_only(spark):
    sink = bars(spark, [("A", d(0), 1.0, 1.0, 1.0, 1.0, 1)])
    upd = bars(spark, [("A", d(0), 9.0, 9.0, 9.0, 9.0, 9),     # correction: ignored
                       ("A", d(1), 2.0, 2.0, 2.0, 2.0, 2),
                       ("A", d(1), 2.0, 2.0, 2.0, 2.0, 2),     # in-batch duplicate
                       ("A", d(2), 3.0, 3.0, 3.0, 5.0, 3),
                       ("A", d(2), 3.0, 3.0, 3.0, 4.0, 3)])    # same key, other values
    out = sorted(tuple(r) for r in I.insert_only(sink, upd).collect())
    assert out == [("A", d(0), 1.0, 1.0, 1.0, 1.0, 1), ("A", d(1), 2.0, 2.0, 2.0, 2.0, 2),
                   ("A", d(2), 3.0, 3.0, 3.0, 4.0, 3)]
    # Ingesting the same batch twice equals ingesting it once.
    once = I.insert_only(sink, upd)
    twice = I.insert_only(once, upd)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_initialize_and_append(spark):
    root = tempfile.mkdtemp(prefix="barlake-test-")
    path = f"{root}/raw"
    assert initialize_table(spark, path, BARS_SCHEMA, ["date"]) is True
    assert initialize_table(spark, path, BARS_SCHEMA, ["date"]) is False
    append(bars(spark, [("A", d(0), 1.0, 1.0, 1.0, 1.0, 1)]), path, ["date"])
    assert scan(spark, path, BARS_SCHEMA).count() == 1


def _write(path, name, text):
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_landing_edge_files(spark):
    path = tempfile.mkdtemp(prefix="barlake-landing-")
    _write(path, "NVDA.US.csv", "Date,Open,High,Low,Close,Volume\n"
                                "2024-01-02,1.5,2.5,1.0,2.0,3000000000\n"
                                "2024-01-03,bad,2.0,1.0,1.5,100\n"
                                "2024-01-04,1.0,2.0\n"
                                "01/05/2024,1.0,2.0,1.0,1.5,100\n")
    _write(path, "AMD.US.csv", "Date,Close,Open,High,Low,Volume\n2024-01-02,7.0,6.0,8.0,5.0,10\n")
    _write(path, "TSM.US.csv", "Value\n")
    good, bad = read_landing(spark, path)
    got = {(r.ticker, r.date): r for r in good.collect()}
    assert set(got) == {("NVDA", d(1)), ("NVDA", d(2)), ("NVDA", d(3)), ("AMD", d(1))}
    assert got[("NVDA", d(1))].volume == 3000000000          # beyond 32 bits
    assert got[("NVDA", d(2))].open is None                   # "bad" cell -> NULL
    assert got[("NVDA", d(3))].low is None and got[("NVDA", d(3))].high == 2.0  # short row
    amd = got[("AMD", d(1))]
    assert (amd.open, amd.high, amd.low, amd.close, amd.exchange) == (6.0, 8.0, 5.0, 7.0, "US")
    q = [(r.ticker, r.date_text, r.reason) for r in bad.collect()]
    assert q == [("NVDA", "01/05/2024", "bad date")]


def test_landing_round_trip(spark):
    path = tempfile.mkdtemp(prefix="barlake-landing-")
    src = bars(spark, [("A", d(i), 1.0 + i / 3, 2.0, 0.5, 1.25, 10 + i) for i in range(5)]
               + [("B.X", d(0), 0.1, 0.2, 0.3, 0.4, 5), ("BRK/B", d(0), 1.0, 1.0, 1.0, 1.0, 1),
                  ("BRAND#7", d(0), 2.0, 2.0, 2.0, 2.0, 2)])
    write_landing(src, path)
    assert len([x for x in os.listdir(path) if x.startswith("symbol=")]) == 4
    good, bad = read_landing(spark, path)
    assert bad.count() == 0
    assert sorted(map(tuple, good.drop("exchange").collect())) == sorted(map(tuple, src.collect()))


def test_merge_on_date_only_for_one_ticker_table(spark):
    """A table holding one ticker merges on the date alone."""
    schema = "date date, close double"
    sink = spark.createDataFrame([(d(0), 1.0), (d(1), 2.0)], schema)
    upd = spark.createDataFrame([(d(1), 9.0), (d(2), 3.0), (d(2), 3.0)], schema)
    out = sorted(tuple(r) for r in I.insert_only(sink, upd, keys=("date",)).collect())
    assert out == [(d(0), 1.0), (d(1), 2.0), (d(2), 3.0)]


def test_commits_name_all_tables_at_once(spark):
    from barlake.sources.commits import commit, committed

    root = tempfile.mkdtemp(prefix="barlake-commit-")
    assert committed(spark, root) is None
    commit(spark, root, 0, metrics=["m0"], carry=["c0"])
    commit(spark, root, 7, metrics=["m0", "m7"], carry=["c7"])
    assert committed(spark, root) == {"metrics": ["m0", "m7"], "carry": ["c7"]}
    assert committed(spark, root, before=7) == {"metrics": ["m0"], "carry": ["c0"]}
    assert committed(spark, root, before=0) is None


def test_dedupe_prefers_whole_rows(spark):
    rows = [("A", d(0), None, None, None, None, None), ("A", d(0), 1.0, 2.0, 0.5, 1.5, 10), ("A", d(0), 1.0, 2.0, 0.5, None, 99),
            ("B", d(0), None, 2.0, None, None, 3), ("B", d(0), None, 1.0, None, None, 9)]
    got = sorted(tuple(r) for r in I.dedupe(bars(spark, rows)).collect())
    assert got == [("A", d(0), 1.0, 2.0, 0.5, 1.5, 10), ("B", d(0), None, 1.0, None, None, 9)]


def test_upsert_updates_matches_only_when_asked(spark):
    sink = bars(spark, [("A", d(0), 1.0, 1.0, 1.0, 1.0, 1), ("A", d(1), 2.0, 2.0, 2.0, 2.0, 2)])
    upd = bars(spark, [("A", d(1), 9.0, 9.0, 9.0, 9.0, 9), ("A", d(2), 3.0, 3.0, 3.0, 3.0, 3)])
    closes = lambda df: sorted((r.date, r.close) for r in df.collect())
    assert closes(I.upsert(sink, upd)) == [(d(0), 1.0), (d(1), 2.0), (d(2), 3.0)]
    assert closes(I.upsert(sink, upd, on_match="update")) == [(d(0), 1.0), (d(1), 9.0), (d(2), 3.0)]


def test_cluster_conf_sizes_partitions():
    from barlake.session import cluster_conf

    conf = cluster_conf(100 * 2**40, 4000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(10**6, 8)["spark.sql.shuffle.partitions"]) == 16


def test_landing_crlf_and_extra_columns(spark):
    path = tempfile.mkdtemp(prefix="barlake-landing-")
    _write(path, "MU.US.csv", "Date,Open,High,Low,Close,Adjusted_close,Volume\r\n"
                              "2024-01-02,1.0,2.0,0.5,1.5,1.4,7\r\n")
    good, bad = read_landing(spark, path)
    r = good.collect()
    assert len(r) == 1 and (r[0].ticker, r[0].close, r[0].volume) == ("MU", 1.5, 7)
    assert bad.count() == 0


def test_merge_prunes_sink_to_batch_dates(spark):
    """The anti join reads only the sink partitions the batch can touch."""
    root = tempfile.mkdtemp(prefix="barlake-prune-")
    sink_rows = [("A", d(i), 1.0, 1.0, 1.0, 1.0, 1) for i in range(10)]
    append(bars(spark, sink_rows), f"{root}/raw", ["date"])
    sink = scan(spark, f"{root}/raw", BARS_SCHEMA)
    upd = bars(spark, [("A", d(9), 2.0, 2.0, 2.0, 2.0, 2), ("A", d(10), 3.0, 3.0, 3.0, 3.0, 3)])
    out = I.new_rows(sink, upd)
    assert [r.date for r in out.collect()] == [d(10)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "array_contains(Subquery" in plan[plan.index("PartitionFilters: ["):]


def test_landing_file_without_header_is_quarantined(spark):
    path = tempfile.mkdtemp(prefix="barlake-landing-")
    _write(path, "ABC.US.csv", "2024-01-02,1.0,2.0,0.5,1.5,7\n")
    _write(path, "XYZ.csv", "Date,Open,High,Low,Close,Volume\n2024-01-02,1.0,2.0,0.5,1.5,7\n")
    good, bad = read_landing(spark, path)
    assert [(r.ticker, r.exchange) for r in good.collect()] == [("XYZ", None)]
    assert [(r.ticker, r.reason) for r in bad.collect()] == [("ABC", "no header")]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

FIELDS = ["Date", "Open", "High", "Low", "Close", "Volume"]


@settings(max_examples=8, deadline=None)
@given(order=st.permutations(FIELDS), extra=st.booleans())
def test_landing_any_column_order(spark, order, extra):
    """Fields are picked by header name: any column order (and an unknown
    extra column) decodes to the same bars."""
    values = {"Date": "2024-01-02", "Open": "1.25", "High": "2.5", "Low": "0.75",
              "Close": "1.5", "Volume": "4200000000"}
    header = list(order) + (["Adjusted_close"] if extra else [])
    line = [values[f] for f in order] + (["9.9"] if extra else [])
    path = tempfile.mkdtemp(prefix="barlake-perm-")
    _write(path, "Q.US.csv", ",".join(header) + "\n" + ",".join(line) + "\n")
    good, bad = read_landing(spark, path)
    r = good.collect()
    assert bad.count() == 0 and len(r) == 1
    assert (r[0].date, r[0].open, r[0].high, r[0].low, r[0].close, r[0].volume) == \
        (d(1), 1.25, 2.5, 0.75, 1.5, 4200000000)


def test_landing_partitioned_folder_layout(spark):
    """Files under symbol=... folders, as Spark's partitioned text writer
    lays them out (it escapes '#' in folder names)."""
    path = tempfile.mkdtemp(prefix="barlake-folders-") + "/landing"
    rows = [("BRAND#7.US", "Date,Open,High,Low,Close,Volume"), ("BRAND#7.US", "2024-01-02,1,2,0.5,1.5,3")]
    spark.createDataFrame(rows, "symbol string, line string").coalesce(1) \
        .write.partitionBy("symbol").text(path)
    good, bad = read_landing(spark, path)
    assert [(r.ticker, r.exchange, r.close) for r in good.collect()] == [("BRAND#7", "US", 1.5)]
    assert bad.count() == 0
