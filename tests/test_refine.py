"""P1-P3 and W1 on literal frames (FIXTURES.md F7) and properties."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from barlake.operators import refine as R
from barlake.operators import segmented as SG

SCHEMA = "ticker string, date date, close double"


def d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def rows(df, cols=("ticker", "date", "close")):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_literal_edge_frame(spark):
    data = [("A", d(1), 1.0), ("A", d(2), -2.0), ("A", d(3), 0.0), ("A", d(4), float("nan")),
            ("A", d(5), None), ("A", d(6), 6.0), ("B", d(1), None), ("B", d(2), 3.0)]
    df = spark.createDataFrame(data, SCHEMA)
    out = R.refine_prices(df, ["close"])
    assert rows(out) == [("A", d(1), 1.0), ("A", d(2), 1.0), ("A", d(3), 1.0),
                         ("A", d(6), 6.0), ("B", d(2), 3.0)]


def test_null_nonpositive_keeps_nan_and_nulls_zero(spark):
    df = spark.createDataFrame([("A", d(1), 0.0), ("A", d(2), float("nan")), ("A", d(3), -1.0),
                                ("A", d(4), None), ("A", d(5), 2.5)], SCHEMA)
    got = [r.close for r in R.null_nonpositive(df, ["close"]).orderBy("date").collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2] is None and got[3] is None
    assert got[4] == 2.5


def test_forward_fill_carries_nan_and_leading_nulls_stay(spark):
    df = spark.createDataFrame([("A", d(1), None), ("A", d(2), float("nan")), ("A", d(3), None),
                                ("A", d(4), 4.0), ("A", d(5), None)], SCHEMA)
    got = [r.close for r in R.forward_fill(df, ["close"]).orderBy("date").collect()]
    assert got[0] is None and math.isnan(got[1]) and math.isnan(got[2])
    assert got[3] == 4.0 and got[4] == 4.0


def test_refine_is_one_window_node(spark):
    df = spark.createDataFrame([("A", d(1), 1.0)], SCHEMA)
    plan = R.refine_prices(df, ["close"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1 or plan.count("Window") == 1


values = st.lists(st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 0.5, 1.0, 2.0, 3.25])),
                  min_size=1, max_size=25)


@settings(max_examples=15, deadline=None)
@given(a=values, b=values)
def test_fill_idempotent_and_segmented_equal(spark, a, b):
    data = [("A", d(i), v) for i, v in enumerate(a)] + [("B", d(2 * i), v) for i, v in enumerate(b)]
    df = spark.createDataFrame(data, SCHEMA)
    once = R.forward_fill(df, ["close"])
    twice = R.forward_fill(once, ["close"])
    assert rows(once) == rows(twice)
    seg = SG.forward_fill_long(df, ["close"], block_rows=6)
    assert rows(seg) == rows(once)
    assert rows(SG.refine_prices_long(df, ["close"], block_rows=4)) == \
        rows(R.refine_prices(df, ["close"]))


def test_a_value_without_a_date_carries_into_the_next_segment(spark):
    rows = [(k, None if d == 0 else dt.date(2020, 1, d), v) for k, vs in (("a", [5.0, None, None, 7.0, None]), ("b", [None, None, 2.0])) for d, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double")
    for block in (2, 4, 100):
        got = sorted(map(str, SG.forward_fill_long(df, ["close"], block_rows=block).collect()))
        assert got == sorted(map(str, R.forward_fill(df, ["close"]).collect()))
