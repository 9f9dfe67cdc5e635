"""Exact averages against rational arithmetic."""

import datetime as dt
import math
import random
from fractions import Fraction

import pytest

from barlake.operators.exact import compute_metrics_exact, compute_metrics_exact_long, grid_of
from barlake.operators.metrics import compute_metrics

DAY = dt.date(2024, 1, 1)


def frame(spark, series):
    rows = [(k, DAY + dt.timedelta(days=i), v) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "ticker string, date date, close double").repartition(3)


def expected(values, n):
    """(mean as an exact fraction, None or a special; above) per row."""
    out = []
    for i, v in enumerate(values):
        some = [x for x in values[max(0, i - n):i + 1] if x is not None]
        odd = [x for x in some if not math.isfinite(x)]
        if odd:
            mean = odd[0] if len(set(odd)) == 1 and odd[0] == odd[0] else math.nan
            flag = v is not None and (v != v or (mean == mean and v >= mean))
        else:
            mean = sum(map(Fraction, some)) / len(some) if some else None
            flag = v is not None and mean is not None and Fraction(v) >= mean
        out.append((mean, 1 if flag else -1))
    return out


def check(spark, series, n):
    df = frame(spark, series)
    got = {}
    for r in compute_metrics_exact(df, [("sma_crossover", n)]).collect():
        got.setdefault(r["ticker"], {})[(r["date"] - DAY).days] = (r[f"close_sma_{n}"], r[f"close_sma_{n}_co"])
    for k, values in series.items():
        flags = None
        for i, (mean, above) in enumerate(expected(values, n)):
            sma, co = got[k][i]
            if mean is None:
                assert sma is None
            elif isinstance(mean, float):
                assert sma == mean or sma != sma and mean != mean
            else:
                assert abs(Fraction(sma) - mean) <= Fraction(math.ulp(float(mean))), (k, i)
                if Fraction(float(mean)) == mean:
                    assert sma == float(mean)
            assert co == (above if flags is not None and flags != above else 0), (k, i)
            flags = above


def test_a_constant_never_crosses(spark):
    df = frame(spark, {"a": [0.1] * 60, "b": [1e17 + 16] * 60})
    exact = compute_metrics_exact(df, [("sma_crossover", 20)]).collect()
    assert {(r["close_sma_20"] == r["close"], r["close_sma_20_co"]) for r in exact} == {(True, 0)}
    plain = compute_metrics(df, [("sma_crossover", 20)]).collect()
    assert any(r["close_sma_20_co"] for r in plain), "a plain frame of doubles does cross"


@pytest.mark.parametrize("low, high", [(0, 20), (-60, 60), (-1074, -1000), (900, 1023), (-1074, 1023)])
def test_any_doubles(spark, low, high):
    rng = random.Random(low * 31 + high)

    def value():
        if rng.random() < 0.1:
            return rng.choice([0.0, -0.0, None])
        return math.ldexp(rng.choice([-1, 1]) * (1 + rng.random()), rng.randint(low, high - 1))
    check(spark, {k: [value() for _ in range(40)] for k in "abc"}, 7)


def test_ties_and_cancelled_sums(spark):
    check(spark, {"a": [1e300, 1.0, -1e300, 1.0, 5e-324, 0.0, 0.0, 0.0], "b": [0.1, 0.2, 0.3, 0.2, 0.2, 0.2, 0.2], "c": [3.0, 1.0, 2.0, 2.0, 2.0, 2.0]}, 2)


def test_nulls_and_non_finite_values(spark):
    nan, inf = math.nan, math.inf
    check(spark, {"a": [1.0, nan, 2.0, 3.0, 4.0, 5.0], "b": [1.0, inf, 2.0, -inf, 4.0, 5.0, 6.0, 7.0], "c": [None, None, 1.0, None, 1.0],
                  "d": [-inf, 1.0, 1.0, 1.0, 1.0], "e": [None] * 4}, 2)


def test_change_columns_and_plan(spark):
    df = frame(spark, {"a": [float(i * i % 17 + 1) for i in range(50)], "b": [2.5] * 5})
    rules = [("eod_change", 5), ("sma_crossover", 3), ("sma_crossover", 9)]
    exact, plain = compute_metrics_exact(df, rules), compute_metrics(df, rules)
    assert exact.columns == plain.columns
    rnd = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert rnd(exact.collect()) == rnd(plain.collect())
    plan = compute_metrics_exact(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and plan.count("Sort [") == 1
    assert grid_of(df, "close").limbs <= 4
    assert compute_metrics_exact(df.limit(0), rules).collect() == []


def test_long_series_in_blocks(spark):
    rng = random.Random(1)
    df = frame(spark, {"a": [round(rng.uniform(1, 50), 2) for _ in range(400)], "b": [0.1] * 90})
    rules = [("eod_change", 5), ("sma_crossover", 12)]
    got = compute_metrics_exact_long(df, rules, block_rows=64)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, compute_metrics_exact(df, rules).select(got.columns).collect()))
