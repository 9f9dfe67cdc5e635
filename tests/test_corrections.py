"""Corrections recompute the rows they reach, and give a full run's table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barlake.operators.corrections import apply_corrections, corrected_metrics
from barlake.operators.metrics import compute_metrics
from barlake.operators.refine import refine_prices
from barlake.schema import BARS_SCHEMA, MEASURES

RULES = [("eod_change", 5), ("sma_crossover", 3), ("sma_crossover", 6)]
DAY = dt.date(2024, 1, 1)


def _frame(spark, rows):
    return spark.createDataFrame(rows, BARS_SCHEMA)


def _full(raw):
    return compute_metrics(refine_prices(raw), RULES)


def _rows(df):
    return sorted(tuple("nan" if isinstance(v, float) and v != v else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def _check(spark, before, after):
    """Metrics after replacing/adding rows, next to a full run; rows recomputed."""
    old, new = ({(r[0], r[1]): r for r in rows} for rows in (before, after))
    changed = [k for k, r in new.items() if repr(old.get(k)) != repr(r)]
    stored = _full(_frame(spark, before)).checkpoint()
    changes = spark.createDataFrame(changed, "ticker string, date date") if changed else stored.select("ticker", "date").limit(0)
    rows, gone = corrected_metrics(stored, _frame(spark, after), changes, RULES)
    assert _rows(apply_corrections(stored, rows, gone)) == _rows(_full(_frame(spark, after)))
    return rows.count()


def _bars(ticker, n, rng=None):
    def value(m, i):
        if rng and rng.random() < 0.25:
            return None if rng.random() < 0.6 else (0 if m == "volume" else -1.0)
        return 100 + i if m == "volume" else float(10 + (i * 7) % 5)
    return [(ticker, DAY + dt.timedelta(days=i), *[value(m, i) for m in MEASURES]) for i in range(n)]


def test_a_whole_row_reaches_its_look_back_only(spark):
    before = _bars("A", 100) + _bars("B", 100)
    after = [r if (r[0], r[1]) != ("A", DAY + dt.timedelta(days=40)) else (*r[:5], 99.0, r[6]) for r in before]
    assert _check(spark, before, after) == 1 + 7
    two = [r if r[0] != "A" or (r[1] - DAY).days not in (10, 40) else (*r[:5], 99.0, r[6]) for r in before]
    assert _check(spark, before, two) == 2 * (1 + 7)
    assert _check(spark, before, before) == 0


def test_a_gap_reaches_to_the_next_own_value(spark):
    before = [(*r[:5], None, r[6]) if 41 <= (r[1] - DAY).days < 50 else r for r in _bars("A", 100)]
    after = [(*r[:5], 99.0, r[6]) if (r[1] - DAY).days == 40 else r for r in before]
    assert _check(spark, before, after) == 10 + 7
    holes = [(*r[:5], None, r[6]) if (r[1] - DAY).days == 40 else r for r in before]
    assert _check(spark, before, holes) == 10 + 7


def test_rows_that_appear_and_go(spark):
    before = [("A", d, None, *r) for _, d, _, *r in _bars("A", 5)] + _bars("A", 30)[5:] + _bars("B", 4)
    first = [("A", DAY, 5.0, *before[0][3:]), *before[1:]]
    assert _check(spark, before, first) >= 5
    assert _check(spark, first, before) >= 7
    late = [r for r in _bars("A", 30) if (r[1] - DAY).days not in (3, 9)]
    assert _check(spark, late, _bars("A", 30) + _bars("C", 3)) == 2 * (1 + 7) - 2 + 3
    nan = [(*r[:5], float("nan"), r[6]) if (r[1] - DAY).days == 8 else r for r in _bars("A", 30)]
    assert _check(spark, _bars("A", 30), nan) == 7
    assert _check(spark, nan, _bars("A", 30)) == 8


@pytest.mark.parametrize("seed", range(3))
def test_any_corrections(spark, seed):
    rng = random.Random(seed)
    before = [r for t in "ABC" for r in _bars(t, 60, rng) if rng.random() < 0.9]
    other = {(r[0], r[1]): r for t in "ABC" for r in _bars(t, 60, rng)}
    after = {(r[0], r[1]): r for r in before} | {k: other[k] for k in rng.sample(sorted(other), 9)}
    _check(spark, before, list(after.values()))
