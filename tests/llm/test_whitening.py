"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from barlake.llm import whitening
from barlake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n string, x int"


def expected(vectors, components):
    """Per row: (deviation, whitened up to sign), eigenvalues and their share."""
    x = np.array([[math.floor(64.0 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = ((x * n - s) ** 2).sum(axis=1)
    a = ((x * n - s) / n).astype(np.float64)
    e, v = np.linalg.eigh(a.T @ a / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > e[0] * 1e-12).sum()))
    return deviation, a @ v[:, :k] / np.sqrt(e[:k]), e[:k], e.sum()


def check(rows, vectors, components):
    deviation, white, e, trace = expected(vectors, components)
    k = len(e)
    got = np.array([[r["whitened"] for r in sorted(rows, key=lambda r: (r["vec_id"], r["component"]))]]).reshape(len(vectors), k)
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * sign).max() < 1e-6
    assert {(r["vec_id"], r["deviation"]) for r in rows} == set(enumerate(deviation))
    share = {r["component"]: r["explained"] for r in rows}
    assert np.allclose([share[j + 1] for j in range(k)], e / trace, rtol=1e-9)
    cov = got.T @ got / len(vectors) - got.mean(axis=0)[:, None] * got.mean(axis=0)
    assert {r["n"] for r in rows} == {len(vectors)}
    errors = {r["identity_error"] for r in rows}
    assert len(errors) == 1 and abs(errors.pop() - np.abs(cov - np.eye(k)).max()) < 1e-9


def test_whitening_query(spark, sf_small):
    rows = QUERIES["op12_cholesky_whitening"](spark, sf_small).collect()
    vectors = [r["embedding"] for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").orderBy("vec_id").collect()]
    assert len(rows) == 32 * len(vectors)
    check(rows, vectors, 32)
    assert {r["identity_error"] < 1e-9 for r in rows} == {True}


@pytest.mark.parametrize("small", [1.0, 1e-2])
def test_whitening_of_ill_conditioned_rows(spark, small):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((300, 6)) * [1e4, 1e3, 100, 10, 1, small]
    vectors = [[float(np.float32(c)) for c in v] for v in base @ np.linalg.qr(rng.standard_normal((6, 6)))[0]]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in enumerate(vectors)], SCHEMA).repartition(5)
    check(whitening.whiten(df, 4).collect(), vectors, 4)


def test_whitening_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [4.0, -1.0, 3.0]), (2, [0.5, 7.0, 3.0]), (3, None), (4, [1.0, None, 2.0]),
            (5, [nan, 1.0, 2.0]), (6, [inf, 1.0, 2.0]), (7, []), (8, [1.0, 2.0]), (9, [3.0, 5.0]), (10, [9.0])]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)).collect()
    # Three entries, one of them constant: two components; two rows of two: one; a single row of one: none.
    assert sorted(((r["vec_id"], r["component"]) for r in got), key=str) == sorted(
        [(i, c) for i in (1, 1, None, 2) for c in (1, 2)] + [(8, 1), (9, 1)], key=str)
    assert {r["n"] for r in got if r["vec_id"] in (1, 2, None)} == {4}
    assert sorted(round(r["whitened"], 9) for r in got if r["vec_id"] in (8, 9)) == [-1.0, 1.0]
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_deviation_beyond_a_long_is_null():
    m = np.array([[10**12, 0], [0, 0], [3, 4]], dtype=np.int64)
    sums = [10**12 + 3, 4]
    exact = [sum((3 * int(x) - s) ** 2 for x, s in zip(r, sums)) for r in m]
    assert whitening.deviations(m, 3, sums) == [v if v < 2**63 else None for v in exact]
    assert whitening.deviations(m[2:], 2**40, [2**70, 5]) == [None]
