"""The scores against a plain Katz model over the same documents."""

import functools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barlake.llm import katz
from barlake.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def tokens(text):
    return [*WORD.findall((text or "").encode().lower()), "<end>"]


def plain_scores(rows, folds=5, held=1):
    out = [d is not None and zlib.crc32(str(d).encode()) % folds == held for d, _ in rows]
    docs = [tokens(t) for _, t in rows]
    one, two, ctx = Counter(), defaultdict(Counter), Counter()
    for o, d in zip(out, docs):
        if not o:
            one.update(d)
            for h, w in zip(["<start>", *d], d):
                two[h][w] += 1
                ctx[h] += 1
    n = sum(one.values())

    def spectrum(counts):
        s = [0] * (katz.GT_MAX + 4)
        for c in counts:
            s[min(c, katz.GT_MAX + 2)] += 1
        return s

    d1 = katz.Discount(spectrum(one.values()))
    d2 = katz.Discount(spectrum(c for h in two.values() for c in h.values()))
    kept = sum(float(d1(np.array(c))) for c in one.values())
    unseen = (1 - kept / n) / max(1, sum(c == 1 for c in one.values())) if n else 1.0

    def p1(w):
        return float(d1(np.array(one[w]))) / n if one[w] else unseen

    alpha = {h: (1 - sum(float(d2(np.array(c))) for c in s.values()) / ctx[h]) / (1 - sum(map(p1, s))) for h, s in two.items()}
    res = []
    for (doc, _), o, d in zip(rows, out, docs):
        score = 0.0
        for h, w in zip(["<start>", *d], d):
            if two[h][w] if h in two else 0:
                score += math.log10(float(d2(np.array(two[h][w]))) / ctx[h])
            else:
                score += math.log10(alpha.get(h, 1.0) * p1(w))
        base = sum(math.log10((one[w] + 0.5) / (n + 0.5 * (len(one) + 1))) for w in d)
        res.append((doc, o, len(d), sum(one[w] > 0 for w in d), n, base, score))
    total = {h: sum(float(d2(np.array(c))) for c in s.values()) / ctx[h] + alpha[h] * (1 - sum(map(p1, s))) for h, s in two.items()}
    assert all(abs(t - 1) < 1e-9 for t in total.values())
    return res


def close(got, want):
    got = sorted(map(tuple, got), key=str)
    want = sorted(want, key=str)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9), a[0]


def test_query_against_plain_model(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    close(QUERIES["op10_katz_backoff"](spark, sf_small).collect(), plain_scores(rows))


def test_edge_rows_in_small_blocks(spark, monkeypatch):
    rows = [(1, "a b a b c"), (2, None), (3, ""), (4, "A b\tz  " * 50), (4, "A b\tz  " * 50), (None, "x y"), (7, "é É b"), (8, "q")]
    df = spark.createDataFrame([(d, t, "extra", 1) for d, t in rows], "doc_id long, text string, score string, uid int")
    close(katz.score_documents(df).collect(), plain_scores(rows))


def test_empty_table(spark):
    assert katz.score_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_discounts_leave_something_everywhere():
    for n in ([0] * 11, [0, 5, 0, 0, 0, 0, 0, 0, 0, 0, 5], [0, 900, 300, 150, 90, 60, 43, 32, 25, 400, 9]):
        d = katz.Discount(n)
        c = np.arange(1, 40)
        assert (d(c) > 0).all() and (d(c) < c).all()


def test_packed_arrays_round_trip():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**64, 1000, dtype=np.uint64))
    assert (katz.unpack_keys(katz.pack_keys(keys)) == keys).all()
    assert len(katz.unpack(katz.pack(np.zeros(0)), np.float64)) == 0


def plain_scores_of_order(rows, order, folds=5, held=1):
    """plain_scores' rows by recursion over histories."""
    rows = [(d, zlib.crc32(str(d).encode()) % folds == held if d is not None else False, tokens(t)) for d, t in rows]

    def steps(d):
        return [(tuple(["<start>", *d][max(0, i + 2 - order):i + 1]) if order > 1 else (), w) for i, w in enumerate(d)]

    seen = [defaultdict(Counter) for _ in range(order)]
    for _, o, d in rows:
        if not o:
            for h, w in steps(d):
                for k in range(len(h) + 1):
                    seen[k][h[len(h) - k:]][w] += 1
    one = seen[0][()]
    total = sum(one.values())
    cut = []
    for level in seen:
        s = [0] * (katz.GT_MAX + 4)
        for c in (c for x in level.values() for c in x.values()):
            s[min(c, katz.GT_MAX + 2)] += 1
        cut.append(katz.Discount(s))
    left = 1 - sum(float(cut[0](np.array(c))) for c in one.values()) / total
    unseen = left / max(1, sum(c == 1 for c in one.values()))

    size = [{h: sum(x.values()) for h, x in level.items()} for level in seen]

    @functools.cache
    def known(h, w):
        return float(cut[len(h)](np.array(seen[len(h)][h][w]))) / size[len(h)][h]

    @functools.cache
    def alpha(h):
        words = seen[len(h)][h]
        return (1 - sum(known(h, w) for w in words)) / (1 - sum(p(h[1:], w) for w in words))

    def p(h, w):
        if seen[len(h)].get(h, {}).get(w):
            return known(h, w)
        if not h:
            return unseen
        return (alpha(h) if h in seen[len(h)] else 1.0) * p(h[1:], w)

    return [(i, o, len(d), sum(one[w] > 0 for w in d), total, sum(math.log10((one[w] + 0.5) / (total + 0.5 * (len(one) + 1))) for w in d),
             sum(math.log10(p(h, w)) for h, w in steps(d))) for i, o, d in rows]


def test_trigram_query_against_plain_recursion(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    close(QUERIES["op10_katz_trigram"](spark, sf_small).collect(), plain_scores_of_order(rows, 3))


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_orders_on_edge_rows_in_small_blocks(spark, order):
    rows = [(1, "a b a b c"), (2, None), (3, ""), (4, "A b\tz  " * 50), (4, "A b\tz  " * 50), (None, "x y"), (7, "é É b"), (8, "q"),
            *[(i, f"a b {'a b c'[:i % 5]} z b a {i % 3} b c") for i in range(20, 60)]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    close(katz.score_documents(df, order=order).collect(), plain_scores_of_order(rows, order))


@pytest.mark.parametrize("order, hot_docs", [(2, 0), (2, 3), (3, 1)])
def test_contexts_from_which_many_documents_back_off(spark, order, hot_docs):
    rows = [(i, f"the new{i} word of a b") for i in range(120)] + [(1000 + i, "the a b the b") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    close(katz.score_documents(df, order=order, hot_docs=hot_docs).collect(), plain_scores_of_order(rows, order))


def test_no_group_holds_a_hot_context_s_documents():
    """One block whose documents all back off from one context sends one row
    for them, wherever the context lives."""
    import pyarrow as pa
    texts = ["the new%d" % i for i in range(500)] + ["the old"] * 5
    docs = pa.RecordBatch.from_pydict({"doc_id": range(505), "uid": range(505), "train": [False] * 500 + [True] * 5, "text": texts})
    block = next(katz._block_batches([docs])).to_pylist()[0]
    asked = [r for b in katz._ask_batches(0, 2)([pa.RecordBatch.from_pylist([block])]) for r in b.to_pylist()]
    replies, spectra = [], {}
    for level in (1, 2):
        out = katz._count_group(pa.Table.from_pylist([r for r in asked if r["level"] == level])).to_pylist()
        replies += [r for r in out if r["kind"] == "reply"]
        spectra |= {level: r["spectrum"] for r in out if r["kind"] == "spectrum"}

    class Held:
        value = katz.Totals(spectra, 5, 2)
    sent = [r for b in katz._score_batches(Held, 0, katz.HOT_DOCS)([pa.RecordBatch.from_pylist([{**block, "replies": replies}])]) for r in b.to_pylist()]
    entries = [len(katz.unpack(r["use_uid"], np.int64)) for r in sent if r["keys"] is not None and r["use_uid"]]
    assert max(entries) <= katz.HOT_DOCS and [len(katz.unpack(r["use_uid"], np.int64)) for r in sent if r["hot_key"]] == [500]
