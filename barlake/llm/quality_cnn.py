"""Quality score by a byte-level convolutional network in numpy.

A document's UTF-8 bytes, all of them, are read in chunks of ``CHUNK``
positions that overlap by a filter width less one, so every stretch of
``WIDTH`` bytes meets every filter once.  A byte enters as one of 512 symbols:
its value, and whether the eight bytes from it on repeat the bytes some
2 to ``LAGS`` places before (text that repeats itself is otherwise invisible
to short filters).  Symbols have learned embeddings; each chunk is max-pooled
per filter, the chunks' maxima are pooled to their maximum and mean, and a
logistic unit combines the two.

The network is fitted by Adam on at most ``SAMPLE`` labelled documents a
class, drawn by a hash of their id from all labelled rows of the training
folds.  That bound is the only one: fitting and scoring read whole texts.

Edge cases: null and empty texts have no chunk and score the unit's offset;
labels that are null or contradict each other for an id are not learned; with
no or one class of labels every score is the share of label 1 (0.5 without
labels); repeated rows are scored each for itself; an empty table gives no
rows; other columns are ignored, and kept by ``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 4096
WIDTH = 8
FILTERS = 16
EMBED = 8
LAGS = 32
PAD = 512
SAMPLE = 800
EPOCHS = 12
#: Small samples are gone through more often, up to so many steps in all.
STEPS = 800
BATCH = 32
THRESHOLD = 0.7


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def symbols(data: bytes) -> np.ndarray:
    """Byte values, plus 256 where the next eight bytes repeat earlier ones."""
    n = len(data)
    out = np.frombuffer(data, dtype=np.uint8).astype(np.int16)
    if n > 9:
        eight = np.ndarray((n - 7,), dtype="<u8", buffer=data, strides=(1,)).copy()
        again = np.zeros(n - 7, dtype=bool)
        for lag in range(2, min(LAGS, n - 8) + 1):
            again[lag:] |= eight[lag:] == eight[:-lag]
        out[:n - 7][again] += 256
    return out


def chunks(data: bytes) -> list[np.ndarray]:
    """Symbol chunks with the overlap (or padding) the filters need."""
    out = []
    for s in range(0, len(data), CHUNK):
        # With LAGS bytes before and 7 after it, a chunk's symbols are those
        # it has in the whole text.
        before = min(s, LAGS)
        got = symbols(data[s - before:s + CHUNK + WIDTH + 6])[before:before + CHUNK + WIDTH - 1]
        size = min(CHUNK, len(data) - s)
        out.append(np.concatenate([got, np.full(max(0, size + WIDTH - 1 - len(got)), PAD, dtype=np.int16)])[:size + WIDTH - 1])
    return out


def convolve(table: np.ndarray, sym: np.ndarray) -> np.ndarray:
    """Filter responses [positions, filters]; ``table`` [width, symbol, filter]."""
    n = len(sym) - WIDTH + 1
    z = table[0][sym[:n]]
    for j in range(1, WIDTH):
        z += table[j][sym[j:n + j]]
    return z


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {"E": rng.normal(0, 0.5, (PAD + 1, EMBED)), "W": rng.normal(0, 0.25, (WIDTH, EMBED, FILTERS)),
                  "b": np.zeros(FILTERS), "v": rng.normal(0, 0.1, 2 * FILTERS), "c": np.zeros(1)}
        self.constant: float | None = None

    def table(self) -> np.ndarray:
        e = self.p["E"].copy()
        e[PAD] = 0
        return np.einsum("se,jef->jsf", e, self.p["W"]).astype(np.float32)

    def fit(self, docs: list[list[np.ndarray]], labels: np.ndarray) -> "Network":
        share = float(labels.mean()) if len(labels) else 0.5
        if share in (0.0, 1.0) or not len(labels):
            self.constant = share
            return self
        rng = np.random.default_rng(11)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        t = 0
        epochs = max(EPOCHS, -(-STEPS * BATCH // len(docs)))
        for epoch in range(epochs):
            rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for batch in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // BATCH)):
                t += 1
                for k, g in self._gradients([docs[i] for i in batch], labels[batch], weight[batch]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** t) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8) + 1e-4 * self.p[k])
        return self

    def _gradients(self, docs, labels, weight) -> dict:
        table, p = self.table(), self.p
        g = {k: np.zeros_like(x) for k, x in p.items()}
        syms, grads = [], []
        for doc, y, w in zip(docs, labels, weight):
            if not doc:
                prob = 1 / (1 + np.exp(-p["c"][0]))
                g["c"] += w * (prob - y)
                continue
            tops = np.empty((len(doc), FILTERS))
            at = np.empty((len(doc), FILTERS), dtype=np.int64)
            for i, s in enumerate(doc):
                z = convolve(table, s)
                at[i] = z.argmax(axis=0)
                tops[i] = z[at[i], np.arange(FILTERS)]
            act = np.maximum(tops + p["b"], 0)
            feats = np.concatenate([act.max(axis=0), act.mean(axis=0)])
            d = w * (1 / (1 + np.exp(-(feats @ p["v"] + p["c"][0]))) - y)
            g["c"] += d
            g["v"] += d * feats
            top = np.zeros_like(act)
            top[act.argmax(axis=0), np.arange(FILTERS)] = p["v"][:FILTERS]
            ga = d * (top + p["v"][FILTERS:] / len(doc)) * (act > 0)
            g["b"] += ga.sum(axis=0)
            for i, s in enumerate(doc):
                syms.append(s[at[i][:, None] + np.arange(WIDTH)])
                grads.append(ga[i])
        if syms:
            s, a = np.stack(syms), np.stack(grads)  # [m, filter, width], [m, filter]
            g["W"] += np.einsum("mf,mfje->jef", a, p["E"][s] * (s != PAD)[..., None])
            np.add.at(g["E"], s, np.einsum("mf,jef->mfje", a, p["W"]))
            g["E"][PAD] = 0
        return {k: x / len(docs) for k, x in g.items()}

    def scorer(self) -> "Scorer":
        return Scorer(self.table(), self.p["b"], self.p["v"], float(self.p["c"][0]), self.constant)


class Scorer:
    """What executors need to score whole texts."""

    def __init__(self, table, b, v, c, constant):
        self.table_, self.b, self.v, self.c, self.constant = table, b, v, c, constant

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        total, top, n = np.zeros(FILTERS), np.zeros(FILTERS), 0
        data = (text or "").encode("utf-8", "surrogatepass")
        # One chunk at a time: memory does not grow with the text.
        for s in range(0, len(data), CHUNK):
            before = min(s, LAGS)
            part = symbols(data[s - before:s + CHUNK + WIDTH + 6])[before:before + CHUNK + WIDTH - 1]
            size = min(CHUNK, len(data) - s)
            if len(part) < size + WIDTH - 1:
                part = np.concatenate([part, np.full(size + WIDTH - 1 - len(part), PAD, dtype=np.int16)])
            act = np.maximum(convolve(self.table_, part).max(axis=0) + self.b, 0)
            total += act
            top = np.maximum(top, act)
            n += 1
        feats = np.concatenate([top, total / max(n, 1)])
        return float(1 / (1 + np.exp(-np.clip(feats @ self.v + self.c, -500, 500))))


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, sample: int = SAMPLE) -> list:
    """(doc_id, data, quality) of at most ``sample`` documents a class;
    ``train`` is a condition on the labels' doc_id.  Ids come first, so texts
    of other documents never move."""
    clean = (labels.where(train & F.col("quality").isin(0, 1)).groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most"))
    ids = None
    for c in (0, 1):
        some = clean.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "quality")
        ids = some if ids is None else ids.unionByName(some)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").mapInArrow(
        _whole, "doc_id long, data array<binary>, quality int")
    return sorted(rows.dropDuplicates(["doc_id"]).collect(), key=lambda r: r["doc_id"])


def _whole(batches):
    for b in batches:
        data = [[c.tobytes() for c in chunks((t or "").encode("utf-8", "surrogatepass"))]
                for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(data, pa.list_(pa.binary())),
                                          b.column("quality").cast(pa.int32())], ["doc_id", "data", "quality"])


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, sample: int = SAMPLE) -> Scorer:
    rows = labelled_sample(docs, labels, train, sample)
    parts = [[np.frombuffer(c, dtype=np.int16) for c in r["data"]] for r in rows]
    return Network().fit(parts, np.array([r["quality"] for r in rows], dtype=float)).scorer()


def quality_score(scorer: Scorer, docs: DataFrame, text: str = "text") -> Column:
    """Column expression: the score of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def score(t: pd.Series) -> pd.Series:
        model = held.value
        return t.map(model.score)

    return score(F.coalesce(F.col(text), F.lit("")))


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, learned from
    the folds other than ``held``."""
    scorer = fit_quality(docs, labels, fold(F.col("doc_id"), folds) != held)
    out = docs.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
                      quality_score(scorer, docs).alias("score"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """The rows of ``docs`` whose text is predicted good, all columns kept."""
    scorer = fit_quality(docs, labels, fold(F.col("doc_id"), folds) != held)
    return docs.where(quality_score(scorer, docs) >= THRESHOLD)
