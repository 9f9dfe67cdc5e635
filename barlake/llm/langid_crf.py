"""Language identification with a linear-chain conditional random field.

Each word of a text is a position of the chain and gets a language; a text may
change language at any word.  A word's features are its identity (the
lexicon), its prefixes and suffixes of up to three bytes, and its byte
bigrams and trigrams with the word's ends marked, all hashed into one weight
table.  Feature and transition weights are fitted together by the exact
gradient of the chain's likelihood (forward-backward), on sequences spliced
from stretches of sampled documents so that the model sees switches.

A document's language is the one with the largest mean marginal over all its
words, and that mean is the score.  Forward-backward runs over all words of a
batch of documents at once: products of transition matrices within blocks,
then vectors from block to block.

At most ``SAMPLE`` documents a language are learned from, drawn by a hash of
their id from all training rows; prediction reads whole texts.  Texts of more
than ``STRETCH`` words are decoded in stretches of that many words.

Edge cases: text that is null or has no letter is ``und`` with score 0; rows
without language are not learned from; without any learned language every
text with a letter is ``und``; repeated rows are judged each for itself; ties
go to the first language by name; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_BITS = 16
SAMPLE = 500
SEQUENCE = 96
STEPS = 300
BATCH = 24
BLOCK = 32
STRETCH = 1 << 18
BATCH_WORDS = 1 << 18

_WORD = re.compile(rb"[a-z\x80-\xff]+")
_MAYBE = re.compile(r"[^\W\d_]")


def words_of(text: str | None) -> list[bytes]:
    """Words of letters (any byte beyond ASCII counts), in lower case; none in
    a text without a letter (number characters such as a half are none)."""
    if not text or not any(m[0].isalpha() for m in _MAYBE.finditer(text)):
        return []
    return _WORD.findall(text.lower().encode("utf-8", "surrogatepass"))


def _slot(code: np.ndarray, kind: int) -> np.ndarray:
    h = (code.astype(np.uint64) * np.uint64(8) + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def features(words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Feature slots of every word, by kind: (slots, first slot of each word),
    or (slots, None) where a word has one."""
    data = np.frombuffer(b" " + b" ".join(words) + b"    ", dtype=np.uint8).astype(np.uint64)
    size = len(data) - 4
    gap = data[:size + 1] == 32
    first = np.flatnonzero(gap)[:len(words)] + 1
    last = np.flatnonzero(gap)[1:len(words) + 1] - 1
    a, b, c, d = data[:size], data[1:size + 1], data[2:size + 2], data[3:size + 3]
    two = a << np.uint64(8) | b
    three = two << np.uint64(8) | c
    # A bigram or trigram belongs to the word its first byte is in, the blank
    # before a word counting as its first byte.
    tri = np.flatnonzero(b != 32)
    ends = np.array([first - 1, np.maximum(last - 2, first)])
    four = three[ends] << np.uint64(8) | d[ends]
    # The word itself: a polynomial of its bytes.
    lengths = last - first + 1
    power = np.cumprod(np.concatenate([[1], np.full(int(lengths.max()) + 1, 1099511628211)]).astype(np.uint64))
    inside = np.arange(size) - np.repeat(first - 1, lengths + 1)
    whole = np.add.reduceat((a + np.uint64(1)) * power[inside], first - 1)
    return [(_slot(two, 0), first - 1), (_slot(three[tri], 1), np.searchsorted(tri, first - 1)),
            (_slot(four[0], 2), None), (_slot(four[1], 3), None), (_slot(whole, 4), None)]


def _by_word(table: np.ndarray, feats) -> np.ndarray:
    """Sum of the table's rows over each word's features."""
    out = 0
    for slots, firsts in feats:
        out = out + (table[slots] if firsts is None else np.add.reduceat(table[slots], firsts, axis=0))
    return out


class Chain:
    """Weights of the field and inference over many documents at once."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        self.weights = np.zeros((1 << TABLE_BITS, len(labels)), dtype=np.float64)
        self.moves = np.eye(len(labels)) * 2.0

    def emissions(self, words: list[bytes]) -> np.ndarray:
        known: dict[bytes, int] = {}
        number = [known.setdefault(w, len(known)) for w in words]
        return _by_word(self.weights, features(list(known)))[np.array(number)]

    def marginals(self, em: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Marginals [words, labels] of chains given by their first word and
        number of words (all positive)."""
        k, blocks = len(self.labels), -(-lengths // BLOCK)
        base = np.cumsum(blocks) - blocks
        of = np.repeat(np.arange(len(lengths)), lengths)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        row, col = base[of] + inside // BLOCK, inside % BLOCK
        total = int(blocks.sum())
        p = np.ones((BLOCK, total, k))
        real = np.zeros((BLOCK, total), dtype=bool)
        e = em[np.repeat(starts, lengths) + inside]
        p[col, row] = np.exp(e - e.max(axis=1, keepdims=True))
        real[col, row] = True
        whole = real.all(axis=1)
        move = np.exp(self.moves - self.moves.max())
        # Product of each block's steps; a chain's first step has no move.
        prod = np.broadcast_to(np.eye(k), (total, k, k)).copy()
        head = np.zeros(total, dtype=bool)
        head[base] = True
        for t in range(BLOCK):
            went = (prod.reshape(-1, k) @ move).reshape(total, k, k)
            if t == 0:
                went[head] = 1.0
            went *= p[t][:, None, :]
            if t % 4 == 3:
                went /= went.max(axis=(1, 2), keepdims=True)
            if whole[t]:
                prod = went
            else:
                np.copyto(prod, went, where=real[t][:, None, None])
        prod /= prod.max(axis=(1, 2), keepdims=True)
        # Vectors into and out of each block, chain by chain in step.
        into, out = np.full((total, k), 1.0 / k), np.ones((total, k))
        order = np.argsort(-blocks, kind="stable")
        live = blocks[order]
        for j in range(1, int(blocks.max())):
            some = order[:np.searchsorted(-live, -j)]
            v = np.einsum("bi,bij->bj", into[base[some] + j - 1], prod[base[some] + j - 1])
            into[base[some] + j] = v / v.sum(axis=1, keepdims=True)
        for j in range(int(blocks.max()) - 2, -1, -1):
            some = order[:np.searchsorted(-live, -(j + 1))]
            v = np.einsum("bij,bj->bi", prod[base[some] + j + 1], out[base[some] + j + 1])
            out[base[some] + j] = v / v.sum(axis=1, keepdims=True)
        # Forward and backward within blocks.
        alpha, now = np.empty_like(p), into
        for t in range(BLOCK):
            went = now @ move
            if t == 0:
                went[head] = 1.0
            went *= p[t]
            went /= went.sum(axis=1, keepdims=True)
            now = went if whole[t] else np.where(real[t][:, None], went, now)
            alpha[t] = now
        both, now = np.empty_like(p), out
        for t in range(BLOCK - 1, -1, -1):
            both[t] = alpha[t] * now
            back = (p[t] * now) @ move.T
            back /= back.sum(axis=1, keepdims=True)
            now = back if whole[t] else np.where(real[t][:, None], back, now)
        got = both[col, row]
        return got / got.sum(axis=1, keepdims=True)

    def label(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each whole text."""
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.labels:
            return out
        held: list[tuple[int, list[bytes]]] = []
        size = 0
        for i, t in enumerate(texts):
            w = words_of(t)
            if not w:
                continue
            held.append((i, w))
            size += len(w)
            if size >= BATCH_WORDS:
                self._label(held, out)
                held, size = [], 0
        if held:
            self._label(held, out)
        return out

    def _label(self, held, out) -> None:
        sums: dict[int, np.ndarray] = {}
        pieces = [(i, w[at:at + STRETCH]) for i, w in held for at in range(0, len(w), STRETCH)]
        while pieces:
            some, size = [], 0
            while pieces and (not some or size + len(pieces[0][1]) <= 2 * BATCH_WORDS):
                some.append(pieces.pop(0))
                size += len(some[-1][1])
            lengths = np.array([len(w) for _, w in some], dtype=np.int64)
            starts = np.cumsum(lengths) - lengths
            got = self.marginals(self.emissions([x for _, w in some for x in w]), starts, lengths)
            for (i, _), s in zip(some, np.add.reduceat(got, starts, axis=0)):
                sums[i] = sums.get(i, 0) + s
        for i, s in sums.items():
            best = int(np.argmax(s))
            out[i] = (self.labels[best], float(s[best] / s.sum()))

    def fit(self, windows: list[tuple[int, list[bytes]]], seed: int = 5) -> "Chain":
        """Fit on stretches of words with their label number."""
        if len(self.labels) < 2 or not windows:
            return self
        rng = np.random.default_rng(seed)
        by_label = [[w for y, w in windows if y == i and w] for i in range(len(self.labels))]
        usable = [i for i, some in enumerate(by_label) if some]
        k = len(self.labels)
        m, v = np.zeros_like(self.weights), np.zeros_like(self.weights)
        mt, vt = np.zeros_like(self.moves), np.zeros_like(self.moves)
        lengths = np.full(BATCH, SEQUENCE, dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        for step in range(1, STEPS + 1):
            words, truth = [], []
            for _ in range(BATCH):
                seq: list[bytes] = []
                while len(seq) < SEQUENCE:
                    y = usable[rng.integers(len(usable))]
                    some = by_label[y][rng.integers(len(by_label[y]))]
                    at = rng.integers(len(some))
                    cut = some[at:at + int(rng.integers(3, SEQUENCE))][:SEQUENCE - len(seq)]
                    seq += cut
                    truth += [y] * len(cut)
                words += seq
            y = np.array(truth)
            feats = features(words)
            em = _by_word(self.weights, feats)
            got, pairs = self._expected(em.reshape(BATCH, SEQUENCE, k))
            g = got.reshape(-1, k)
            g[np.arange(len(y)), y] -= 1
            seen = np.zeros((k, k))
            yy = y.reshape(BATCH, SEQUENCE)
            np.add.at(seen, (yy[:, :-1], yy[:, 1:]), 1)
            grad = np.zeros_like(self.weights)
            for slots, firsts in feats:
                part = g if firsts is None else np.repeat(g, np.diff(np.append(firsts, len(slots))), axis=0)
                for c in range(k):
                    grad[:, c] += np.bincount(slots, weights=part[:, c], minlength=len(grad))
            grad /= len(y)
            gt = (pairs - seen) / len(y) + 1e-3 * self.moves
            rate = 0.05 * (1 - step / (STEPS + 1))
            for x, gx, mx, vx in ((self.weights, grad, m, v), (self.moves, gt, mt, vt)):
                mx += 0.1 * (gx - mx)
                vx += 0.01 * (gx * gx - vx)
                x -= rate * (mx / (1 - 0.9 ** step)) / (np.sqrt(vx / (1 - 0.99 ** step)) + 1e-8)
        return self

    def _expected(self, em: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals and expected transition counts of equally long chains."""
        b, n, k = em.shape
        p = np.exp(em - em.max(axis=2, keepdims=True))
        move = np.exp(self.moves - self.moves.max())
        alpha, beta = np.empty_like(p), np.ones_like(p)
        alpha[:, 0] = p[:, 0] / p[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, n):
            x = (alpha[:, t - 1] @ move) * p[:, t]
            alpha[:, t] = x / x.sum(axis=1, keepdims=True)
        for t in range(n - 2, -1, -1):
            x = (p[:, t + 1] * beta[:, t + 1]) @ move.T
            beta[:, t] = x / x.sum(axis=1, keepdims=True)
        got = alpha * beta
        got /= got.sum(axis=2, keepdims=True)
        pair = alpha[:, :-1, :, None] * move * (p[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        return got, pair.sum(axis=(0, 1))


def _word_batches(batches):
    for b in batches:
        rows = [b" ".join(words_of(t)) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("lang"), pa.array(rows, pa.binary())],
                                         ["doc_id", "lang", "words"])


def fit_language(docs: DataFrame, train: Column, sample: int = SAMPLE) -> Chain:
    """The field learned from ``docs`` where ``train`` holds and ``lang`` is set."""
    known = docs.where(train & F.col("lang").isNotNull()).select("doc_id", "lang").distinct()
    labels = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    ids = None
    for lang in labels:
        some = known.where(F.col("lang") == lang).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        ids = some if ids is None else ids.unionByName(some)
    chain = Chain(labels)
    if ids is None:
        return chain
    # Of rows that repeat an id, one is learned; one without words if no other has some.
    rows = (docs.select("doc_id", "text", "lang").join(F.broadcast(ids), ["doc_id", "lang"])
            .mapInArrow(_word_batches, "doc_id long, lang string, words binary")
            .groupBy("doc_id", "lang").agg(F.max("words").alias("words")).collect())
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["lang"]))
    number = {x: i for i, x in enumerate(labels)}
    return chain.fit([(number[r["lang"]], bytes(r["words"]).split()) for r in rows])


def identify(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text."""
    held = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        model = held.value
        for b in batches:
            got = model.label(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x for x, _ in got], pa.string()),
                                              pa.array([x for _, x in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    typ = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {typ}, lang_pred string, score double")


def word_labels(chain: Chain, text: str) -> list[tuple[str, str, float]]:
    """(word, language, marginal) of each word of one text."""
    w = words_of(text)
    if not w or not chain.labels:
        return []
    got = chain.marginals(chain.emissions(w), np.array([0]), np.array([len(w)]))
    return [(x.decode("utf-8", "replace"), chain.labels[int(i)], float(g[i])) for x, g, i in zip(w, got, got.argmax(axis=1))]


def predict_languages(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from
    the folds other than ``held``."""
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    chain = fit_language(docs, part != held)
    return identify(docs, chain).select("doc_id", F.coalesce(part == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
