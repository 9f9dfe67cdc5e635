"""Benchmark decontamination with suffix arrays over the training words.

Each shard of training documents (at most ``SHARD_WORDS`` words) gets a suffix
array over its words, in the order of the benchmark's word numbers.  Every
benchmark suffix is looked up in it by binary search; what starts with the
suffix's first 13 words (or the whole item, when it has fewer) is an
occurrence, and neighbouring occurrences on one diagonal join to the longest
verbatim match with its place in document and item.

A suffix that leaves the benchmark's vocabulary before the shortest window
ends cannot match, so such suffixes are not entered; this changes no result.

The benchmark is taken in blocks of at most about ``BLOCK_WORDS`` words, each
sent to the executors on its own; an item stays in one block, however long,
so no match is cut.  A benchmark of one block, the usual case, needs no
shuffle.  ``verbatim_matches`` gives the matches themselves.

Edge cases: null or empty text has no words (0 counts, not contaminated);
items without words have no windows; repeated items count once; an item
without an id is listed as the empty string; repeated documents are judged
each for itself; empty tables give no rows or no hits; other columns are
ignored, and kept by ``remove_contaminated``.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.storage import materialise, spare

WINDOW = 13
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 500_000
STRETCH_WORDS = 10_000
#: A document is contaminated when hit words are at least one in so many.
SHARE = 20

# Fixed pattern: words, on UTF-8 bytes after lower-casing A-Z.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_STATE = "n_words long, hits array<struct<start:long,end:long>>, items array<string>, longest long"


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def _stretch_batches(batches):
    """Items as stretches of words that overlap by a window less one."""
    for b in batches:
        rows = []
        for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
            w = words_of(text)
            for at in range(0, max(len(w) - WINDOW + 1, min(len(w), 1)), STRETCH_WORDS):
                cut = w[at:at + STRETCH_WORDS + WINDOW - 1]
                rows.append({"item": item, "start": at, "n": len(cut), "words": b" ".join(cut)})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("item", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("words", pa.binary())]))


class TestBlock:
    """Word numbers, suffixes and distinct windows of one benchmark block."""

    __test__ = False

    def __init__(self, stretches: list):
        self.vocab: dict[bytes, int] = {}
        self.names = sorted({s["item"] for s in stretches})
        name_no = {n: i for i, n in enumerate(self.names)}
        flat, item, place = [0], [0], [0]
        starts, lengths = [], []
        for s in stretches:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in bytes(s["words"]).split(b" ")]
            width = min(WINDOW, len(ids))
            starts += range(len(flat), len(flat) + len(ids) - width + 1)
            lengths += [width] * (len(ids) - width + 1)
            flat += [*ids, 0]
            item += [name_no[s["item"]]] * (len(ids) + 1)
            place += range(s["start"], s["start"] + len(ids) + 1)
        self.item, self.place = np.array(item, dtype=np.int32), np.array(place, dtype=np.int64)
        self.start, self.width = np.array(starts, dtype=np.int64), np.array(lengths, dtype=np.int64)
        self.least = int(self.width.min()) if len(starts) else 0
        keys = _keys(np.array(flat, dtype=np.int32), self.start, self.width)
        # Suffixes with one and the same window share one search.
        _, self.one, self.window = np.unique(keys, return_index=True, return_inverse=True)
        self.low, self.one_width = keys[self.one], self.width[self.one]
        tail = (np.arange(WINDOW) >= self.one_width[:, None]).repeat(4, axis=1)
        raw = self.low.view(np.uint8).reshape(len(self.one), 4 * WINDOW)
        self.high = np.ascontiguousarray(np.where(tail, 255, raw).astype(np.uint8)).view(f"S{4 * WINDOW}").ravel()
        order = np.argsort(self.window, kind="stable")
        self.members = np.split(order, np.cumsum(np.bincount(self.window, minlength=len(self.one)))[:-1]) if len(order) else []


def _keys(ids: np.ndarray, at: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The first WINDOW ids from each position, zero beyond its run, as byte
    strings that sort in id order."""
    col = np.arange(WINDOW)
    idx = np.minimum(at[:, None] + col, len(ids) - 1)
    cut = np.where(col < run[:, None], ids[idx], 0).astype(">i4")
    return np.ascontiguousarray(cut).view(f"S{4 * WINDOW}").ravel()


def search_shard(block: TestBlock, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(training position, window number) of every occurrence in one shard;
    ``ids`` has 0 for words outside the benchmark and between documents."""
    none = np.zeros(0, dtype=np.int64)
    if not len(ids) or not len(block.one):
        return none, none
    where = np.arange(len(ids))
    stop = np.minimum.accumulate(np.where(ids == 0, where, len(ids))[::-1])[::-1]
    run = stop - where
    at = np.flatnonzero(run >= block.least)
    if not len(at):
        return none, none
    keys = _keys(ids, at, run[at])
    order = np.argsort(keys, kind="stable")  # the suffix array
    keys, at = keys[order], at[order]
    lo = np.searchsorted(keys, block.low, "left")
    hi = np.searchsorted(keys, block.high, "right")
    found = np.flatnonzero(hi > lo)
    n = (hi - lo)[found]
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return at[np.repeat(lo[found], n) + inside], np.repeat(found, n)


def longest_matches(block: TestBlock, pos: np.ndarray, win: np.ndarray) -> list[tuple[int, int, str, int]]:
    """(training start, words, item, item start) of the maximal verbatim
    matches among the occurrences of one document, by item and diagonal: an
    item's stretches follow each other without a gap."""
    hits = [(int(block.item[t]), int(p) - int(block.place[t]), int(p), int(block.width[s]))
            for p, w in zip(pos, win) for s in block.members[w] for t in (block.start[s],)]
    out: list[list] = []
    last = None
    for item, diag, p, width in sorted(set(hits)):
        if last == (item, diag, p - 1):
            out[-1][1] = p + width - out[-1][0]
        else:
            out.append([p, width, block.names[item], p - diag])
        last = (item, diag, p)
    return [tuple(x) for x in out]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _numbered(block: TestBlock, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each document, word numbers with 0 between documents)."""
    lens = np.array([len(d) for d in docs], dtype=np.int64)
    first = np.cumsum(lens + 1) - (lens + 1)
    ids = np.zeros(int((lens + 1).sum()), dtype=np.int32)
    get = block.vocab.get
    for at, d in zip(first.tolist(), docs):
        if d:
            ids[at:at + len(d)] = np.fromiter(map(get, d, repeat(0)), dtype=np.int32, count=len(d))
    return first, ids


def _judge(block: TestBlock, docs: list[list[bytes]]) -> list[tuple]:
    """(hit spans, items, longest match) of each document of a shard."""
    first, ids = _numbered(block, docs)
    pos, win = search_shard(block, ids)
    out: list[tuple] = [([], [], 0)] * len(docs)
    if not len(pos):
        return out
    order = np.argsort(pos, kind="stable")
    pos, win = pos[order], win[order]
    of = np.searchsorted(first, pos, "right") - 1
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
    known: dict[bytes, list] = {}
    for lo, hi in zip(cuts, cuts[1:]):
        d, p, w = of[lo], pos[lo:hi] - first[of[lo]], win[lo:hi]
        spans = _merged(list(zip(p.tolist(), (p + block.one_width[w]).tolist())))
        distinct = np.unique(w)
        if distinct.tobytes() not in known:
            items = np.unique(block.item[block.start[np.concatenate([block.members[x] for x in distinct])]])
            known[distinct.tobytes()] = [block.names[i] for i in items]
        longest = max(m[1] for m in longest_matches(block, p, w))
        out[d] = (spans, known[distinct.tobytes()], longest)
    return out


def _shards(texts):
    """Ranges of rows of at most SHARD_WORDS words (or one document)."""
    held, n, at = [], 0, 0
    for i, t in enumerate(texts):
        w = words_of(t)
        if held and n + len(w) > SHARD_WORDS:
            yield at, held
            held, n, at = [], 0, i
        held.append(w)
        n += len(w)
    if held:
        yield at, held


def _search_batches(block, state: str, text: str):
    names = [state + c.split()[0] for c in _STATE.split(", ")]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64(), span, pa.list_(pa.string()), pa.int64()]

    def run(batches):
        index = block.value
        for b in batches:
            held = {n: b.column(n).to_pylist() if n in b.schema.names else None for n in names}
            rows: list[tuple] = []
            for at, docs in _shards(b.column(text).to_pylist()):
                for i, (d, (spans, items, longest)) in enumerate(zip(docs, _judge(index, docs)), at):
                    if held[names[1]] is not None:
                        spans = _merged(spans + [(x["start"], x["end"]) for x in held[names[1]][i]])
                        items = sorted({*items, *held[names[2]][i]})
                        longest = max(longest, held[names[3]][i])
                    rows.append((len(d), [{"start": s, "end": e} for s, e in spans], items, longest))
            cols = list(zip(*rows)) if rows else [[]] * 4
            keep = [n for n in b.schema.names if n not in names]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             [*keep, *names])
    return run


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """Yield the benchmark as lists of stretches of whole items, of about
    ``block_words`` words together (or one item); never more of it is on the
    driver at once."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    cut = materialise(benchmark.sparkSession,
                      items.mapInArrow(_stretch_batches, "item string, start long, n long, words binary").distinct(), "benchmark")
    total = cut.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_words)
    for i in range(blocks):
        yield cut.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).collect()


def with_hits(docs: DataFrame, benchmark: DataFrame, prefix: str = "", text: str = "text",
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with (n_words, hits, items, longest), names after ``prefix``:
    hit word ranges, the items that hit, and the longest verbatim match."""
    spark, plain = docs.sparkSession, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    state = ", ".join(prefix + c for c in _STATE.split(", "))
    schema = f"{plain}, {state}" if plain else state
    out, first = docs, True
    for rows in benchmark_blocks(benchmark, block_words):
        if not first:  # one block at a time in an executor's memory
            out = materialise(spark, out, "searched")
        block = spark.sparkContext.broadcast(TestBlock(rows))
        out, first = out.mapInArrow(_search_batches(block, prefix, text), schema), False
    if first:
        out = docs.mapInArrow(_search_batches(spark.sparkContext.broadcast(TestBlock([])), prefix, text), schema)
    return out


_MATCH = "doc_start long, words long, item_id string, item_start long"


def _match_batches(block, keep: list[str], text: str):
    def run(batches):
        index = block.value
        for b in batches:
            for at, docs in _shards(b.column(text).to_pylist()):
                first, ids = _numbered(index, docs)
                pos, win = search_shard(index, ids)
                order = np.argsort(pos, kind="stable")
                pos, win = pos[order], win[order]
                of = np.searchsorted(first, pos, "right") - 1
                cuts = np.searchsorted(of, np.arange(len(docs) + 1))
                rows = [(at + d, m) for d in np.flatnonzero(np.diff(cuts))
                        for m in longest_matches(index, pos[cuts[d]:cuts[d + 1]] - first[d], win[cuts[d]:cuts[d + 1]])]
                if rows:
                    of_row = pa.array([i for i, _ in rows], pa.int64())
                    cols = [pa.array(c, t) for c, t in zip(zip(*(m for _, m in rows)), (pa.int64(), pa.int64(), pa.string(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*[b.column(c).take(of_row) for c in keep], *cols],
                                                     [*keep, *(c.split()[0] for c in _MATCH.split(", "))])
    return run


def verbatim_matches(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
                     block_words: int = BLOCK_WORDS) -> DataFrame:
    """(``keep``, doc_start, words, item_id, item_start): one row per longest
    verbatim match of a window or more between a document and an item, with
    its places in words."""
    spark, keep = docs.sparkSession, list(keep)
    held = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    out = spark.createDataFrame([], f"{held}, {_MATCH}")
    for rows in benchmark_blocks(benchmark, block_words):
        block = spark.sparkContext.broadcast(TestBlock(rows))
        out = out.unionByName(docs.select(*keep, text).mapInArrow(_match_batches(block, keep, text), f"{held}, {_MATCH}"))
    return out


def _n_hit(hits: str):
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def _contaminated(n_hit, n_words, share: int):
    return (n_hit > 0) & (n_hit * share >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest)
    per row of ``docs``."""
    found = with_hits(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", _n_hit("hits").alias("n_hit"), F.array_sort("items").alias("items"), "longest")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        _contaminated(F.col("n_hit"), F.col("n_words"), share).alias("contaminated"), "longest")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, share: int = SHARE) -> DataFrame:
    """``docs`` without its contaminated rows, all columns kept."""
    prefix = spare(docs.columns, "found")
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    found = with_hits(docs, benchmark, prefix)
    bad = _contaminated(_n_hit(prefix + "hits"), F.col(prefix + "n_words"), share)
    return found.where(~bad).select(docs.columns)
