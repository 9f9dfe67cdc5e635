"""Katz backoff model of any order over a corpus, and every document's score by
it.

A token is a word or the end of its document; its history h is the ``order`` - 1
tokens before it, or all of them and a start mark where there are fewer.
P(w | h) is the discounted count of (h, w) over the count of h where the n-gram
was seen, and otherwise alpha(h) * P(w | h'), h' being h without its first
token; alpha of a history that was not seen is 1.  P(w) is the discounted count
of w over all tokens, and an unseen word gets an equal share of what the
discounts leave, one share for each word seen once.  alpha(h) is what the seen
n-grams of h leave, over what their words leave in P(. | h'), so that every
context adds up to one.  Each level has its own discounts.  Counts up to
``GT_MAX`` get Good-Turing discounts with Katz's correction (from all counts of
counts); larger counts give up as much as ``GT_MAX`` does, so that each context
has something left to back off with.  Where counts of counts allow no valid
discount, every count gives up one half.

Counts of each level and backoff weights are tables partitioned by n-gram hash.  The
corpus is written as blocks of about ``BLOCK_TOKENS`` tokens with a vocabulary
each; a block asks the tables once for each distinct n-gram it holds, as packed
sorted arrays, and gets the counts back in that order.  One block of those that
hold an n-gram owns it and adds its discounted count and P(w | h') to its
context; w was seen after h' too, so no weight of a lower level is needed for
it.  A context gets at most ``HOT_DOCS`` entries of documents from a block;
where more back off from it, they stay in one row of the block, which the
context's weight is joined to.  So hot words, passages and contexts are one
request per block, no partition grows with a frequent key, and nothing but
counts of counts and totals comes to the driver.

Edge cases: null text is the end token alone; without training documents
every probability is 1; repeated rows are counted and scored each for itself;
a null doc_id counts as training; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.packed import pack, pack_keys, runs, unpack, unpack_keys
from barlake.llm.storage import materialise
from barlake.llm.words import mix, word_hashes

GT_MAX = 7
BLOCK_TOKENS = 2_000_000
#: Tokens per partition of the n-gram tables, about.
PART_TOKENS = 500_000
TEXT_BATCH = 512
#: A context from which more documents of a block back off is hot there.
HOT_DOCS = 64
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xA0761D6478BD642F)


# --- blocks -------------------------------------------------------------------

_BLOCKS = "block long, n_tokens long, doc_ids array<long>, uids binary, lengths binary, train binary, vocab binary, tokens binary"


def _block_batches(batches):
    schema = pa.schema([("block", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        *[(c, pa.binary()) for c in ("uids", "lengths", "train", "vocab", "tokens")]])
    held, ids, uids, train, size = [], [], [], [], 0

    def row():
        h = np.concatenate(held)
        vocab, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")  # frequent words get small numbers
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        cols = [uids[0], len(h), ids, pack(np.array(uids, dtype=np.int64)), pack(np.array([len(x) for x in held], dtype=np.int64)),
                pack(np.array(train, dtype=np.uint8)), pack(vocab[order]), pack(rank[inverse])]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, schema.types)], schema=schema)

    for b in batches:
        for at in range(0, b.num_rows, TEXT_BATCH):
            part = b.slice(at, TEXT_BATCH)
            for doc, uid, t, words in zip(part.column("doc_id").to_pylist(), part.column("uid").to_pylist(), part.column("train").to_pylist(),
                                     word_hashes(part.column("text").to_pylist())):
                held.append(np.append(words, END))
                ids.append(doc)
                uids.append(uid)
                train.append(t)
                size += len(words) + 1
                if size >= BLOCK_TOKENS:
                    yield row()
                    held, ids, uids, train, size = [], [], [], [], 0
    if held:
        yield row()


def _document_batches(batches):
    """(uid, doc_id, train) of the documents of stored blocks."""
    for b in batches:
        for r in b.to_pylist():
            yield pa.RecordBatch.from_arrays(
                [pa.array(unpack(r["uids"], np.int64)), pa.array(r["doc_ids"], pa.int64()),
                 pa.array(unpack(r["train"], np.uint8).astype(bool))], ["uid", "doc_id", "train"])


class Block:
    """One stored block: its tokens, contexts and distinct n-grams."""

    def __init__(self, lengths, train, vocab, tokens):
        self.lengths = unpack(lengths, np.int64)
        self.vocab, self.tokens = unpack(vocab, np.uint64), unpack(tokens, np.uint32).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.trained = np.repeat(unpack(train, np.uint8).astype(bool), self.lengths)
        # The context of a token is the word before it; number len(vocab) is the start.
        self.context = np.concatenate([[len(self.vocab)], self.tokens[:-1]])
        self.context[self.starts] = len(self.vocab)
        self.offset = np.arange(len(self.tokens)) - np.repeat(self.starts, self.lengths)
        self.order1 = np.argsort(self.vocab)

    def words(self):
        """(sorted keys, training counts) of the block's distinct tokens."""
        counts = np.bincount(self.tokens[self.trained], minlength=len(self.vocab))
        return self.vocab[self.order1], counts[self.order1]

    def grams(self, order: int):
        """(level, sorted keys, training counts, first position, number per
        token) of the distinct n-grams of each level from 2 to ``order``; a token
        whose history would pass the start mark has number -1."""
        word = self.vocab[self.tokens]
        before = np.append(self.vocab, START)[self.context]
        for level in range(2, order + 1):
            at_token = mix(before * _PAIR + word)
            has = np.flatnonzero(self.offset >= level - 2)
            if not len(has):
                yield level, at_token[:0], np.zeros(0, np.int64), has, np.full(len(word), -1)
            else:
                by = has[np.argsort(at_token[has], kind="stable")]
                keys = at_token[by]
                new = np.concatenate([[True], keys[1:] != keys[:-1]])
                number = np.cumsum(new) - 1
                inverse = np.full(len(word), -1, dtype=np.int64)
                inverse[by] = number
                counts = np.bincount(number, weights=self.trained[by], minlength=int(number[-1]) + 1).astype(np.int64)
                yield level, keys[new], counts, by[new], inverse
            before = np.concatenate([[START], at_token[:-1]])


# --- counts -------------------------------------------------------------------

_ASKED = "level int, bucket long, block long, keys binary, counts binary"
_COUNTED = ("kind string, level int, bucket long, block long, keys binary, counts binary, own binary, "
            "spectrum array<long>")


def _ask_batches(bits: int, order: int):
    schema = pa.schema([("level", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()),
                        ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(r["lengths"], r["train"], r["vocab"], r["tokens"])
                for level, keys, counts in chain([(1, *block.words())], (x[:3] for x in block.grams(order))):
                    rows = [(level, k, r["block"], pack_keys(keys[lo:hi]), pack(counts[lo:hi].astype(np.uint32)))
                            for k, lo, hi in runs(keys, bits)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def _count_group(table: pa.Table) -> pa.Table:
    """Totals of one partition: a reply to each block that asked (counts and
    who owns each n-gram, in the order asked), the partition's n-gram table, and
    its counts of counts."""
    rows = sorted(table.select(["level", "bucket", "block", "keys", "counts"]).to_pylist(), key=lambda r: r["block"])
    level, bucket = rows[0]["level"], rows[0]["bucket"]
    asked = [unpack_keys(r["keys"]) for r in rows]
    own = [unpack(r["counts"], np.uint32) for r in rows]
    keys, first, inverse = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate(own), minlength=len(keys)).astype(np.int64)
    owner = np.zeros(len(inverse), dtype=np.uint8)
    owner[first] = 1
    out, at = [], 0
    for r, a in zip(rows, asked):
        n = len(a)
        out.append({"kind": "reply", "level": level, "bucket": bucket, "block": r["block"],
                    "counts": pack(total[inverse[at:at + n]].astype(np.uint64)), "own": pack(owner[at:at + n])})
        at += n
    some = total > 0
    out.append({"kind": "table", "level": level, "bucket": bucket, "keys": pack_keys(keys[some]),
                "counts": pack(total[some].astype(np.uint64))})
    spectrum = np.bincount(np.minimum(total[some], GT_MAX + 2), minlength=GT_MAX + 3).tolist()
    out.append({"kind": "spectrum", "level": level, "bucket": bucket, "spectrum": [*spectrum, int(total.sum())]})
    return pa.Table.from_pylist(out, schema=pa.schema([
        ("kind", pa.string()), ("level", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()),
        ("counts", pa.binary()), ("own", pa.binary()), ("spectrum", pa.list_(pa.int64()))]))


class Discount:
    """Discounted counts from counts of counts n[0..GT_MAX+2] (the last holds
    all larger counts)."""

    def __init__(self, n: list[int]):
        self.small = np.arange(GT_MAX + 1) - 0.5
        self.small[0] = 0.0
        self.less = 0.5
        for most in range(GT_MAX, 0, -1):
            if all(n[r] > 0 for r in range(1, most + 2)):
                a = (most + 1) * n[most + 1] / n[1]
                r = np.arange(1, most + 1)
                again = (r + 1) * np.array([n[x + 1] / n[x] for x in r])
                good = r * (again / r - a) / (1 - a) if a != 1 else np.zeros(most)
                if ((good > 0) & (good < r)).all():
                    self.less = float(most - good[-1])
                    self.small = np.concatenate([[0.0], good, np.arange(most + 1, GT_MAX + 1) - self.less])
                    break

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return np.where(c <= GT_MAX, self.small[np.minimum(c, GT_MAX)], c - self.less)


class Totals:
    """What all tasks need of the whole corpus: a few numbers."""

    def __init__(self, spectra: dict[int, list[int]], documents: int, order: int):
        none = [0] * (GT_MAX + 4)
        one = spectra.get(1, none)
        self.tokens, self.types, self.documents, self.order = one[-1], sum(one[1:-1]), documents, order
        self.one = Discount(one)
        self.discount = {level: Discount(spectra.get(level, none)) for level in range(2, order + 1)}
        kept = sum(n * float(self.one(np.array(r))) for r, n in enumerate(one[:GT_MAX + 1]))
        large = self.types - sum(one[1:GT_MAX + 1])
        kept += self.tokens - sum(r * n for r, n in enumerate(one[:GT_MAX + 1])) - self.one.less * large
        self.unseen = (1 - kept / self.tokens) / max(1, one[1]) if self.tokens else 1.0

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.one(c) / max(1, self.tokens), self.unseen)


# --- scores -------------------------------------------------------------------

_SENT = ("level int, bucket long, keys binary, seen binary, mass binary, lower binary, use_context binary, use_uid binary, "
         "use_n binary, uid binary, n_tokens binary, n_known binary, base binary, score binary, hot binary, hot_key binary")
_SCORED = ("uid long, n_tokens long, n_known long, base double, score double, level int, bucket long, keys binary, weights binary, "
           "hot_key binary, weight double, use_uid binary, use_n binary")


def _score_batches(totals, bits: int, hot_docs: int):
    names = [c.split()[0] for c in _SENT.split(", ")]
    schema = pa.schema([("level", pa.int32()), ("bucket", pa.int64()), *[(c, pa.binary()) for c in names[2:]]])

    def rows_of(r: dict, t: Totals):
        block = Block(r["lengths"], r["train"], r["vocab"], r["tokens"])
        got = {level: sorted((x for x in r["replies"] if x["level"] == level), key=lambda x: x["bucket"]) for level in range(1, t.order + 1)}

        def replied(level: int, col: str, dtype):
            return np.concatenate([np.zeros(0, dtype), *[unpack(x[col], dtype) for x in got[level]]])

        c1 = np.empty(len(block.vocab), dtype=np.int64)
        c1[block.order1] = replied(1, "counts", np.uint64).astype(np.int64)
        tok, starts = block.tokens, block.starts
        uid = unpack(r["uids"], np.int64)
        p1 = t.unigram(c1)
        base = np.log10((c1 + 0.5) / (t.tokens + 0.5 * (t.types + 1)))[tok]
        score = np.log10(p1)[tok]
        # Contexts of a level: the number of each token's, their keys and counts;
        # below is P(w | h') where (h', w) was seen.
        ctx, hist, seen_ctx, below = block.context, np.append(block.vocab, START), np.append(c1, t.documents), p1[tok]
        for level, keys, _, first, inverse in block.grams(t.order):
            c = replied(level, "counts", np.uint64).astype(np.int64)
            own = replied(level, "own", np.uint8).astype(bool) & (c > 0)
            assert len(keys) == len(c), "replies to another block"
            yield from contexts(level, block, uid, t.discount[level], c, own, first, inverse, ctx, hist, seen_ctx, below)
            has = np.flatnonzero(inverse >= 0)
            has = has[c[inverse[has]] > 0]
            below = np.zeros(len(tok))
            below[has] = t.discount[level](c[inverse[has]]) / seen_ctx[ctx[has]]
            score[has] = np.log10(below[has])
            ctx, hist, seen_ctx = np.concatenate([[-1], inverse[:-1]]), keys, c
        yield {"level": 1, "bucket": r["block"] % (1 << bits), "uid": pack(uid), "n_tokens": pack(block.lengths),
               "n_known": pack(np.add.reduceat((c1 > 0)[tok].astype(np.int64), starts)),
               "base": pack(np.add.reduceat(base, starts)), "score": pack(np.add.reduceat(score, starts))}

    def contexts(level, block, uid, discount, c, own, first, inverse, ctx, hist, seen_ctx, below):
        """What this block knows of its contexts of a level, and where it backs
        off from them."""
        size = len(seen_ctx)
        at = first[own]
        mass = np.bincount(ctx[at], weights=discount(c[own]), minlength=size)
        lower = np.bincount(ctx[at], weights=below[at], minlength=size)
        off = np.flatnonzero(inverse >= 0)
        off = off[(c[inverse[off]] == 0) & (seen_ctx[ctx[off]] > 0)]
        doc = np.searchsorted(block.starts, off, "right") - 1
        uses, n = np.unique(ctx[off] * len(uid) + doc, return_counts=True)
        use_ctx, use_doc = uses // len(uid), uses % len(uid)
        wanted = np.zeros(size, dtype=bool)
        wanted[use_ctx] = True
        # Documents that back off from a context of many stay with the block:
        # only the context's weight travels, to one row a block.
        hot = np.bincount(use_ctx, minlength=size) > hot_docs
        for h in np.flatnonzero(hot):
            a, z = np.searchsorted(use_ctx, [h, h + 1])
            yield {"level": level, "bucket": int((uid[0] + h) % (1 << bits)), "hot_key": hist[h].tobytes(),
                   "use_uid": pack(uid[use_doc[a:z]]), "use_n": pack(n[a:z].astype(np.uint32))}
        cold = ~hot[use_ctx]
        use_ctx, use_doc, n = use_ctx[cold], use_doc[cold], n[cold]
        some = np.flatnonzero(wanted | (mass > 0))
        some = some[np.argsort(hist[some])]
        place = np.full(size, -1, dtype=np.int64)
        place[some] = np.arange(len(some))
        by = np.argsort(place[use_ctx], kind="stable")
        use_at, use_doc, n = place[use_ctx][by], use_doc[by], n[by]
        for k, lo, hi in runs(hist[some], bits):
            a, z = np.searchsorted(use_at, [lo, hi])
            cut = some[lo:hi]
            yield {"level": level, "bucket": k, "keys": pack_keys(hist[cut]), "seen": pack(seen_ctx[cut]), "mass": pack(mass[cut]),
                   "lower": pack(lower[cut]), "hot": pack(hot[cut].astype(np.uint8)), "use_context": pack((use_at[a:z] - lo).astype(np.uint32)),
                   "use_uid": pack(uid[use_doc[a:z]]), "use_n": pack(n[a:z].astype(np.uint32))}

    def run(batches):
        t = totals.value
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist(list(rows_of(r, t)), schema=schema)
    return run


def _backoff_group(table: pa.Table) -> pa.Table:
    """Backoff weights of one partition's contexts, what they add to the
    documents that back off there, and the blocks' own sums passed on."""
    names = [c.split()[0] for c in _SCORED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(),
             pa.binary(), pa.float64(), pa.binary(), pa.binary()]
    out = []

    def add(n, **cols):
        out.append(pa.table({c: pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in zip(names, types)}))

    rows = table.to_pylist()
    for r in rows:
        if r["uid"] is not None:
            uid = unpack(r["uid"], np.int64)
            add(len(uid), uid=uid, n_tokens=unpack(r["n_tokens"], np.int64), n_known=unpack(r["n_known"], np.int64),
                base=unpack(r["base"], np.float64), score=unpack(r["score"], np.float64))
        elif r["hot_key"] is not None:
            add(1, level=[r["level"]], hot_key=[r["hot_key"]], use_uid=[r["use_uid"]], use_n=[r["use_n"]])
    rows = [r for r in rows if r["keys"] is not None]
    if rows:
        own = [unpack_keys(r["keys"]) for r in rows]
        keys, inverse = np.unique(np.concatenate(own), return_inverse=True)
        mass, lower = (np.bincount(inverse, weights=np.concatenate([unpack(r[c], np.float64) for r in rows]), minlength=len(keys))
                       for c in ("mass", "lower"))
        seen = np.ones(len(keys), dtype=np.int64)
        seen[inverse] = np.concatenate([unpack(r["seen"], np.int64) for r in rows])
        alpha = np.log10((1 - mass / np.maximum(seen, 1)) / (1 - lower))
        base = np.cumsum([0, *[len(x) for x in own]])
        at = np.concatenate([unpack(r["use_context"], np.uint32) + b for r, b in zip(rows, base)]).astype(np.int64)
        uid = np.concatenate([unpack(r["use_uid"], np.int64) for r in rows])
        n = np.concatenate([unpack(r["use_n"], np.uint32) for r in rows])
        docs, of = np.unique(uid, return_inverse=True)
        sums = np.bincount(of, weights=alpha[inverse[at]] * n, minlength=len(docs))
        add(len(docs), uid=docs, score=sums)
        add(1, level=[rows[0]["level"]], bucket=[rows[0]["bucket"]], keys=[pack_keys(keys)], weights=[pack(alpha)])
        hot = np.unique(inverse[np.concatenate([unpack(r["hot"], np.uint8) for r in rows]) > 0])
        add(len(hot), level=[rows[0]["level"]] * len(hot), hot_key=[k.tobytes() for k in keys[hot]], weight=alpha[hot])
    return pa.concat_tables(out)


def _hot_batches(batches):
    """What a hot context adds to the documents of one block that back off there."""
    for b in batches:
        for r in b.to_pylist():
            uid = unpack(r["use_uid"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(unpack(r["use_n"], np.uint32) * r["weight"])], ["uid", "score"])


def score_documents(docs: DataFrame, folds: int = 5, held: int = 1, order: int = 2, hot_docs: int = HOT_DOCS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every document by the model of ``order``, learned from the folds other than
    ``held``."""
    if order < 1:
        raise ValueError("order must be 1 or more")
    spark = docs.sparkSession
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), (~out).alias("train"), "text")
    blocks = materialise(spark, texts.mapInArrow(_block_batches, _BLOCKS), "lm-blocks")
    rows = materialise(spark, blocks.select("uids", "train", "doc_ids").mapInArrow(
        _document_batches, "uid long, doc_id long, train boolean"), "lm-documents")
    documents = rows.where("train").count()
    size = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(width - 1, size // PART_TOKENS).bit_length()
    asked = blocks.drop("doc_ids").mapInArrow(_ask_batches(bits, order), _ASKED)
    counted = materialise(spark, asked.groupBy("level", "bucket").applyInArrow(_count_group, _COUNTED), "lm-counts")
    spectra = counted.where("kind = 'spectrum'").select("level", F.posexplode("spectrum").alias("r", "n"))
    spectra = spectra.groupBy("level", "r").agg(F.sum("n").alias("n")).collect()
    by_level: dict[int, list[int]] = {}
    for r in sorted(spectra, key=lambda r: (r["level"], r["r"])):
        by_level.setdefault(r["level"], []).append(r["n"])
    totals = Totals(by_level, documents, order)
    replies = counted.where("kind = 'reply'").groupBy("block").agg(
        F.collect_list(F.struct("level", "bucket", "counts", "own")).alias("replies"))
    sent = blocks.drop("doc_ids").join(replies, "block").mapInArrow(_score_batches(spark.sparkContext.broadcast(totals), bits, hot_docs), _SENT)
    scored = materialise(spark, sent.groupBy("level", "bucket").applyInArrow(_backoff_group, _SCORED), "lm-scores")
    hot = scored.where("use_uid IS NOT NULL").select("level", "hot_key", "use_uid", "use_n").join(
        scored.where("weight IS NOT NULL").select("level", "hot_key", "weight"), ["level", "hot_key"])
    hot = hot.select("use_uid", "use_n", "weight").mapInArrow(_hot_batches, "uid long, score double")
    parts = scored.where("uid IS NOT NULL").select("uid", "n_tokens", "n_known", "base", "score")
    sums = parts.unionByName(hot, allowMissingColumns=True).groupBy("uid").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"),
        F.sum("score").alias("score"))
    return rows.join(sums, "uid").select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                                         F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
