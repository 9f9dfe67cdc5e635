"""Self join of documents by Jaccard similarity of word shingles, with
count vectors in an R-tree.

Tokens (shingle hashes) are dealt into groups by their hash; the number of
tokens per group is a document's point.  The sum over groups of the smaller
coordinate bounds the overlap of two sets from above, and the same sum with
the upper corner of a tree node bounds it for all documents below.  Pairs that
pass meet the same bound over more groups, and are then verified on the sets.

Distribution.  Equal sets are one class and enter once.  Two sets with
similarity of at least t differ in at most d = (1-t)/(1+t) * (sum of sizes)
tokens, so of d + 1 + e hash groups at least e + 1 hold the same tokens in
both: classes that share (size band, group, signature of the group's tokens)
are candidates, everything else cannot link.  ``e`` covers groups that are
empty in a document, which give no signature; a document with more empty
groups than that signs those as well.  Signatures travel as packed sorted
arrays, one entry per signature and block of documents, so a signature of
many documents is no hot key.  Components of the candidate graph ("blobs") are
joined apart from each other.

A blob of up to ``LEAF`` classes is one tree.  Sets that share a passage, or a
passage each with a third, run together in blobs that grow with the corpus, so
large blobs are narrowed first: a linked set shares at least t of its tokens
with other sets of its blob, and candidates are looked for again among the sets
that do.  Blobs that stay large are packed into leaves of ``LEAF`` classes by (component so far, size); a first pass compares
each member with a few pivots, so leaves that lie wholly within one component
are not compared with each other, and leaf pairs whose corners rule a link out
are dropped.  Inside a tree, pairs already connected are skipped: components
lose no link, and a group of near copies costs one verification a member.

Edge cases: null text and text without words have the empty set and link with
nothing; fewer words than a shingle make one token; repeated rows and equal
sets share a component; a null doc_id never names a component unless all its
members lack one; an empty table gives no rows; other columns are
ignored, and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.components import connected_components
from barlake.llm.packed import pack, pack_keys, runs, unpack, unpack_keys
from barlake.llm.storage import materialise, spare
from barlake.llm.words import mix, shingle_set, word_hashes

GROUPS = 128
#: Groups of the second, tighter bound on pairs the tree lets through.
FINE = 1024
LEAF = 1024
NODE = 32
#: Blobs of more leaves than this together are narrowed before leaves are paired.
FEW_LEAVES = 8
PIVOTS = 4
#: Tokens of a leaf, about, whatever the number of its classes.
LEAF_TOKENS = 2_000_000
#: Tokens of all pivots that are broadcast, at most (8 bytes each).
PIVOT_TOKENS = 4_000_000
#: Ids of candidates are broadcast to the scan of the texts up to this many
#: (24 bytes each), and joined by a shuffle beyond.
BROADCAST_ROWS = 200_000
#: Ids of rows that ``keep_one`` drops are broadcast to the stored texts up to
#: this many, and joined by a shuffle beyond.
DROP_ROWS = 2_000_000
TEXT_BATCH = 512
#: Bytes of an Arrow batch, about; a task holds a few at a time.
BATCH_BYTES = "8m"
_BATCH_BYTES, _DEFAULT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Signatures a task sorts at once, and tokens per range of keys, about.
KEY_BLOCK = 400_000
KEY_PART = 1_000_000


class Threshold:
    """Similarity of at least ``part`` / ``whole`` in exact integers."""

    def __init__(self, part: int, whole: int):
        self.part, self.whole = part, whole

    def differ(self, both: int) -> int:
        """Most tokens two linked sets of ``both`` tokens together differ in."""
        return both * (self.whole - self.part) // (self.whole + self.part)

    def needs(self, a, b):
        """Least overlap of linked sets of sizes a and b."""
        return -(-self.part * (a + b) // (self.whole + self.part))

    def largest(self, n: int) -> int:
        return n * self.whole // self.part

    def bands(self, n: int) -> list[tuple[int, int, int]]:
        """(band, groups, spare groups) of the schemes a set of ``n`` tokens
        signs by: those of every size its larger partner may have."""
        if n not in _BANDS.setdefault((self.part, self.whole), {}):
            _BANDS[self.part, self.whole][n] = self._bands(n)
        return _BANDS[self.part, self.whole][n]

    def _bands(self, n: int) -> list[tuple[int, int, int]]:
        out, lo, band = [], 1, 0
        while lo <= self.largest(n):
            hi = max(lo, lo * 5 // 4)
            d = self.differ(2 * hi)
            if hi >= n and d > 0:
                extra = self.spare(d, -(-lo * self.part // self.whole))
                out.append((band, d + 1 + extra, extra))
            lo, band = hi + 1, band + 1
        return out

    @staticmethod
    def spare(d: int, least: int) -> int:
        """Groups to add so that few sets of ``least`` tokens leave more groups
        empty than that (three standard deviations of the occupancy)."""
        extra = 1
        while extra < least:
            m = d + 1 + extra
            p1, p2 = (1 - 1 / m) ** least, max(0.0, 1 - 2 / m) ** least
            mean = m * p1
            spread = max(0.0, mean + m * (m - 1) * p2 - mean * mean) ** 0.5
            if extra >= mean + 3 * spread:
                break
            extra += 1
        return extra


_BANDS: dict = {}


def signatures(tokens: np.ndarray, t: Threshold) -> np.ndarray:
    """Candidate keys of a sorted token set."""
    keys = []
    high = tokens >> np.uint64(32)
    for band, groups, extra in t.bands(len(tokens)):
        of = (high * np.uint64(groups)) >> np.uint64(32)  # tokens are sorted, so groups are runs
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        g = of[first]
        sig = np.add.reduceat(mix(tokens + np.uint64(band + 1)), first)
        empty = groups - len(g)
        if empty > extra:
            lacking = np.setdiff1d(np.arange(groups, dtype=np.uint64), g)
            g, sig = np.concatenate([g, lacking]), np.concatenate([sig, np.zeros(empty, dtype=np.uint64)])
        keys.append(mix(sig ^ mix(g * np.uint64(1009) + np.uint64(band))))
    return np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)


def node_of(digest: bytes) -> int:
    """Candidate-graph node of a set.  Sets that share a node by chance only
    meet in one blob; they are told apart by their digests."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _sketch_batches(width: int):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, TEXT_BATCH):
                part = b.slice(at, TEXT_BATCH)
                sets = [shingle_set(w, width) for w in word_hashes(part.column("text").to_pylist())]
                digest = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("uid", "doc_id", "h")], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digest, pa.binary()), pa.array([d and node_of(d) for d in digest], pa.int64())],
                    ["uid", "doc_id", "h", "n", "digest", "node"])
    return run


_SIGNED = "bucket long, keys binary, pivots binary, nodes binary"


def spare_bits(keys: int) -> int:
    """Low bits of a 64-bit signature, in whole bytes, that ``keys`` of them can
    do without: by chance one in 2**20 shares its other bits with another, and
    such classes only meet in one blob."""
    return max(0, (64 - max(keys, 2).bit_length() - 20) // 8 * 8)


def _text_sets(width: int):
    """(node, token set) of each text of a batch."""
    def sets(part: pa.RecordBatch):
        for words in word_hashes(part.column("text").to_pylist()):
            tokens = shingle_set(words, width)
            yield node_of(hashlib.md5(tokens.tobytes()).digest()), tokens
    return sets


def _stored_sets(part: pa.RecordBatch):
    """(cid, token set) of each row of a batch."""
    return zip(part.column("cid").to_pylist(), _sets(part))


def _key_batches(sets, t: Threshold, bits: int, spare: int):
    """Signatures of the sets of each batch, about ``KEY_BLOCK`` keys at a time: one entry per key with
    the least node that has it, and an edge from every other such node to it
    (bucket null).  A key of many documents is one entry per block."""
    schema = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("pivots", pa.binary()), ("nodes", pa.binary())])

    def rows(keys: list, nodes: list):
        names = np.array(nodes, dtype=np.int64)
        key = np.concatenate(keys)
        of = np.repeat(names, [len(k) for k in keys])
        order = np.lexsort((of, key))
        key, of = key[order], of[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        pivot = np.repeat(of[first], np.diff(np.append(first, len(key))))
        rest = of != pivot
        edges = np.unique(np.stack([of[rest], pivot[rest]]), axis=1)
        out = [{"pivots": pack(edges[1]), "nodes": pack(edges[0])}] if edges.shape[1] else []
        known, number = np.unique(of[first], return_inverse=True)
        for bucket, lo, hi in runs(key[first], bits):
            used, local = np.unique(number[lo:hi], return_inverse=True)
            out.append({"bucket": bucket, "keys": pack_keys(key[first][lo:hi]), "pivots": pack(local.astype(np.uint32)),
                        "nodes": pack(known[used])})
        return pa.RecordBatch.from_pylist(out, schema=schema)

    def run(batches):
        keys, nodes, size = [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, TEXT_BATCH):
                for node, tokens in sets(b.slice(at, TEXT_BATCH)):
                    k = signatures(tokens, t)
                    if not len(k):
                        continue
                    keys.append(k >> np.uint64(spare) << np.uint64(spare))
                    nodes.append(node)
                    size += len(k)
                    if size >= KEY_BLOCK:
                        yield rows(keys, nodes)
                        keys, nodes, size = [], [], 0
        if keys:
            yield rows(keys, nodes)
    return run


def _edge_group(table: pa.Table) -> pa.Table:
    """Edges of one range of keys: each block's pivot of a key to the least of
    all blocks' pivots."""
    rows = table.select(["bucket", "keys", "pivots", "nodes"]).to_pylist()
    edges = [np.stack([unpack(r["nodes"], np.int64), unpack(r["pivots"], np.int64)]) for r in rows if r["keys"] is None]
    rows = [r for r in rows if r["keys"] is not None]
    if rows:
        key = np.concatenate([unpack_keys(r["keys"]) for r in rows])
        of = np.concatenate([unpack(r["nodes"], np.int64)[unpack(r["pivots"], np.uint32)] for r in rows])
        order = np.lexsort((of, key))
        key, of = key[order], of[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        pivot = np.repeat(of[first], np.diff(np.append(first, len(key))))
        rest = of != pivot
        edges.append(np.stack([of[rest], pivot[rest]]))
    a, b = np.unique(np.concatenate(edges, axis=1), axis=1)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _set_batches(width: int):
    """Token set and count vector of each candidate; once for repeated rows
    that meet in a task."""
    def run(batches):
        seen: set = set()
        for b in batches:
            for at in range(0, b.num_rows, TEXT_BATCH):
                part = b.slice(at, TEXT_BATCH)
                new = [i for i, c in enumerate(part.column("cid").to_pylist()) if not (c in seen or seen.add(c))]
                if not new:
                    continue
                part = part.take(pa.array(new))
                sets = [shingle_set(w, width) for w in word_hashes(part.column("text").to_pylist())]
                at = [point(s) for s in sets]
                points = pa.array(np.concatenate(at), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid"), part.column("blob"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(range(0, GROUPS * len(sets) + 1, GROUPS), pa.int32()), points),
                     pa.array([packed_point(p) for p in at], pa.binary())],
                    ["cid", "blob", "n", "tokens", "point", "packed"])
    return run


def point(tokens: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Number of tokens per group."""
    return np.bincount((mix(tokens) % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.int32)


def fine_points(sets: list[np.ndarray]) -> np.ndarray:
    """Counts over ``FINE`` groups, a row per set, in the narrowest integers."""
    most = max((len(s) for s in sets), default=0)
    out = np.zeros((len(sets), FINE), dtype=np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)
    for i, s in enumerate(sets):
        out[i] = point(s, FINE)
    return out if out.dtype == np.uint8 or out.max(initial=0) > 255 else out.astype(np.uint8)


class CountTree:
    """Points packed by size into nodes of NODE with their upper corners."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        starts = np.arange(0, len(points), NODE)
        self.corner = np.maximum.reduceat(points, starts, axis=0)
        self.least, self.most = np.minimum.reduceat(sizes, starts), np.maximum.reduceat(sizes, starts)

    def below(self, i: int, t: Threshold) -> np.ndarray:
        """Rows before ``i`` (no larger) whose overlap bound allows a link."""
        p, n = self.points[i], self.sizes[i]
        nodes = np.arange(i // NODE + 1)
        nodes = nodes[np.minimum(self.corner[nodes], p).sum(axis=1) >= t.needs(n, self.least[nodes])]
        rows = (nodes[:, None] * NODE + np.arange(NODE)).ravel()
        rows = rows[rows < i]
        return rows[np.minimum(self.points[rows], p).sum(axis=1) >= t.needs(n, self.sizes[rows])]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def links_in(sets: list[np.ndarray], points: np.ndarray, comp: np.ndarray, side: np.ndarray, t: Threshold) -> list[tuple[int, int]]:
    """Links that join components within one tree; rows sorted by size.
    With two sides only pairs across are compared."""
    names, root = np.unique(comp, return_inverse=True)
    root = root.copy()
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    tree, fine = CountTree(points, sizes), fine_points(sets)
    two = bool(side.any())
    out = []
    for i in range(1, len(sets)):
        rows = tree.below(i, t)
        if two:
            rows = rows[side[rows] != side[i]]
        rows = rows[root[rows] != root[i]]
        if len(rows):
            rows = rows[np.minimum(fine[rows], fine[i]).sum(axis=1, dtype=np.int64) >= t.needs(sizes[i], sizes[rows])]
        while len(rows := rows[root[rows] != root[i]]):
            j, rows = rows[-1], rows[:-1]
            if overlap(sets[i], sets[j]) >= t.needs(sizes[i], sizes[j]):
                out.append((i, int(j)))
                root[root == root[j]] = root[i]
    return out


def _by_unit(work):
    """A batch function that hands ``work`` each run of rows of one (blob,
    unit), over batches; ``work`` gives a record batch or None."""
    def run(batches):
        held = None
        for b in batches:
            b = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            unit = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("blob", "unit")])
            cuts = (np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(axis=0)) + 1).tolist()
            bounds = [0, *cuts, b.num_rows]
            for lo, hi in zip(bounds[:-2], bounds[1:-1]):
                if hi - lo > 1 and (out := work(b.slice(lo, hi - lo))) is not None:
                    yield out
            held = b.slice(bounds[-2])
        if held is not None and held.num_rows > 1 and (out := work(held)) is not None:
            yield out
    return run


def _sets(part: pa.RecordBatch) -> list[np.ndarray]:
    """Token sets as views of the batch's own buffer."""
    col = part.column("tokens")
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[col.offset:col.offset + len(col) + 1]
    return [np.frombuffer(data, dtype=np.uint64, count=(hi - lo) // 8, offset=lo) if hi > lo else np.zeros(0, dtype=np.uint64)
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]


def packed_point(p: np.ndarray) -> bytes:
    """A point in the narrowest integers that hold it."""
    most = int(p.max(initial=0))
    return p.astype(np.uint8 if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def _points(part: pa.RecordBatch) -> np.ndarray:
    kinds = {GROUPS: np.dtype(np.uint8), 2 * GROUPS: np.dtype("<u2"), 4 * GROUPS: np.dtype("<u4")}
    out = np.empty((len(part), GROUPS), dtype=np.int32)
    for i, x in enumerate(part.column("packed").to_pylist()):
        out[i] = np.frombuffer(x, dtype=kinds[len(x)])
    return out


def _unit_batches(t: Threshold):
    """Rows sorted by unit, then size: the links of each unit."""
    def work(part: pa.RecordBatch):
        sets = _sets(part)
        cid, comp, side = (part.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "comp", "side"))
        out = links_in(sets, np.stack([point(s) for s in sets]), comp, side, t)
        if not out:
            return None
        a, b = (pa.array(cid[list(x)], pa.int64()) for x in zip(*out))
        return pa.RecordBatch.from_arrays([a, b], ["a", "b"])
    return _by_unit(work)


def _bound_batches(t: Threshold):
    """Rows sorted by unit, then size: those whose overlap bound allows a link
    with a row of another component."""
    def work(part: pa.RecordBatch):
        n, comp, side = (part.column(c).to_numpy(zero_copy_only=False) for c in ("n", "comp", "side"))
        tree, two = CountTree(_points(part), n), bool(side.any())
        keep = np.zeros(len(n), dtype=bool)
        for i in range(1, len(n)):
            rows = tree.below(i, t)
            rows = rows[comp[rows] != comp[i]]
            if two:
                rows = rows[side[rows] != side[i]]
            if len(rows):
                keep[i] = True
                keep[rows] = True
        if not keep.any():
            return None
        return part.select(["blob", "unit", "n", "cid", "side", "comp"]).filter(pa.array(keep))
    return _by_unit(work)


def wide_groups(n: int) -> int:
    """Groups of the wide point of a set of ``n`` tokens, a power of two."""
    return max(FINE, 1 << (n // 8).bit_length())


def folded(p: np.ndarray, groups: int) -> np.ndarray:
    """A point over fewer groups, a power of two: ``point(tokens, groups)``."""
    return p.reshape(-1, groups).sum(axis=0, dtype=np.int64)


def _wide_batches(batches):
    for b in batches:
        wide = [packed_point(point(s, wide_groups(len(s)))) for s in _sets(b)]
        yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array(wide, pa.binary())], ["cid", "wide"])


def _wide_points(part: pa.RecordBatch) -> list[np.ndarray]:
    out = []
    for n, x in zip(part.column("n").to_pylist(), part.column("wide").to_pylist()):
        out.append(np.frombuffer(x, dtype={1: np.uint8, 2: "<u2", 4: "<u4"}[len(x) // wide_groups(n)]))
    return out


def _wide_bound_batches(t: Threshold):
    """As ``_bound_batches``, with wide points: a pair is compared over the
    groups of the smaller set."""
    def work(part: pa.RecordBatch):
        n, comp, side = (part.column(c).to_numpy(zero_copy_only=False) for c in ("n", "comp", "side"))
        wide = _wide_points(part)
        fine = np.stack([folded(p, FINE) for p in wide]).astype(np.int32)
        tree, two = CountTree(np.stack([folded(p, GROUPS) for p in fine]).astype(np.int32), n), bool(side.any())
        keep = np.zeros(len(n), dtype=bool)
        for i in range(1, len(n)):
            rows = tree.below(i, t)
            rows = rows[comp[rows] != comp[i]]
            if two:
                rows = rows[side[rows] != side[i]]
            if len(rows):
                rows = rows[np.minimum(fine[rows], fine[i]).sum(axis=1) >= t.needs(n[i], n[rows])]
            for j in rows.tolist():
                if keep[i] and keep[j]:
                    continue
                if np.minimum(folded(wide[i], len(wide[j])), wide[j]).sum(dtype=np.int64) >= t.needs(int(n[i]), int(n[j])):
                    keep[i] = keep[j] = True
        if not keep.any():
            return None
        return part.select(["blob", "unit", "n", "cid", "side", "comp"]).filter(pa.array(keep))
    return _by_unit(work)


def _of(sets: DataFrame, passed: DataFrame) -> DataFrame:
    """The sets of the classes in ``passed``; they stay where they lie when
    the classes are few."""
    return sets.join(_sent(passed.select("cid").distinct()), "cid", "left_semi")


def _pivot_batches(t: Threshold):
    """Rows sorted by unit: the links of its members (side 0) with the pivots
    of its blob (side 1)."""
    def work(part: pa.RecordBatch):
        side = part.column("side").to_pylist()
        cid = part.column("cid").to_pylist()
        sets = _sets(part)
        pivots = [i for i, x in enumerate(side) if x]
        out = [(cid[i], cid[p]) for i, x in enumerate(side) if not x for p in pivots
               if cid[i] != cid[p] and overlap(sets[i], sets[p]) >= t.needs(len(sets[i]), len(sets[p]))]
        if not out:
            return None
        a, c = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], ["a", "b"])
    return _by_unit(work)


def _near_pivots(t: Threshold, held):
    """The links of every set with the pivots of its blob."""
    def run(batches):
        pivots = held.value
        for b in batches:
            out = [(c, p) for c, blob, x in zip(b.column("cid").to_pylist(), b.column("blob").to_pylist(), _sets(b))
                   for p, y in pivots.get(blob, ()) if c != p and overlap(x, y) >= t.needs(len(x), len(y))]
            if out:
                a, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], ["a", "b"])
    return run


def _pivot_links(mine: DataFrame, members: DataFrame, marks: DataFrame, t: Threshold, leaf: int, width: int) -> DataFrame:
    """(a, b): links of the members of each blob with its pivots.  Pivots of up
    to ``PIVOT_TOKENS`` tokens together go to the sets; beyond that members are
    dealt in chunks, and each chunk gets its blob's pivots."""
    pivots = mine.join(_sent(marks), ["blob", "cid"])
    if (pivots.agg(F.sum("n")).first()[0] or 0) <= PIVOT_TOKENS:
        held: dict = {}
        for r in pivots.select("blob", "cid", "tokens").toLocalIterator():
            held.setdefault(r["blob"], []).append((r["cid"], np.frombuffer(bytes(r["tokens"]), dtype=np.uint64)))
        sent = mine.sparkSession.sparkContext.broadcast({b: sorted(x, key=lambda p: p[0]) for b, x in held.items()})
        return mine.select("blob", "cid", "tokens").mapInArrow(_near_pivots(t, sent), "a long, b long")
    chunks = members.groupBy("blob").agg(F.ceil(F.count(F.lit(1)) / leaf).alias("chunks"))
    own = F.pmod(F.xxhash64("cid"), F.col("chunks"))
    dealt = mine.join(chunks, "blob").select("blob", own.alias("unit"), F.lit(0).alias("side"), "cid", "tokens")
    each = pivots.join(chunks, "blob").select(
        "blob", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("unit"), F.lit(1).alias("side"), "cid", "tokens")
    first = dealt.unionByName(each).repartition(width, "blob", "unit").sortWithinPartitions("blob", "unit", "side", "cid")
    return first.mapInArrow(_pivot_batches(t), "a long, b long")


def _candidates(rows: DataFrame, sets, t: Threshold, bits: int, spare: int) -> DataFrame:
    """(a, b): edges whose components hold every pair of sets that may link;
    ``sets`` gives the sets of a batch of ``rows``."""
    signed = rows.mapInArrow(_key_batches(sets, t, bits, spare), _SIGNED)
    spread = F.coalesce(F.col("bucket"), F.pmod(F.xxhash64("nodes"), F.lit(1 << bits)))
    return signed.withColumn("bucket_", spread).groupBy("bucket_").applyInArrow(_edge_group, "a long, b long").distinct()


_HELD = "bucket long, keys binary, holders binary, cids binary, several binary"


def _held_batches(t: Threshold, bits: int):
    """Tokens of about ``KEY_BLOCK`` at a time, told apart by blob: those one
    class of the block has, with it, and those several have.  A class's balance
    so far (bucket null) is ``whole`` for each of the latter less ``part`` for
    each of its tokens."""
    schema = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("holders", pa.binary()), ("cids", pa.binary()),
                        ("several", pa.binary())])

    def rows(sets: list, cids: list):
        names, sizes = np.array(cids, dtype=np.int64), np.array([len(s) for s in sets])
        key, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(key, kind="stable")
        key, of = key[order], of[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key)))
        shared = np.bincount(of[np.repeat(count > 1, count)], minlength=len(names))
        out = [{"holders": pack(t.whole * shared - t.part * sizes), "cids": pack(names)}]
        for bucket, lo, hi in runs(key[first], bits):
            k, one = key[first[lo:hi]], count[lo:hi] == 1
            used, local = np.unique(of[first[lo:hi]][one], return_inverse=True)
            out.append({"bucket": bucket, "keys": pack_keys(k[one]), "holders": pack(local.astype(np.uint32)),
                        "cids": pack(names[used]), "several": pack_keys(k[~one])})
        return pa.RecordBatch.from_pylist(out, schema=schema)

    def run(batches):
        sets, cids, size = [], [], 0
        for b in batches:
            of_blob = mix(b.column("blob").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            for cid, tokens, blob in zip(b.column("cid").to_pylist(), _sets(b), of_blob):
                sets.append(tokens ^ blob)
                cids.append(cid)
                size += len(tokens)
                if size >= KEY_BLOCK:
                    yield rows(sets, cids)
                    sets, cids, size = [], [], 0
        if size:
            yield rows(sets, cids)
    return run


def _balance_group(whole: int):
    """What one range of tokens adds to the balance of its classes: ``whole``
    for each token that others have too."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["keys", "holders", "cids", "several"]).to_pylist()
        own = [r for r in rows if r["keys"] is None]
        cids, adds = [unpack(r["cids"], np.int64) for r in own], [unpack(r["holders"], np.int64) for r in own]
        rows = [r for r in rows if r["keys"] is not None]
        if rows:
            key = np.concatenate([unpack_keys(r["keys"]) for r in rows])
            of = np.concatenate([unpack(r["cids"], np.int64)[unpack(r["holders"], np.uint32)] for r in rows])
            several = np.unique(np.concatenate([unpack_keys(r["several"]) for r in rows]))
            order = np.argsort(key, kind="stable")
            key, of = key[order], of[order]
            same = np.zeros(len(key) + 1, dtype=bool)
            same[1:-1] = key[1:] == key[:-1]
            cid, n = np.unique(of[same[1:] | same[:-1] | np.isin(key, several)], return_counts=True)
            cids.append(cid)
            adds.append(whole * n)
        return pa.table({"cid": pa.array(np.concatenate(cids), pa.int64()), "adds": pa.array(np.concatenate(adds), pa.int64())})
    return run


def _narrowed(large: DataFrame, t: Threshold, width: int) -> DataFrame:
    """The sets of ``large`` that may link, in the blobs they are left in.

    Linked sets are of one blob and share at least ``part`` / ``whole`` of the
    tokens of each, so a set of which others of its blob have less links with
    nothing.  Most sets of a large blob are such; the others are candidates
    among themselves only."""
    spark = large.sparkSession
    tokens = large.agg(F.sum("n")).first()[0] or 0
    bits = max(width - 1, tokens // KEY_PART).bit_length()
    held = large.select("cid", "blob", "tokens").mapInArrow(_held_batches(t, bits), _HELD)
    spread = F.coalesce(F.col("bucket"), F.pmod(F.xxhash64("cids"), F.lit(1 << bits)))
    balance = held.withColumn("bucket_", spread).groupBy("bucket_").applyInArrow(_balance_group(t.whole), "cid long, adds long")
    may = materialise(spark, balance.groupBy("cid").agg(F.sum("adds").alias("balance")).where("balance >= 0").select("cid"), "may-link")
    near = materialise(spark, large.join(_sent(may), "cid", "left_semi"), "near-sets", "zstd")
    edges = materialise(spark, _candidates(near.select("cid", "tokens"), _stored_sets, t, bits, spare_bits(tokens)), "candidates")
    blobs = connected_components(edges).select(F.col("node").alias("cid"), F.col("root").alias("blob"))
    return materialise(spark, near.drop("blob").join(_sent(blobs), "cid"), "narrow-sets", "zstd")


def _sent(ids: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``ids``, to be broadcast when there are few."""
    return F.broadcast(ids) if ids.count() <= most else ids


def _ranked(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with ``rank``, their place by size within ``keys`` in [0, 1),
    and the ``members`` and ``tokens_all`` there, from the counts per size."""
    per_n = rows.groupBy(*keys, "n").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("k").over(w.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_n = per_n.select(*keys, "n", "k", before.alias("before"), F.sum("k").over(w).alias("members"),
                         F.sum(F.col("k") * F.col("n")).over(w).alias("tokens_all"))
    inside = F.pmod(F.xxhash64("cid"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return rows.join(per_n, [*keys, "n"]).withColumn(
        "rank", (F.col("before") + inside * F.col("k")) / F.col("members")).drop("k", "before")


def _large_blobs(sets: DataFrame, big: DataFrame, t: Threshold, leaf: int, width: int) -> DataFrame:
    """Links of blobs too large for one tree.

    Places in leaves are worked out on (blob, cid, n) alone; leaf pairs first
    meet with their points, then, where the bound lets some partner pass, with
    points of about a group per four to eight tokens, and only classes that
    pass there too bring their sets."""
    spark = sets.sparkSession
    mine = sets.join(_sent(big), "blob", "left_semi")
    members = materialise(spark, _ranked(mine.select("blob", "cid", "n"), "blob").drop("members", "tokens_all"), "large-blobs")
    # Pivots at even ranks of size, so that every size has one near.
    marks = (members.groupBy("blob", F.floor(F.col("rank") * PIVOTS).alias("part"))
             .agg(F.min(F.struct(F.xxhash64("cid").alias("pick"), F.col("cid"))).alias("m")).select("blob", F.col("m.cid").alias("cid")))
    first = materialise(spark, _pivot_links(mine, members, marks, t, leaf, width), "pivot-links")
    comps = connected_components(first).withColumnRenamed("node", "cid")
    members = members.drop("rank").join(comps, "cid", "left").withColumn("comp", F.coalesce("root", "cid")).drop("root")
    # A component that fills a leaf has leaves of its own (its zone); the rest
    # of a blob shares zone -1.
    held = members.groupBy("blob", "comp").agg(F.count(F.lit(1)).alias("in_comp"))
    members = members.join(held, ["blob", "comp"]).withColumn(
        "zone", F.when(F.col("in_comp") >= leaf, F.col("comp")).otherwise(F.lit(-1))).drop("in_comp")
    leaves_of = F.greatest(F.ceil(F.col("members") / leaf), F.ceil(F.col("tokens_all") / LEAF_TOKENS))
    members = materialise(spark, _ranked(members, "blob", "zone").withColumn(
        "leaf", F.xxhash64("zone", F.floor(F.col("rank") * leaves_of))).select(
        "blob", "leaf", "zone", "members", "cid", "comp", "n"), "leaves")
    pointed = materialise(spark, members.join(mine.select("cid", "point", "packed"), "cid"), "leaf-points")
    # Leaves with the corner of their points, and each blob's largest zone.
    corners = [F.max(F.col("point")[i]).alias(f"c{i}") for i in range(GROUPS)]
    leaves = pointed.groupBy("blob", "leaf").agg(F.min("zone").alias("zone"), F.min("n").alias("n0"), F.max("n").alias("n1"), *corners)
    leaves = leaves.select("blob", "leaf", "zone", "n0", "n1", F.array(*[f"c{i}" for i in range(GROUPS)]).alias("corner"))
    main = members.where("zone >= 0").groupBy("blob").agg(F.max(F.struct("members", "zone")).alias("m")).select("blob", F.col("m.zone").alias("main"))
    leaves = materialise(spark, leaves.join(main, "blob", "left"), "corners")
    # Every pair worth comparing has a leaf outside the blob's largest zone.
    a, b = leaves.where("main IS NULL OR zone != main").alias("a"), leaves.alias("b")
    once = F.coalesce(F.col("b.zone") == F.col("b.main"), F.lit(False)) | (F.col("a.leaf") <= F.col("b.leaf"))
    apart = (F.col("a.zone") != F.col("b.zone")) | (F.col("a.zone") < 0)
    sized = (F.col("a.n1") * t.whole >= F.col("b.n0") * t.part) & (F.col("b.n1") * t.whole >= F.col("a.n0") * t.part)
    bound = F.aggregate(F.zip_with("a.corner", "b.corner", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
    meets = bound * (t.whole + t.part) >= (F.col("a.n0") + F.col("b.n0")) * t.part
    pairs = a.join(b, F.col("a.blob") == F.col("b.blob")).where(once & apart & sized & meets).select(
        F.col("a.blob").alias("blob"), F.col("a.leaf").alias("x"), F.col("b.leaf").alias("y"))
    pairs = materialise(spark, pairs.withColumn("unit", F.xxhash64("x", "y")), "leaf-pairs")
    ends = pairs.select("blob", "unit", F.col("x").alias("leaf"), F.lit(0).alias("side")).unionByName(
        pairs.where("x != y").select("blob", "unit", F.col("y").alias("leaf"), F.lit(1).alias("side")))
    order = ("blob", "unit", "n", "cid")
    units = ends.join(pointed, ["blob", "leaf"]).select(*order, "side", "comp", "packed")
    passed = units.repartition(width, "blob", "unit").sortWithinPartitions(*order).mapInArrow(
        _bound_batches(t), "blob long, unit long, n long, cid long, side int, comp long")
    passed = materialise(spark, passed, "leaf-candidates")
    # Then with points of more groups, worked out where the sets lie.
    fine = _of(mine, passed).select("cid", "n", "tokens").mapInArrow(_wide_batches, "cid long, wide binary")
    closer = passed.join(fine, "cid").select(*order, "side", "comp", "wide")
    closer = closer.repartition(width, "blob", "unit").sortWithinPartitions(*order).mapInArrow(
        _wide_bound_batches(t), "blob long, unit long, n long, cid long, side int, comp long")
    passed = materialise(spark, closer, "close-candidates")
    found = passed.join(_of(mine, passed).select("cid", "tokens"), "cid").select(*order, "side", "comp", "tokens")
    found = found.repartition(width, "blob", "unit").sortWithinPartitions(*order).mapInArrow(_unit_batches(t), "a long, b long")
    return first.unionByName(found)


def _links(sets: DataFrame, t: Threshold, leaf: int, width: int) -> DataFrame:
    """(a, b): links whose components are those of all links.  Large blobs are
    narrowed as long as that halves their leaves."""
    spark, links, before = sets.sparkSession, None, None
    while True:
        count = sets.groupBy("blob").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("all"))
        fits = (F.col("k") <= leaf) & (F.col("all") <= 2 * LEAF_TOKENS)
        leaves = F.ceil(F.greatest(F.col("k") / leaf, F.col("all") / LEAF_TOKENS))
        count = materialise(spark, count.select("blob", fits.alias("fits"), leaves.alias("leaves")), "blob-sizes")
        small = sets.join(count.where("fits").select("blob"), "blob", "left_semi")
        small = small.select("blob", F.lit(0).cast("long").alias("unit"), F.lit(0).alias("side"), "cid", F.col("cid").alias("comp"), "n", "tokens")
        found = small.repartition(width, "blob").sortWithinPartitions("blob", "unit", "n", "cid").mapInArrow(
            _unit_batches(t), "a long, b long")
        links = found if links is None else links.unionByName(found)
        big = count.where("NOT fits")
        left = big.agg(F.sum("leaves")).first()[0] or 0
        if not left:
            return links
        if left <= FEW_LEAVES or before is not None and 2 * left > before:
            return links.unionByName(_large_blobs(sets, big.select("blob"), t, leaf, width))
        sets, before = _narrowed(sets.join(_sent(big.select("blob")), "blob", "left_semi"), t, width), left


def components(docs: DataFrame, part: int = 9, whole: int = 10, shingle: int = 3, leaf: int = LEAF,
               uid: str | None = None) -> DataFrame:
    """(uid, doc_id, n_shingles, component_id, first) per row of ``docs``
    (doc_id, text): the smallest doc_id that links reach from the row, and the
    uid of the row that stands for the component.  ``uid`` names a column with
    a distinct long per row; without it one is made."""
    spark, t = docs.sparkSession, Threshold(part, whole)
    # Sets are long rows: batches of them are cut by size, unless the session has a size of its own.
    if spark.conf.get(_BATCH_BYTES) == _DEFAULT_BYTES:
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.xxhash64("text").alias("h")
    mark = F.col(uid) if uid else F.monotonically_increasing_id()
    rows = docs.select(mark.alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), hashed, "text")
    sketch = materialise(spark, rows.mapInArrow(
        _sketch_batches(shingle), "uid long, doc_id long, h long, n long, digest binary, node long"), "sketch")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    classes = materialise(spark, sketch.where("n > 0").groupBy("digest").agg(
        F.min(F.struct("uid", "doc_id", "h", "node")).alias("c"), best.alias("best")).select(
        "digest", F.col("c.uid").alias("cid"), F.col("c.doc_id").alias("want_id"), F.col("c.h").alias("want_h"),
        F.col("c.node").alias("node"), "best"), "classes")
    tokens = sketch.agg(F.sum("n")).first()[0] or 0
    bits = max(width - 1, tokens // KEY_PART).bit_length()
    edges = materialise(spark, _candidates(docs.select("text"), _text_sets(shingle), t, bits, spare_bits(tokens)), "candidates")
    blobs = connected_components(edges).select("node", F.col("root").alias("blob"))
    wanted = materialise(spark, classes.join(blobs, "node").select("cid", "blob", "want_id", "want_h"), "wanted")
    wanted = _sent(wanted)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), hashed, "text")
             .join(wanted, F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("h") == F.col("want_h")))
             .select("cid", "blob", "text"))
    sets = materialise(spark, texts.mapInArrow(
        _set_batches(shingle), "cid long, blob long, n long, tokens binary, point array<int>, packed binary"), "sets", "zstd")
    links = _links(sets, t, leaf, width)
    roots = connected_components(materialise(spark, links, "links")).select(F.col("node").alias("cid"), "root")
    joined = classes.select("digest", "cid", "best").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    firsts = joined.groupBy("root").agg(F.min("best").alias("best_of"))
    named = materialise(spark, joined.join(firsts, "root").select(
        "digest", F.col("best_of.doc_id").alias("component"), F.col("best_of.uid").alias("first")), "components")
    out = sketch.select("uid", "doc_id", F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left")
    alone = F.col("first").isNull()
    return out.select("uid", "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
                      F.coalesce("first", "uid").alias("first"))


def near_duplicates(docs: DataFrame, part: int = 9, whole: int = 10, shingle: int = 3, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row."""
    return components(docs, part, whole, shingle, leaf).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, part: int = 9, whole: int = 10, shingle: int = 3, leaf: int = LEAF) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    doc_id (of repeated rows, one).  All columns are kept."""
    uid = spare(docs.columns, "row_uid")
    stored = materialise(docs.sparkSession, docs.withColumn(uid, F.monotonically_increasing_id()), "documents", "zstd")
    found = components(stored, part, whole, shingle, leaf, uid)
    goes = materialise(docs.sparkSession, found.where("uid != first").select(F.col("uid").alias(uid)), "dropped")
    return stored.join(_sent(goes, DROP_ROWS), uid, "left_anti").select(docs.columns)
