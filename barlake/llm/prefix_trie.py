"""The trie of conversation prefixes, with subtree totals by time-forward
processing (Chiang et al., "External-memory graph algorithms", 1995).

``rebuild`` gives every conversation the first turns of its block's first one.
A node is a distinct sequence of the first d turns; its id is the exclusive or
of 128-bit hashes of (place, turn), so that a running total over a
conversation names all its prefixes, whatever its length.  Two of n different
sequences share an id with probability about n * n / 2**129.

Totals of subtrees.  Nodes are sorted in reverse level order; each sends its
totals to its parent through a queue ordered like the nodes, which keeps a
bounded number of messages in memory and spills sorted runs beyond that.  A
shard is a range of nodes by (smallest member, depth), which keeps a
conversation's own nodes together, splits a very long one and no hot prefix
fills it.  Messages for a parent in another shard are added up per parent.
They, the nodes that get them, and the nodes where their ways meet form a
smaller tree, the tree of shard roots; it is processed the same way, shard by
shard, until it fits one shard (``subtree_totals``).  What arrives at a node
from other shards is then added to the nodes above it in its shard: each
remembers the one vertex of the smaller tree that lies next below.

Skew.  Places in a conversation and running hashes come from ranges of rows
(``running``), node members from partial aggregates, and values of a parent
reach its children by (parent, shard), so neither a conversation nor a prefix
with most of all rows fills a task.  The ids that end at a node are sorted in
ranges and joined to pieces in parallel; only the digest of a node's pieces
is taken in one stream, as SHA-256 demands, a piece at a time.

Spilled runs go to Spark's local folders (``SPARK_LOCAL_DIRS``), like Spark's
own spills: they belong to one task attempt, which makes them anew.

Edge cases: null roles and texts are empty; a null turn comes first; rows of
equal turn are ordered by the digest of role and text, repeated rows are turns
of their own; rows without a conv_id belong to no conversation; an empty table
gives no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.running import in_ranges, range_totals, upto
from barlake.llm.storage import materialise

BLOCK = 100
HEADS = 6
ROOT = bytes(16)
#: Nodes of a shard, about.
SHARD = 20_000
#: Messages a queue keeps in memory, and targets in other shards that a shard
#: adds up at once.
IN_MEMORY = 100_000
#: Characters of a piece of ids that end at a node.
PIECE = 1 << 14


# --- conversations to prefixes ---------------------------------------------------

def _id(a: Column, b: Column) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over from its block's first one."""
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, turn_id, points) of the turns of all rebuilt
    conversations, and (conv_id, turns) of all of them."""
    spark = conversations.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", content.alias("turn_id"), F.length(text).cast("long").alias("points"),
        F.monotonically_increasing_id().alias("uid"))
    order = [F.col("turn").asc_nulls_first(), F.col("turn_id").asc(), F.col("uid").asc()]
    ranged = in_ranges(rows, ["conv_id"], order, "turn-order")
    starts = range_totals(ranged, ["conv_id"], F.lit(1))
    convs = starts.groupBy("conv_id").agg(F.sum("total").alias("turns"))
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    convs = materialise(spark, convs.select("conv_id", "turns", base.alias("base"), shared_turns(F.col("conv_id")).alias("h")), "conversations")
    firsts = convs.where("conv_id = base").select("base", F.col("turns").alias("base_turns"))
    convs = convs.join(firsts, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
    own = starts.join(convs.select("conv_id", "h", "taken"), "conv_id").select(
        "conv_id", "range_no", F.coalesce("before", F.lit(0)).alias("first"), "h", "taken")
    placed = ranged.join(own, ["conv_id", "range_no"]).withColumn(
        "i", F.col("first") + F.count(F.lit(1)).over(upto(["conv_id"], order)) - 1)
    placed = materialise(spark, placed.select("conv_id", "i", "h", "taken", "turn_id", "points"), "places")
    kept = placed.where("i >= h").select("conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("place"), "turn_id", "points")
    # A block has at most BLOCK conversations and its first HEADS - 1 turns are shared.
    heads = placed.where(F.col("i") < HEADS - 1).select(F.col("conv_id").alias("base"), "i", "turn_id", "points")
    given = convs.select("conv_id", "base", "h").join(heads, "base").where("i < h").select(
        "conv_id", F.col("i").alias("place"), "turn_id", "points")
    return kept.unionByName(given), convs.select(
        "conv_id", (F.col("taken") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("turns"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, id, parent, points) of every turn: the prefix that ends
    with it and the one before."""
    salted = turns.select("conv_id", "place", "points", F.xxhash64(F.lit(1), "place", "turn_id").alias("g1"),
                          F.xxhash64(F.lit(2), "place", "turn_id").alias("g2"))
    order = [F.col("place").asc()]
    ranged = in_ranges(salted, ["conv_id"], order, "rebuilt-turns")
    fold = F.bit_xor
    before = None
    for g in ("g1", "g2"):
        t = range_totals(ranged, ["conv_id"], F.col(g), fold).select(
            "conv_id", "range_no", F.coalesce("before", F.lit(0).cast("long")).alias(f"{g}_before"))
        before = t if before is None else before.join(t, ["conv_id", "range_no"])
    w = upto(["conv_id"], order)
    run = [F.col(f"{g}_before").bitwiseXOR(fold(g).over(w)).alias(f"h{g}") for g in ("g1", "g2")]
    rows = ranged.join(before, ["conv_id", "range_no"]).select("conv_id", "place", "points", "g1", "g2", *run)
    return rows.select("conv_id", (F.col("place") + 1).alias("depth"), _id(F.col("hg1"), F.col("hg2")).alias("id"),
                       _id(F.col("hg1").bitwiseXOR(F.col("g1")), F.col("hg2").bitwiseXOR(F.col("g2"))).alias("parent"), "points")


# --- queues ------------------------------------------------------------------------

class SpillingQueue:
    """Messages ordered by key, at most ``limit`` of them in memory; beyond
    that they are written as a sorted run, read back a message at a time."""

    def __init__(self, limit: int = IN_MEMORY):
        self.limit, self.heap, self.heads, self.sent = limit, [], [], 0

    def push(self, key, value):
        if len(self.heap) >= self.limit:
            self._spill()
        self.sent += 1
        heapq.heappush(self.heap, (key, self.sent, value))

    def _spill(self):
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        run = tempfile.TemporaryFile(dir=folder)
        for key, _, value in sorted(self.heap):
            pickle.dump((key, value), run)
        run.seek(0)
        self.heap = []
        self._next(run)

    def _next(self, run):
        try:
            key, value = pickle.load(run)
        except EOFError:
            run.close()
            return
        heapq.heappush(self.heads, (key, id(run), value, run))

    def take(self, key):
        """The values sent to ``key``; keys must be asked in order."""
        while self.heap and self.heap[0][0] == key:
            yield heapq.heappop(self.heap)[2]
        while self.heads and self.heads[0][0] == key:
            _, _, value, run = heapq.heappop(self.heads)
            yield value
            self._next(run)


# --- subtree totals -----------------------------------------------------------------

_VERTEX = "id binary, parent binary, level long, parent_level long, a long, b long, leaves long, saved long"
_FOUND = pa.schema([("kind", pa.int32()), ("id", pa.binary()), ("parent", pa.binary()), *[(c, pa.int64()) for c in (
    "level", "parent_level", "a", "b", "leaves", "saved", "parent_a")], ("below", pa.binary())])
_READ = ("range_no", "id", "parent", "level", "parent_level", "a", "b", "leaves", "saved", "parent_a", "parent_range", "port")


class Shard:
    """One shard, vertex by vertex in reverse level order.

    ``out`` gets rows of kind 0, a vertex with its totals within the shard and
    ``below``, and of kind 1, the smaller tree: ports (vertices with children
    in other shards) and junctions of their ways, which bring nothing of
    their own, and groups, the sums for one parent in another shard."""

    def __init__(self, number: int, depth: int, limit: int):
        self.number, self.depth, self.limit = number, depth, limit
        self.queue, self.groups, self.made = SpillingQueue(limit), {}, 0

    def vertex(self, row, out: list):
        _, id_, parent, level, parent_level, a, b, leaves, saved, parent_a, parent_shard, port = row
        ways = []
        for more_leaves, more_saved, way in self.queue.take((-level, id_)):
            leaves, saved = leaves + more_leaves, saved + more_saved
            if way:
                ways.append(way)
        if port or len(ways) > 1:
            self._join(ways, id_, 2 * level, out)
            ways = [(id_, 2 * level, a, b)]
        way = ways[0] if ways else None
        out.append((0, id_, parent, level, parent_level, a, b, leaves, saved, parent_a, way and way[0]))
        if parent is None:
            self._join(ways, None, None, out)
        elif parent_shard == self.number:
            self.queue.push((-parent_level, parent), (leaves, saved, way))
        else:
            if parent not in self.groups:
                if len(self.groups) >= self.limit:
                    self.close(out)
                self.made += 1
                name = hashlib.md5(f"{self.depth}:{self.number}:{self.made}".encode()).digest()
                self.groups[parent] = [name, 2 * parent_level, a, b, 0, 0]
            group = self.groups[parent]
            group[4] += leaves
            group[5] += saved
            self._join(ways, group[0], group[1] + 1, out)

    @staticmethod
    def _join(ways: list, parent, parent_level, out: list):
        out += [(1, id_, parent, level, parent_level, a, b, 0, 0, None, None) for id_, level, a, b in ways]

    def close(self, out: list):
        out += [(1, name, target, at + 1, at, a, b, leaves, saved, None, None)
                for target, (name, at, a, b, leaves, saved) in self.groups.items()]
        self.groups = {}


def _forward_batches(depth: int, limit: int):
    """Vertices sorted by shard, level descending, id."""
    def run(batches):
        shard = None
        for b in batches:
            out: list = []
            for row in zip(*(b.column(c).to_pylist() for c in _READ)):
                if shard is None or shard.number != row[0]:
                    if shard:
                        shard.close(out)
                    shard = Shard(row[0], depth, limit)
                shard.vertex(row, out)
            yield _found(out)
        out = []
        if shard:
            shard.close(out)
        yield _found(out)
    return run


def _found(out: list) -> pa.RecordBatch:
    cols = zip(*out) if out else [[]] * len(_FOUND)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _FOUND)], schema=_FOUND)


def subtree_totals(tree: DataFrame, shard: int = SHARD, limit: int = IN_MEMORY, depth: int = 0) -> DataFrame:
    """(id, parent_a, leaves, saved) per vertex of ``tree`` (id, parent, level,
    parent_level, a, b, leaves, saved): sums over its subtree, and ``a`` of its
    parent.  Shards are ranges of (a, b, id); those of the tree of shard roots
    hold four times as many vertices, and so on, so the last is one shard."""
    spark = tree.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-tree.count() // shard))
    ranged = in_ranges(tree, [], [F.col("a").asc(), F.col("b").asc(), F.col("id").asc()], f"shards-{depth}", shards)
    asked = ranged.where("parent IS NOT NULL").select("parent", "range_no").distinct()
    known = materialise(spark, asked.join(ranged.select(
        F.col("id").alias("parent"), F.col("range_no").alias("parent_range"), F.col("a").alias("parent_a")), "parent"), f"parents-{depth}")
    ports = known.where("range_no != parent_range").select(F.col("parent").alias("id"), F.lit(True).alias("port")).distinct()
    linked = ranged.join(known, ["parent", "range_no"], "left").join(ports, "id", "left")
    linked = linked.withColumn("port", F.coalesce("port", F.lit(False))).select(*_READ)
    dealt = linked.repartition(min(shards, width), "range_no").sortWithinPartitions("range_no", F.col("level").desc(), "id")
    found = materialise(spark, dealt.mapInArrow(
        _forward_batches(depth, limit), f"kind int, {_VERTEX}, parent_a long, below binary"), f"totals-{depth}")
    own = found.where("kind = 0").select("id", "parent_a", "leaves", "saved", "below")
    if shards == 1:
        return own.drop("below")
    smaller = found.where("kind = 1").select("id", "parent", "level", "parent_level", "a", "b", "leaves", "saved")
    arrived = subtree_totals(smaller, 4 * shard, limit, depth + 1).select(
        F.col("id").alias("below"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    added = own.join(arrived, "below", "left")
    more = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
    return added.select("id", "parent_a", more("leaves"), more("saved"))


# --- ends ------------------------------------------------------------------------------

_PIECES = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("text", pa.string())])


def _piece_batches(piece: int):
    """Rows sorted by (id, conv_id): comma-joined ids in pieces of one node."""
    def run(batches):
        held, first, parts, size = None, None, [], 0
        for b in batches:
            out = []
            for id_, conv in zip(b.column("id").to_pylist(), b.column("conv_id").to_pylist()):
                if parts and (id_ != held or size >= piece):
                    out.append((held, first, ",".join(parts)))
                    parts, size = [], 0
                if not parts:
                    held, first = id_, conv
                parts.append(str(conv))
                size += len(parts[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([first]), pa.array([",".join(parts)])], schema=_PIECES)
    return run


def _digest_batches(batches):
    """Pieces sorted by (id, first): the digest of each node's ids."""
    held, digest = None, None
    for b in batches:
        out = []
        for id_, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
            if id_ == held:
                digest.update(b",")
            else:
                if held is not None:
                    out.append((held, digest.hexdigest()))
                held, digest = id_, hashlib.sha256()
            digest.update(text.encode())
        yield pa.RecordBatch.from_pylist([{"id": i, "ends_sha256": d} for i, d in out], schema=_DIGESTS)
    if held is not None:
        yield pa.RecordBatch.from_pylist([{"id": held, "ends_sha256": digest.hexdigest()}], schema=_DIGESTS)


_DIGESTS = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(id, ends_sha256) of the nodes at which conversations end."""
    width = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ends.repartitionByRange(width, "id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(
        _piece_batches(piece), "id binary, first long, text string")
    return pieces.repartition(width, "id").sortWithinPartitions("id", "first").mapInArrow(_digest_batches, "id binary, ends_sha256 string")


# --- the trie ----------------------------------------------------------------------------

def prefix_trie(conversations: DataFrame, shard: int = SHARD, limit: int = IN_MEMORY, piece: int = PIECE) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, id) per node of the trie of the rebuilt
    ``conversations`` (conv_id, turn, role, text)."""
    spark = conversations.sparkSession
    turns, convs = rebuild(conversations)
    convs = materialise(spark, convs, "rebuilt")
    members = materialise(spark, prefixes(turns), "prefixes")
    nodes = members.groupBy("id").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("points").alias("points"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("points"))
    nodes = materialise(spark, nodes.unionByName(root), "nodes")
    fan = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(spark, nodes.join(fan, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "fanned-nodes")
    tree = nodes.select("id", "parent", F.col("depth").alias("level"), (F.col("depth") - 1).alias("parent_level"), F.col("conv_id").alias("a"),
                        F.col("depth").alias("b"), (F.col("n_children") == 0).cast("long").alias("leaves"),
                        ((F.col("n_convs") - 1) * F.col("points")).alias("saved"))
    totals = subtree_totals(tree, shard, limit)
    ends = members.groupBy("conv_id").agg(F.max(F.struct("depth", "id")).alias("end")).select(F.col("end.id").alias("id"), "conv_id")
    ends = ends.unionByName(convs.where("turns = 0").select(F.lit(ROOT).alias("id"), "conv_id"))
    out = nodes.join(totals, "id").join(end_digests(ends, piece), "id", "left")
    return out.select("conv_id", "depth", F.col("parent_a").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "id")
