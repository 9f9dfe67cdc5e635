"""Harmonic packing of token sequences.

A piece of length l belongs to class k = capacity // l: pieces in
(capacity/(k+1), capacity/k].  Every bin of class k holds exactly k pieces of
that class, so a bin is known from a piece's rank within its class and all
bins of all classes are filled at once, without looking at each other.

Classic harmonic bins waste what separates a piece from capacity/k.  Here a
document may be cut, so its last, short stretch is cut down to capacity/(k+1)
whenever that gap exceeds ``1/SLACK`` of the slot; the rest goes on to a
finer class.  Each class leaves one bin that is not full; those few pieces
(fewer than k per class, about 10,000 in all for 2,048 whatever the input) are
packed together, longest first.

Edge cases: null or empty text is the end token alone; repeated rows are
packed each for itself; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.bpe import default_tokenizer, encoder
from barlake.llm.storage import materialise

SLACK = 64
#: Ranks are counted within this many groups of pieces per class at least, and
#: more when a group would hold over RANK_ROWS pieces on average.
RANK_GROUPS = 16
RANK_ROWS = 500_000
TOKEN_BATCH = 512

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, "
          "ids binary")


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces a document of ``n`` tokens is cut into."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        slot = capacity // k
        if (slot - rest) * SLACK <= slot:
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def _piece_batches(path: str, capacity: int, end_id: int, with_ids: bool):
    end = struct.pack("<I", end_id)

    def run(batches):
        enc = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, TOKEN_BATCH):
                part = b.slice(at, TOKEN_BATCH)
                rows: list[tuple] = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text").to_pylist())):
                    ids += end
                    n, start = len(ids) // 4, 0
                    for length in cut_lengths(n, capacity):
                        cut = ids[4 * start:4 * (start + length)]
                        rows.append((doc, start, length, zlib.crc32(cut), n, capacity // length,
                                     cut if with_ids else None))
                        start += length
                cols = list(zip(*rows)) if rows else [[]] * 7
                types = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "ids"])
    return run


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 1,
                 with_ids: bool = False) -> DataFrame:
    """The pieces of every document, each id in exactly one piece; ``ids``
    (little-endian uint32) only on request."""
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return text.mapInArrow(_piece_batches(tokenizer or default_tokenizer(), capacity, end_id, with_ids), PIECES)


def _last_bins(capacity: int):
    """First fit, longest first, over the few pieces of the unfilled bins."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "piece"], ascending=[False, True], kind="stable")
        room: np.ndarray = np.zeros(0, dtype=np.int64)
        bins, offsets = [], []
        for length in pdf["length"].to_numpy():
            fits = np.flatnonzero(room >= length)
            if len(fits) == 0:
                room = np.append(room, capacity)
                fits = [len(room) - 1]
            b = fits[0]
            bins.append(b)
            offsets.append(capacity - room[b])
            room[b] -= length
        return pd.DataFrame({"piece": pdf["piece"].to_numpy(), "sequence_id": np.array(bins, dtype=np.int64) * (capacity + 1),
                             "offset": np.array(offsets, dtype=np.int64)})
    return run


def harmonic_pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length`` and ``class``.

    Ranks within a class come from two levels: row numbers within
    (class, group of pieces) and the groups' sizes added up, so a class that
    holds most pieces is spread over the groups.  ``sequence_id`` is
    bin * (capacity + 1) + class; class 0 stands for the shared last bins.
    """
    spark = pieces.sparkSession
    stored = materialise(spark, pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    groups = max(RANK_GROUPS, -(-stored.count() // RANK_ROWS))
    slots = stored.select("piece", "length", "class", F.pmod(F.xxhash64("piece"), F.lit(groups)).alias("grp"))
    sizes = slots.groupBy("class", "grp").agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy("class")
    before = by_class.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("class", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                         F.sum("n").over(by_class).alias("total"))
    ranked = (slots.withColumn("rn", F.row_number().over(Window.partitionBy("class", "grp").orderBy("piece")))
              .join(sizes, ["class", "grp"])
              .withColumn("rank", F.col("base") + F.col("rn") - 1)
              .withColumn("bin", F.expr("rank div class")))
    ranked = materialise(spark, ranked.select("piece", "length", "class", "bin",
                                              (F.col("bin") >= F.expr("total div class")).alias("open")), "ranks")
    in_bin = Window.partitionBy("class", "bin").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    full = ranked.where("NOT open").select(
        "piece", (F.col("bin") * (capacity + 1) + F.col("class")).alias("sequence_id"),
        F.coalesce(F.sum("length").over(in_bin), F.lit(0)).alias("offset"))
    last = (ranked.where("open").select("piece", "length", F.lit(0).alias("one")).groupBy("one")
            .applyInPandas(_last_bins(capacity), "piece long, sequence_id long, offset long"))
    return stored.join(full.unionByName(last), "piece").drop("piece")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 1,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences."""
    packed = harmonic_pack(token_pieces(docs, tokenizer, capacity, end_id, with_ids), capacity)
    return packed if with_ids else packed.drop("ids")


def sequences(packed: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids array, n_tokens): the packed id sequences, padded to
    ``capacity`` unless their length is a power of two.  Needs ``with_ids``;
    a sequence holds at most ``capacity`` ids."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.frombuffer(x, dtype="<u4") for x in pdf.sort_values("offset")["ids"]])
        n = len(ids)
        if n & (n - 1):
            ids = np.concatenate([ids, np.full(capacity - n, pad_id, dtype="<u4")])
        return pd.DataFrame({"sequence_id": [pdf["sequence_id"].iloc[0]], "ids": [ids.astype(np.int64)], "n_tokens": [n]})
    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(
        build, "sequence_id long, ids array<long>, n_tokens long")
