"""Near-duplicate embeddings: random-hyperplane signs in several tables,
exact cosine, connected components.

Equal vectors with equal labels form one class and enter the search once, with
the number of their copies.  Each class gets a sign code per table; classes
that share (label, dimension, table, code) meet in a bucket, where all
cosines are taken in double precision.  A pair counts only in the first table
that brings it together, so links add up without a list of pairs; for the
components each bucket gives a spanning forest of the links it found.

A bucket of more than ``BLOCK`` classes is dealt in blocks, and each pair of
blocks is one unit of work, so no task holds a whole large bucket.

Signs per table grow with the logarithm of the number of vectors, so that a
bucket of unlike vectors stays small, and the number of tables follows from the
signs: two vectors of the least cosine share a bucket of one of them with
probability ``RECALL``, closer ones with more (``plan``; 16 tables of 12 signs
at 0.98 up to 65,536 vectors).

Edge cases: vectors that are null, empty, zero or hold null or non-finite
values, and rows without a label, link with nothing and are their own
component; vectors of different length never link; repeated rows are vectors
of their own (``kept`` is then true for each row with the smallest id); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.components import connected_components
from barlake.llm.storage import materialise

#: Chance that a pair of the least cosine meets in some table.
RECALL = 0.9999
#: Signs of a table at least, and at most.
LEAST_BITS, MOST_BITS = 12, 30
BLOCK = 1024
SEED = 20240
_NORMALS: dict = {}


def plan(n: int, least: float) -> tuple[int, int]:
    """(tables, signs of each) for ``n`` vectors and pairs of cosine ``least``:
    about 16 unlike vectors a bucket."""
    bits = min(max(LEAST_BITS, max(n - 1, 1).bit_length() - 4), MOST_BITS)
    agree = (1 - math.acos(min(max(least, -1.0), 1.0)) / math.pi) ** bits
    return 1 if agree >= RECALL else math.ceil(math.log(1 - RECALL) / math.log1p(-agree)), bits


def _normals(dim: int, tables: int, bits: int) -> np.ndarray:
    key = (dim, tables, bits)
    if key not in _NORMALS:
        _NORMALS[key] = np.random.default_rng([SEED, *key]).standard_normal((dim, tables * bits))
    return _NORMALS[key]


def _valid(v) -> bool:
    return v is not None and len(v) > 0 and bool(np.isfinite(v).all()) and bool(v.any())


def _code_batches(tables: int, bits: int):
    """Digest, dimension, vector bytes (float64) and sign codes of each valid row."""
    weights = 1 << np.arange(bits)
    schema = pa.schema([("uid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()),
                        ("digest", pa.binary()), ("vector", pa.binary()), ("codes", pa.binary())])

    def run(batches):
        for b in batches:
            rows, by_dim = [], {}
            for uid, vec_id, label, values in zip(b.column("uid").to_pylist(), b.column("vec_id").to_pylist(),
                                                  b.column("label").to_pylist(), b.column("embedding").to_pylist()):
                v = None if values is None or None in values else np.array(values, dtype=np.float64)
                ok = label is not None and _valid(v)
                rows.append({"uid": uid, "vec_id": vec_id, "label": label if ok else None})
                if ok:
                    v += 0.0  # one zero, whatever its sign
                    rows[-1] |= {"dim": len(v), "digest": hashlib.md5(v.tobytes()).digest(), "vector": v.tobytes()}
                    by_dim.setdefault(len(v), []).append((len(rows) - 1, v))
            for dim, some in by_dim.items():
                m = np.stack([v for _, v in some])
                m = m / np.abs(m).max(axis=1, keepdims=True)
                signs = (m @ _normals(dim, tables, bits) > 0).reshape(len(some), tables, bits)
                codes = (signs @ weights).astype("<i4")
                for (i, _), c in zip(some, codes):
                    rows[i]["codes"] = c.tobytes()
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def _units(m: np.ndarray, mult: np.ndarray, codes: np.ndarray, side: np.ndarray, table: int, least: float):
    """Links (per row: copies of the classes it links with, first meetings
    only) and a spanning forest of one unit."""
    cos = m @ m.T
    near = cos >= least
    np.fill_diagonal(near, False)
    if side.any():
        near &= side[:, None] != side[None, :]
    if not near.any():
        return None, []
    links = np.zeros(len(m), dtype=np.int64)
    for i in np.flatnonzero(near.any(axis=1)):
        js = np.flatnonzero(near[i])
        if table:
            js = js[~(codes[js, :table] == codes[i, :table]).any(axis=1)]
        links[i] = mult[js].sum()
    seen, forest = np.zeros(len(m), dtype=bool), []
    for root in np.flatnonzero(near.any(axis=1)):
        if seen[root]:
            continue
        seen[root], stack = True, [root]
        while stack:
            u = stack.pop()
            new = np.flatnonzero(near[u] & ~seen)
            seen[new] = True
            forest += [(u, v) for v in new]
            stack += new.tolist()
    return links, forest


def _bucket_batches(least: float):
    """Rows sorted by (key, unit): finds links unit by unit, over batches."""
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def work(b: pa.RecordBatch, lo: int, hi: int, out: list):
        part = b.slice(lo, hi - lo)
        table = part.column("tab")[0].as_py()
        m = np.stack([np.frombuffer(x, dtype=np.float64) for x in part.column("vector").to_pylist()])
        m = m / np.abs(m).max(axis=1, keepdims=True)
        m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
        codes = np.stack([np.frombuffer(x, dtype="<i4") for x in part.column("codes").to_pylist()])
        cid, mult = (part.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "n"))
        links, forest = _units(m, mult, codes, part.column("side").to_numpy(zero_copy_only=False).astype(bool), table, least)
        if links is not None:
            out += [(0, int(cid[i]), int(links[i])) for i in np.flatnonzero(links)]
            out += [(1, int(cid[u]), int(cid[v])) for u, v in forest]

    def run(batches):
        held = None
        for b in batches:
            b = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            key, unit = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "unit"))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (unit[1:] != unit[:-1])) + 1
            bounds = [0, *cuts.tolist(), b.num_rows]
            out: list[tuple] = []
            for lo, hi in zip(bounds[:-2], bounds[1:-1]):
                if hi - lo > 1:
                    work(b, lo, hi, out)
            held = b.slice(bounds[-2])
            yield from _rows(out)
        out = []
        if held is not None and held.num_rows > 1:
            work(held, 0, held.num_rows, out)
        yield from _rows(out)

    def _rows(out):
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
    return run


def near_duplicates(vectors: DataFrame, least: float = 0.98, tables: int | None = None, bits: int | None = None,
                    block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``
    (vec_id, embedding, label); ``tables`` and ``bits`` as planned unless given."""
    spark = vectors.sparkSession
    if tables is None or bits is None:
        tables, bits = plan(vectors.count(), least)
    rows = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    coded = materialise(spark, rows.mapInArrow(
        _code_batches(tables, bits),
        "uid long, vec_id long, label long, dim int, digest binary, vector binary, codes binary"), "vectors")
    same = ["label", "dim", "digest"]
    sized = coded.where("digest IS NOT NULL").groupBy(*same).agg(
        F.min("uid").alias("cid"), F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("n"))
    sized = materialise(spark, sized, "classes")
    entries = (coded.select(F.col("uid").alias("cid"), "label", "dim", "vector", "codes")
               .join(sized.select("cid", "n"), "cid")
               .withColumn("tab", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))))
               .withColumn("code", F.expr("hex(substring(codes, tab * 4 + 1, 4))"))
               .withColumn("key", F.xxhash64("label", "dim", "tab", "code"))
               .select("key", "tab", "cid", "n", "vector", "codes"))
    counts = (coded.join(sized.select(F.col("cid").alias("uid")), "uid", "left_semi")
              .withColumn("tab", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))))
              .withColumn("code", F.expr("hex(substring(codes, tab * 4 + 1, 4))"))
              .groupBy(F.xxhash64("label", "dim", "tab", "code").alias("key")).agg(F.count(F.lit(1)).alias("members")))
    held = materialise(spark, counts.where("members > 1").select(
        "key", F.expr(f"cast(ceil(members / {block}) AS int)").alias("blocks")), "buckets")
    own = F.expr("cast(pmod(xxhash64(cid), blocks) AS int)")
    placed = entries.join(held, "key").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(
        "key", "tab", "cid", "n", "vector", "codes", (F.col("own") > F.col("other")).cast("int").alias("side"),
        (F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other")).alias("unit"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(width, "key", "unit").sortWithinPartitions("key", "unit")
    found = materialise(spark, dealt.mapInArrow(_bucket_batches(least), "kind int, a long, b long"), "links")
    links = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("links"))
    comps = connected_components(found.where("kind = 1").select("a", "b")).withColumnRenamed("node", "cid")
    classes = sized.join(links, "cid", "left").join(comps, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    classes = materialise(spark, classes, "linked-classes")
    smallest = classes.groupBy("root").agg(F.min("least_id").alias("component"))
    classes = classes.join(smallest, "root").select(*same, "n", "links", "component")
    out = coded.select("vec_id", *same).join(classes, same, "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
