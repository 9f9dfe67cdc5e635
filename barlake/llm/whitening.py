"""Whitening of embeddings by shifted Cholesky QR (Fukaya et al., "Shifted
Cholesky QR for computing the QR factorization of ill-conditioned matrices",
2020).

The centred rows A are never moved.  A pass sums the Gram matrix of A times
the inverse of the factors so far; its Cholesky factor R, with a shift on the
diagonal in the first pass, orthogonalises the rows further by a triangular
solve inside the next pass.  After a few passes the rows are orthogonal to
rounding, and the product of the factors, R_k ... R_2 R_1, is the R of A.  The
singular value decomposition of that small R gives the components: the right
vectors are the unit eigenvectors of the covariance, the squared singular
values over n its eigenvalues.  No eigenvalue is ever taken from a squared
matrix, so small ones keep their digits.

Each pass gives one partial Gram matrix per task; these are added up by groups
of about the square root of their number before the driver sees them, so the
driver gets at most that many matrices of dim x dim.  Integer sums are exact.

Edge cases: vectors that are null, or hold null or non-finite entries, give no
rows; neither do empty ones.  Vectors of different length are whitened apart
from each other, each length by its own fit list.  Entries whose 64-fold lies
beyond +-2**40 count as that bound.  A direction without variance (constant
entries, fewer rows than dimensions, a single row) has no component, so a
length may have fewer than ``components``, down to none, and then fewer rows;
``deviation`` is null where it exceeds a long.  Repeated rows and ids give a
row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.storage import materialise

COMPONENTS = 32
SCALE, OFFSET, BOUND = 64, 1_000_000, 1 << 40
#: Gram passes at most: one shifted, then until the rows are orthogonal within
#: rounding, which takes two or three.
PASSES = 8
#: Singular values of this share of the norm count as none.
FLOOR = 1e-9
#: Rows a task multiplies at once.
BLOCK = 8192
EPS = np.finfo(np.float64).eps
#: Largest long.
_LONG = 2**63 - 1


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, x): entries as floor(64 c) + 1,000,000 of each row whose
    vector is whole."""
    c = F.col("embedding").cast("array<double>")
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    step = lambda v: (F.floor(F.greatest(F.least(v * SCALE, F.lit(float(BOUND))), F.lit(-float(BOUND)))) + OFFSET).cast("long")
    rows = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), F.transform(c, step).alias("x"))


def _by_dim(batch: pa.RecordBatch):
    """(dim, places in the batch, matrix of their entries)."""
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    x = batch.column("x")
    flat, starts = x.flatten().to_numpy(zero_copy_only=False), x.offsets.to_numpy()[:-1] - x.offsets[0].as_py()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        for lo in range(0, len(at), BLOCK):
            some = at[lo:lo + BLOCK]
            yield int(dim), some, flat[starts[some][:, None] + np.arange(dim)]


def _sum_batches(batches):
    """Rows and exact sums per entry, of a task (sums as text: they may exceed
    a long)."""
    n: dict = {}
    sums: dict = {}
    for b in batches:
        for dim, at, m in _by_dim(b):
            n[dim] = n.get(dim, 0) + len(at)
            part = m.sum(axis=0).astype(object)
            sums[dim] = part if dim not in sums else sums[dim] + part
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64()),
                                          pa.array([[str(v) for v in sums[d]] for d in n], pa.list_(pa.string()))], ["dim", "n", "sums"])


def fit_list(whole: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """{dim: (n, sum of each entry)}, exact."""
    parts = whole.mapInArrow(_sum_batches, "dim int, n long, sums array<string>")
    counts = {r["dim"]: r["n"] for r in parts.groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    per_entry = parts.select("dim", F.posexplode("sums").alias("i", "s")).groupBy("dim", "i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums: dict[int, list[int]] = {d: [0] * d for d in counts}
    for r in per_entry.collect():
        sums[r["dim"]][r["i"]] = int(r["s"])
    return {d: (counts[d], sums[d]) for d in counts}


def centred(m: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in double precision; the whole part of the mean goes first, exactly."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (m - whole).astype(np.float64) - rest


def _gram_batches(fit: dict, solve: dict):
    """Partial Gram matrices of the centred rows times ``solve[dim]``."""
    def run(batches):
        grams: dict = {}
        for b in batches:
            for dim, _, m in _by_dim(b):
                if dim in solve:
                    rows = centred(m, *fit[dim]) @ solve[dim]
                    grams[dim] = grams.get(dim, 0) + rows.T @ rows
        if grams:
            yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.int32()),
                                              pa.array([g.tobytes() for g in grams.values()], pa.binary())], ["dim", "gram"])
    return run


def _add_grams(part: pa.Table) -> pa.Table:
    dim = part.column("dim")[0].as_py()
    total = sum(np.frombuffer(g, dtype=np.float64) for g in part.column("gram").to_pylist())
    return pa.table({"dim": pa.array([dim], pa.int32()), "gram": pa.array([total.tobytes()], pa.binary())})


def gram(whole: DataFrame, fit: dict, solve: dict) -> dict[int, np.ndarray]:
    """The Gram matrix per dim of ``solve``, summed over all rows."""
    groups = max(1, math.isqrt(int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parts = whole.mapInArrow(_gram_batches(fit, solve), "dim int, gram binary")
    summed = parts.withColumn("part", F.spark_partition_id() % groups).groupBy("dim", "part").applyInArrow(_add_grams, "dim int, gram binary")
    out: dict = {}
    for r in summed.collect():
        g = np.frombuffer(r["gram"], dtype=np.float64)
        width = solve[r["dim"]].shape[1]
        out[r["dim"]] = out.get(r["dim"], 0) + g.reshape(width, width)
    return out


def _shift(g: np.ndarray, n: int) -> float:
    """The shift of the method: 11 (n d + d (d + 1)) eps times the squared norm."""
    d = len(g)
    return min(11 * (n * d + d * (d + 1)) * EPS, 0.01 / d) * np.trace(g)


def decompose(whole: DataFrame, fit: dict) -> dict[int, tuple[np.ndarray, float]]:
    """{dim: (R, floor)} with R'R = A'A + floor^2 I for the centred rows A of
    each dim; dims without any variance are left out.

    The floor stands for ``FLOOR`` of the norm of A in every direction, as if
    that multiple of the identity followed the rows: a direction without
    variance then has a definite factor instead of amplified rounding."""
    r, floor, open_ = {d: np.eye(d) for d in fit}, {}, set(fit)
    for k in range(PASSES):
        found = gram(whole, fit, {d: _inverse(r[d]) for d in open_})
        for d in list(open_):
            if not k and not np.trace(found[d]) > 0:
                open_.discard(d)
                continue
            floor.setdefault(d, FLOOR * math.sqrt(np.trace(found[d])))
            low = _inverse(r[d]) * floor[d]
            g = (found[d] + found[d].T) / 2 + low.T @ low
            r[d] = np.linalg.cholesky(g + (0 if k else _shift(g, fit[d][0])) * np.eye(d)).T @ r[d]
            # What is off by x before a factor is off by about x * x after it.
            if np.abs(g - np.eye(d)).max() < 1e-6:
                open_.discard(d)
        if not open_:
            break
    return {d: (r[d], floor[d]) for d in floor}


def _inverse(r: np.ndarray) -> np.ndarray:
    """Inverse of an upper triangular factor, by solving for the unit vectors."""
    return np.linalg.solve(r, np.eye(len(r)))


def components_of(r: np.ndarray, floor: float, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(unit components as columns, eigenvalues, trace of the covariance).
    The entry of largest magnitude of a component is positive."""
    _, s, vt = np.linalg.svd(r)
    e = (s ** 2 - floor ** 2) / n
    keep = min(most, int((s > 4 * floor).sum()))
    v = vt[:keep].T
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(keep)])
    return v, e[:keep], float(e.sum())


def deviations(m: np.ndarray, n: int, sums: list[int]) -> list:
    """Exact sum over entries of (n x - S)**2 per row; null beyond a long."""
    s = np.array(sums, dtype=object)
    if max(int(np.abs(m).max(initial=0)) * n, *map(abs, sums)) < 2**61:
        d = m * np.int64(n) - s.astype(np.int64)
        about = (d.astype(np.float64) ** 2).sum(axis=1)
        out = (d * d).sum(axis=1).astype(object)
        out[about > _LONG * (1 + 1e-9)] = None
        close = np.flatnonzero(np.abs(about / _LONG - 1) <= 1e-9)
        out[close] = [v if v <= _LONG else None for v in (d[close].astype(object) ** 2).sum(axis=1)]
        return out.tolist()
    d = m.astype(object) * n - s
    return [v if v <= _LONG else None for v in (d * d).sum(axis=1)]


_ROWS = ("vec_id long, component int, n long, deviation long, whitened double, eigenvalue double, explained double, "
         "identity_error double")


def _whitened_batches(fit: dict, model: dict, errors: dict):
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("eigenvalue", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches):
        for b in batches:
            ids = b.column("vec_id")
            for dim, at, m in _by_dim(b):
                if dim not in model:
                    continue
                v, e, trace = model[dim]
                k, n = len(e), fit[dim][0]
                rows = (centred(m, *fit[dim]) @ (v / np.sqrt(e))).ravel()
                own = np.repeat(np.arange(len(at)), k)
                size = len(rows)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(at)).take(pa.array(own)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(size, n, dtype=np.int64)), pa.array(deviations(m, *fit[dim]), pa.int64()).take(pa.array(own)),
                    pa.array(rows), pa.array(np.tile(e, len(at))), pa.array(np.tile(e / trace, len(at))),
                    pa.array(np.full(size, errors[dim]))], schema=schema)
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, eigenvalue, explained,
    identity_error) per whole vector of ``vectors`` (vec_id, embedding) and
    component."""
    whole = materialise(vectors.sparkSession, whole_vectors(vectors), "whole-vectors")
    fit = fit_list(whole)
    model = {d: components_of(*f, fit[d][0], components) for d, f in decompose(whole, fit).items()}
    found = gram(whole, fit, {d: v / np.sqrt(e) for d, (v, e, _) in model.items()})
    errors = {d: float(np.abs(g / fit[d][0] - np.eye(len(g))).max()) for d, g in found.items()}
    return whole.mapInArrow(_whitened_batches(fit, model, errors), _ROWS)
