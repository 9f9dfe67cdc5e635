"""Secret scan with linking of credentials that come in several parts.

Three kinds of span are reported wherever they match (``assign``, ``access``,
``hex``).  Other candidates are too weak to report alone: a user name
(``ident``), a long mixed token (``blob``), an address with a scheme
(``endpoint``).  A credential needs an identifier, a secret and a place to use
them, so a weak candidate is reported only when the parts it lacks stand
within ``reach`` characters of it in the same scope (a paragraph of one
document):

* ``blob`` needs an identifier (``access`` or ``ident``),
* ``ident`` needs a secret (``assign``, ``hex`` or ``blob``),
* ``endpoint`` needs both an identifier and a secret.

Linking joins candidates with the intervals of text, the scopes, that hold
them: the first identifier and the first secret of each (row, scope) decide
for all its candidates, without pairs of parts.  ``reach`` asks for parts at most so many characters away as well; parts are then placed in each
stretch of ``reach`` characters they touch, candidates in each stretch they
cover, and semi joins keep the candidates with a part near enough.

Edge cases: null text counts as empty; a document without spans has counts 0,
empty ``spans`` and the digest of the empty string; repeated rows are scanned
each for itself; other columns are ignored by the scan and kept by
``redact``.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.storage import materialise, spare

# Fixed patterns of the base kinds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
# Weak candidates.
_IDENT = re.compile(r"""\b(?:user_?(?:name|id)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?([\w.@-]{3,})""",
                    re.IGNORECASE | re.ASCII)
_IDENT_WORDS = (b"user", b"login", b"account", b"client")
_ENDPOINT = re.compile(r"""\b(?:https?|ftp|s3|jdbc|postgres(?:ql)?|mysql|redis|amqps?|mongodb)://[^\s"'<>]{3,}""",
                       re.IGNORECASE | re.ASCII)
_BLOB = re.compile(r"(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{32,}(?![A-Za-z0-9/+])")
_BREAK = re.compile(r"\n[ \t\r]*\n")
KINDS = ("assign", "access", "hex", "ident", "blob", "endpoint")

_SPAN = "array<struct<start:long,ord:int,end:long>>"
_WEAK = "array<struct<start:long,ord:int,end:long,scope:long>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start, then kind."""
    low = text.encode("utf-8", "surrogatepass").lower()
    out = []
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def weak_spans(text: str, base: list) -> list[tuple[int, int, int]]:
    """Weak candidates; none when the text has no part of an identifier or no
    secret at all, as nothing could then be linked."""
    low = text.encode("utf-8", "surrogatepass").lower()
    idents = [(m.start(1), 3, m.end(1)) for m in _IDENT.finditer(text)] if any(w in low for w in _IDENT_WORDS) else []
    if not idents and not any(k == 1 for _, k, _ in base):
        return []
    starts = [s for s, _, _ in base]
    ends = list(itertools.accumulate((e for _, _, e in base), max))

    def free(s: int, e: int) -> bool:
        i = bisect.bisect_left(starts, e)
        return not i or ends[i - 1] <= s

    blobs = [(m.start(), 4, m.end()) for m in _BLOB.finditer(text)
             if free(m.start(), m.end()) and re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0])]
    if not blobs and all(k == 1 for _, k, _ in base):
        return []
    places = [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)] if b"://" in low else []
    return sorted([x for x in idents if free(x[0], x[2])] + blobs + places)


def _digest(spans: list) -> str:
    said = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return hashlib.sha256(said.encode()).hexdigest()


def _parts(text: str, base: list) -> list[dict]:
    """All parts with their scopes where weak candidates could be linked."""
    weak = weak_spans(text, base)
    breaks = [m.start() for m in _BREAK.finditer(text)] if weak else []
    return [{"start": s, "ord": k, "end": e, "scope": bisect.bisect_right(breaks, s)}
            for s, k, e in (sorted(base + weak) if weak else [])]


_SPAN_TYPE = pa.struct([("start", pa.int64()), ("ord", pa.int32()), ("end", pa.int64())])
_PART_TYPE = pa.struct([("start", pa.int64()), ("ord", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())])


def _scan_batches(batches):
    for b in batches:
        rows = []
        for uid, text in zip(b.column("uid").to_pylist(), b.column("text").to_pylist()):
            base = base_spans(text)
            parts = _parts(text, base)
            rows.append({"uid": uid, "n_assign": sum(k == 0 for _, k, _ in base), "n_access": sum(k == 1 for _, k, _ in base),
                         "n_hex": sum(k == 2 for _, k, _ in base), "base_sha256": _digest(base),
                         "base": [{"start": s, "ord": k, "end": e} for s, k, e in base], "parts": parts})
        schema = pa.schema([("uid", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                            ("base_sha256", pa.string()), ("base", pa.list_(_SPAN_TYPE)), ("parts", pa.list_(_PART_TYPE))])
        out = pa.RecordBatch.from_pylist(rows, schema=schema)
        yield pa.RecordBatch.from_arrays([*out.columns, b.column("doc_id")], names=[*out.schema.names, "doc_id"])


def credential_parts(docs: DataFrame) -> DataFrame:
    """One stored row per document: base spans, and all parts where weak
    candidates could be linked.  ``uid`` names the row."""
    typ = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("uid", "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = rows.mapInArrow(_scan_batches, "uid long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                            f"base {_SPAN}, parts {_WEAK}, doc_id {typ}")
    return materialise(docs.sparkSession, found, "credential-parts")


def link_in_scopes(parts: DataFrame) -> DataFrame:
    """The weak candidates of (uid, scope, start, ord, end) rows that have the
    parts they lack somewhere in their scope."""
    first_id = F.min(F.when(F.col("ord").isin(1, 3), F.col("start"))).alias("first_id")
    first_secret = F.min(F.when(F.col("ord").isin(0, 2, 4), F.col("start"))).alias("first_secret")
    scopes = parts.where("ord < 5").groupBy("uid", "scope").agg(first_id, first_secret)
    lacks = ("CASE ord WHEN 3 THEN first_secret IS NULL WHEN 4 THEN first_id IS NULL "
             "ELSE first_id IS NULL OR first_secret IS NULL END")
    return parts.where("ord >= 3").join(scopes, ["uid", "scope"]).where(f"NOT ({lacks})").select("uid", "start", "ord", "end")


def link_credentials(parts: DataFrame, reach: int) -> DataFrame:
    """The weak candidates of (uid, scope, start, ord, end) rows that have the
    parts they lack within ``reach`` characters."""
    def stretch(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach)))

    near = parts.select(
        F.col("uid").alias("u"), F.col("scope").alias("sc"), F.col("start").alias("s"), F.col("end").alias("e"),
        F.col("ord").alias("o"), stretch(F.col("start") - reach, F.col("end") + reach).alias("st"))
    ids, secrets = near.where(F.col("o").isin(1, 3)), near.where(F.col("o").isin(0, 2, 4))
    cand = parts.where(F.col("ord") >= 3).withColumn("stretch", stretch(F.col("start"), F.col("end")))

    def having(df: DataFrame, side: DataFrame) -> DataFrame:
        gap = F.greatest(F.col("s") - F.col("end"), F.col("start") - F.col("e"))
        return df.join(side, (F.col("uid") == F.col("u")) & (F.col("scope") == F.col("sc"))
                       & (F.col("stretch") == F.col("st")) & (gap <= reach), "left_semi")

    # The two parts an endpoint needs may touch it in different stretches.
    cols = ["uid", "start", "ord", "end"]
    ends = cand.where("ord = 5")
    both = having(ends, ids).select(cols).distinct().intersect(having(ends, secrets).select(cols).distinct())
    blobs = having(cand.where("ord = 4"), ids).select(cols).distinct()
    idents = having(cand.where("ord = 3"), secrets).select(cols).distinct()
    return blobs.unionByName(idents).unionByName(both)


def _weak(parts: DataFrame, reach: int | None) -> DataFrame:
    """(uid, weak): the linked candidates of each document that has any."""
    linked = link_in_scopes(parts) if reach is None else link_credentials(parts, reach)
    return linked.groupBy("uid").agg(F.collect_list(F.struct("start", "ord", "end")).alias("weak"))


def _all_spans(base: Column, weak: Column) -> Column:
    return F.array_sort(F.concat(base, F.coalesce(weak, F.array().cast(_SPAN))))


def _linked(found: DataFrame, reach: int | None) -> DataFrame:
    weak = _weak(found.where(F.size("parts") > 0).select("uid", F.inline("parts")), reach)
    return found.join(weak, "uid", "left").withColumn("all", _all_spans(F.col("base"), F.col("weak")))


def scan_secrets(docs: DataFrame, reach: int | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row."""
    found = credential_parts(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    said = F.transform("all", lambda x: F.concat_ws(":", kinds[x["ord"]], x["start"], x["end"]))
    return _linked(found, reach).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                                        F.concat_ws(",", said).alias("spans"))


def redact(docs: DataFrame, reach: int | None = None, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; all rows and
    columns stay, ``n_chars`` follows the new text where the column exists."""
    cols = docs.columns
    uid, found, spans = spare(cols, "uid"), spare(cols, "found"), spare(cols, "spans")

    @F.arrow_udf(f"struct<base:{_SPAN},parts:{_WEAK}>")
    def scan(text: pa.Array) -> pa.Array:
        rows = [(t, base_spans(t)) for t in (x or "" for x in text.to_pylist())]
        return pa.array([{"base": [{"start": s, "ord": k, "end": e} for s, k, e in base], "parts": _parts(t, base)}
                         for t, base in rows], pa.struct([("base", pa.list_(_SPAN_TYPE)), ("parts", pa.list_(_PART_TYPE))]))

    # Spans lie beside the texts: only documents with candidates to link meet the linked ones.
    stored = materialise(docs.sparkSession, docs.withColumn(uid, F.monotonically_increasing_id()).withColumn(
        found, scan(F.col("text"))), "to-redact", "zstd")
    base, apart = F.col(f"{found}.base"), F.size(F.col(f"{found}.parts")) > 0
    weak = _weak(stored.where(apart).select(F.col(uid).alias("uid"), F.inline(F.col(f"{found}.parts"))), reach)

    @F.pandas_udf("string")
    def cut(text: pd.Series, where: pd.Series) -> pd.Series:
        def one(t, w):
            if w is None or t is None:
                return t
            out, at = [], 0
            for s in w:
                if s["end"] <= at:
                    continue
                if s["start"] >= at:
                    out += [t[at:s["start"]], mark]
                at = s["end"]
            return "".join(out) + t[at:]
        return pd.Series([one(t, w) for t, w in zip(text, where)], dtype=object)

    def redacted(rows: DataFrame) -> DataFrame:
        done = rows.withColumn("text", cut(F.col("text"), F.col(spans)))
        if "n_chars" in cols:
            done = done.withColumn("n_chars", F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(
                F.length("text").cast(docs.schema["n_chars"].dataType)))
        return done.select(cols)

    linked = stored.where(apart).join(weak.select(F.col("uid").alias(uid), F.col("weak").alias(spans)), uid, "left")
    linked = linked.withColumn(spans, _all_spans(base, F.col(spans)))
    plain = stored.where(~apart & (F.size(base) > 0)).withColumn(spans, F.array_sort(base))
    return (stored.where(~apart & (F.size(base) == 0)).select(cols)
            .unionByName(redacted(plain)).unionByName(redacted(linked)))
