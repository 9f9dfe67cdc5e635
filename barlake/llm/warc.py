"""WARC archives through a chunked record table.

``chunk_table`` turns each page into rows (uid, chunk_no, data) of at most
``CHUNK_BYTES`` and carries the SHA-1 of the payload up to each chunk, so the
last chunk of a record holds the digest of the whole payload and no later step
needs more than one chunk in memory.

``write_archives`` decides which records are stored in full: of records with
equal payloads the one with the largest page id is the response and the others
revisit it.  Chunks become WARC segments (a first record and ``continuation``
records), written by Spark's text writer: a record is its header and block,
and the writer's separator is the blank lines that end it.  Files are gzip, so
Spark never splits them and the reader meets whole records in order.

``read_archives`` streams the lines back, takes each block by its
Content-Length, feeds a running SHA-1 across the segments of a record and
compares it with the digest in the header.

Edge cases: null html is an empty payload; pages with the same id and payload
are all responses when that id is the group's largest; a page without an id
is a response of its own; an empty table gives no rows; other columns
are ignored; line breaks and blanks in a url are percent-encoded, and a null
url becomes ``urn:page``.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import scratch_dir

CHUNK_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"
_CHUNKS = ("uid long, page_id long, url string, chunk_no int, start long, last boolean, "
           "digest string, data binary")
RECORDS = ("record_id string, page_id long, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, segments int, intact boolean")


def _base32(h) -> str:
    return base64.b32encode(h.digest()).decode()


def _running_digests(batches):
    """Add to each chunk the digest of its payload so far; a record's chunks
    follow each other, over batches too."""
    current, sha = None, None
    for b in batches:
        digests = []
        for uid, no, data in zip(b.column("uid").to_pylist(), b.column("chunk_no").to_pylist(), b.column("data")):
            if no == 0:
                current, sha = uid, hashlib.sha1()
            if uid != current:
                raise ValueError("the chunks of a record are not together")
            sha.update(data.as_buffer())
            digests.append(_base32(sha))
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in ("uid", "page_id", "url", "chunk_no", "start", "last")], pa.array(digests, pa.string()),
             b.column("data")], ["uid", "page_id", "url", "chunk_no", "start", "last", "digest", "data"])


def chunk_table(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    rows = pages.select(F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("top", F.greatest(F.expr(f"(octet_length(payload) - 1) div {chunk_bytes}"), F.lit(0)).cast("int"))
    rows = rows.select("uid", "page_id", "url", "payload", "top", F.explode(F.sequence(F.lit(0), "top")).alias("chunk_no"))
    start = F.col("chunk_no").cast("long") * chunk_bytes
    return rows.select("uid", "page_id", "url", "chunk_no", start.alias("start"), (F.col("chunk_no") == F.col("top")).alias("last"),
                       F.expr(f"substring(payload, chunk_no * {chunk_bytes} + 1, {chunk_bytes})").alias("data")
                       ).mapInArrow(_running_digests, _CHUNKS)


def record_roles(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(uid, total, payload_digest, refers_to, target_uid) from
    (uid, page_id, total, digest); ``refers_to`` is null for responses.
    Only digests of at least ``min_bytes`` long payloads that occur more than
    once go into the join."""
    tops = (records.where(F.col("total") >= min_bytes).groupBy("digest", "total")
            .agg(F.max(F.struct("page_id", "uid")).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select("digest", "total", F.col("top.page_id").alias("top_id"), F.col("top.uid").alias("top_uid")))
    older = F.col("page_id") < F.col("top_id")
    return records.join(tops, ["digest", "total"], "left").select(
        "uid", F.col("total").alias("whole"), F.col("digest").alias("whole_digest"),
        F.when(older, F.col("top_id")).alias("refers_to"), F.when(older, F.col("top_uid")).alias("target_uid"))


def _urn(uid, part):
    h = F.md5(F.concat_ws("-", uid.cast("string"), part.cast("string")).cast("binary"))
    cut = [F.substring(h, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record_text(chunk_bytes: int):
    """Header and block of one segment as bytes in a string."""
    def line(name, value):
        return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")))

    first, revisit = F.col("chunk_no") == 0, F.col("refers_to").isNotNull()
    many = (F.col("whole") > chunk_bytes) & ~revisit
    http = F.when(first, F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                                  F.col("whole").cast("string"), F.lit("\r\n\r\n"))).otherwise(F.lit(""))
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("data"))
    kind = F.when(~first, F.lit("continuation")).when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    uri = F.coalesce(F.regexp_replace("url", r"\s", "%20"), F.lit("urn:page"))
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", _urn(F.col("uid"), F.col("chunk_no"))),
        line("WARC-Target-URI", uri), line("WARC-Date", F.lit(DATE)), line("WARC-Page-Id", F.col("page_id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("whole_digest"))),
        line("WARC-Profile", F.when(revisit, profile)),
        line("WARC-Refers-To", F.when(revisit, _urn(F.col("target_uid"), F.lit(0)))),
        line("WARC-Refers-To-Page-Id", F.col("refers_to")),
        line("WARC-Segment-Number", F.when(many, F.col("chunk_no") + 1)),
        line("WARC-Segment-Origin-ID", F.when(~first, _urn(F.col("uid"), F.lit(0)))),
        line("WARC-Segment-Total-Length", F.when(many & F.col("last"), F.col("whole"))),
        line("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        line("Content-Length", F.octet_length(body) + F.octet_length(http)),
        F.lit("\r\n"), http, body.cast("string"))


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, min_bytes: int = 0) -> None:
    """Write one gzip WARC file per shuffle partition under ``path``."""
    spark = pages.sparkSession
    store = scratch_dir(spark, "llm-warc-chunks")
    chunk_table(pages, chunk_bytes).write.option("compression", "zstd").parquet(store)
    chunks = spark.read.schema(_CHUNKS).parquet(store)
    total = F.col("start") + F.octet_length("data")
    records = chunks.where("last").select("uid", "page_id", total.alias("total"), "digest")
    # Explicit, equal partitioning on both sides: the chunks of a record stay
    # in one task, in order.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    roles = record_roles(records, min_bytes).repartition(n, "uid")
    placed = chunks.drop("digest").repartition(n, "uid").join(roles, "uid")
    placed = placed.where((F.col("chunk_no") == 0) | F.col("refers_to").isNull())
    (placed.sortWithinPartitions("uid", "chunk_no").select(_record_text(chunk_bytes).alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


_OPENS = b"WARC/1.1\r"


class _Records:
    """Reads the lines of archive files one after another.

    Where the lines do not follow the format, the record at hand ends there,
    not intact, and reading goes on at the next line that opens a record."""

    def __init__(self):
        self.done: list[dict] = []
        self.state, self.head, self.left, self.blank = "start", [], 0, 0
        self.open: dict | None = None

    def feed(self, lines) -> None:
        for line in lines:
            if self.state == "block":
                if len(line) < self.left:
                    self._take(line, b"\n")
                    self.left -= len(line) + 1
                    if self.left == 0:
                        self.state, self.blank = "end", 2
                else:
                    self._take(line[:self.left])
                    self.state, self.blank = "end", 1
                    if line[self.left:] != b"\r":
                        self._lose(line)  # a block longer than its Content-Length
            elif self.state == "end":
                self.blank -= 1
                if line != b"\r":
                    self._lose(line)
                elif not self.blank:
                    self.state = "start"
            elif self.state == "lost":
                if line == _OPENS:
                    self.state, self.head = "start", [line]
            elif line == b"\r":
                try:
                    self._header()
                except (KeyError, ValueError):
                    # The record before is whole unless this is its own header.
                    self._lose(line, hurt=self.state == "http")
            else:
                self.head.append(line)

    def _lose(self, line: bytes, hurt: bool = True) -> None:
        if self.open is not None and hurt:
            self.open["lost"] = True
        self.finish()
        self.state, self.head = ("start", [line]) if line == _OPENS else ("lost", [])

    def _header(self) -> None:
        if self.state == "http":
            self.open["http"].update(_fields(self.head))
            self.left -= sum(len(x) + 1 for x in self.head) + 2
            if self.left < 0:
                raise ValueError("a block shorter than its own header")
        else:
            h = _fields(self.head)
            if not self.head or self.head[0] != _OPENS:
                raise ValueError("no record opens here")
            self.left = int(h["content-length"])
            if h["warc-type"] == "continuation":
                if self.open is None or h["warc-segment-origin-id"] != self.open["id"]:
                    raise ValueError("a segment without its record")
                self.open["segments"] += 1
            else:
                self.finish()
                self.open = {"id": h["warc-record-id"], "h": h, "http": {}, "sha": hashlib.sha1(), "n": 0, "segments": 1, "lost": False}
                self.head, self.state = [], "http"
                return
        self.head = []
        self.state, self.blank = ("block", 0) if self.left else ("end", 2)

    def _take(self, *parts) -> None:
        for p in parts:
            self.open["sha"].update(p)
            self.open["n"] += len(p)

    def finish(self) -> None:
        if self.open is None:
            return
        o, h = self.open, self.open["h"]
        self.open = None
        revisit = h["warc-type"] == "revisit"
        said, size = h.get("warc-payload-digest", "").removeprefix("sha1:"), _number(o["http"].get("content-length"))
        digest = said if revisit else _base32(o["sha"])
        self.done.append({
            "record_id": o["id"], "page_id": _number(h.get("warc-page-id")), "record_type": h["warc-type"],
            "payload_bytes": size if revisit else o["n"], "payload_digest": digest, "refers_to": _number(h.get("warc-refers-to-page-id")),
            "segments": o["segments"], "intact": not o["lost"] and size is not None and digest == said and (revisit or o["n"] == size)})


def _number(text: str | None) -> int | None:
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


def _fields(lines) -> dict:
    return {k.strip().lower().decode(): v.strip().decode("utf-8", "replace")
            for k, sep, v in (x.partition(b":") for x in lines) if sep}


def _read_batches(batches):
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                        ("segments", pa.int32()), ("intact", pa.bool_())])
    reader = _Records()
    for b in batches:
        reader.feed(b.column("line").to_pylist())
        rows, reader.done = reader.done, []
        yield pa.RecordBatch.from_pylist(rows, schema=schema)
    reader.finish()
    yield pa.RecordBatch.from_pylist(reader.done, schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; ``intact`` says
    whether the payload read has the size and digest its header states (for a
    revisit, only the header is there).  A record whose lines break the format
    is not intact and ends there; a header that names no record gives no row."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("line"))
    return lines.mapInArrow(_read_batches, RECORDS)


def archive_round_trip(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, min_bytes: int = 0) -> DataFrame:
    """Write the archives of ``pages`` to ``path`` and read them back."""
    write_archives(pages, path, chunk_bytes, min_bytes)
    return read_archives(pages.sparkSession, path)
