"""Token counts through a digest cache.

A text's count depends on its content and the tokenizer only, so counts are
kept in a table keyed by (content digest, tokenizer version).  A run joins the
documents' digests to it, encodes one text for each digest it lacks, and
appends those counts.

Normalised content is the text's UTF-8 bytes, null as empty: any further
normalisation would change counts.  The version is the digest of the
vocabulary file.

Edge cases: null text counts as empty (0 bytes, 0 tokens); repeated rows and
equal texts are encoded once and each row is returned; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.bpe import default_tokenizer, encoder
from barlake.llm.storage import materialise

CACHE_SCHEMA = "digest binary, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer; empty when nothing is stored yet.
    A digest that two runs appended at once counts once."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    return stored.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _count_batches(path: str, version: str):
    """Counts of the digests of a task, once for repeated rows (the join puts
    them in one task)."""
    def run(batches):
        enc, seen = encoder(path), set()
        for b in batches:
            new = [i for i, d in enumerate(b.column("digest").to_pylist()) if not (d in seen or seen.add(d))]
            b = b.take(pa.array(new, pa.int32()))
            counts = [len(ids) // 4 for ids in enc.encode(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("digest").cast(pa.binary()), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                ["digest", "version", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: str | None = None, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    Only digests (32 bytes a document) meet in the joins by content, so a
    group of copies moves no text; the texts to encode are found by
    (doc_id, digest), which spreads evenly.
    """
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    version = tokenizer_version(path)
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.unhex(F.sha2(F.encode("text", "utf-8"), 256)).alias("digest"))
    keys = materialise(spark, seen.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")),
                       "token-digests")
    known = read_cache(spark, cache_path, version)
    todo = (keys.groupBy("digest").agg(F.min("doc_id").alias("rep"))
            .join(known.select("digest"), "digest", "left_anti")
            .withColumnRenamed("digest", "todo_digest"))
    misses = seen.join(todo, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("digest") == F.col("todo_digest")),
                       "left_semi").select("digest", "text")
    fresh = misses.mapInArrow(_count_batches(path, version), CACHE_SCHEMA)
    fresh.write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path, version)
    return keys.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
