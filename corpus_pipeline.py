"""A training corpus from documents: good text, one of each near-duplicate
group, nothing of the benchmark, secrets redacted, packed into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and reads it back as the next
stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import credentials, decontam, jaccard_rtree, packing, quality_cnn
from barlake.llm.storage import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the convolutional network does not reject."""
    return quality_cnn.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return jaccard_rtree.keep_one(docs, part=4, whole=5, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans of secrets replaced."""
    return credentials.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in packed sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", pack),
]

#: No SQL: a fitted network, a tokenizer and a byte-level search have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
