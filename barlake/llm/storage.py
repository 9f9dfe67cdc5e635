"""Tables that cut lineage, in the shared folder the cluster names in
``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.session import scratch_dir


def materialise(spark: SparkSession, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    What follows then depends on files every executor can read, not on the
    lineage of ``df``: a lost executor costs its running tasks only.
    """
    path = scratch_dir(spark, f"llm-{name}")
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(columns, base: str) -> str:
    """A column name that clashes with none of ``columns``."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name
