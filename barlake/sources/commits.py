"""Which folders make up a set of tables: one small table of commits.

A commit is one row, written last, that names the folders of every table.
Readers take the newest commit; a job that may be replayed takes the newest
one below its own number, so it always starts from the same state and may
overwrite what an earlier attempt left under its number.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from barlake.sources.tables import path_exists

_SCHEMA = "tables string, n long"


def commit(spark: SparkSession, root: str, n: int, **tables: list[str]) -> None:
    """Make ``tables`` (name -> folders) the content of ``root`` as of ``n``."""
    row = spark.createDataFrame([(json.dumps(tables),)], "tables string").coalesce(1)
    row.write.mode("overwrite").parquet(f"{root}/commits/n={n}")


def committed(spark: SparkSession, root: str, before: int | None = None) -> dict[str, list[str]] | None:
    """The newest commit of ``root`` (below ``before``), None without any."""
    path = f"{root}/commits"
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema(_SCHEMA).parquet(path)
    if before is not None:
        rows = rows.where(F.col("n") < before)
    newest = rows.orderBy(F.col("n").desc()).first()
    return json.loads(newest["tables"]) if newest else None
