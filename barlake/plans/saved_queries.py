"""Stored alert rules as one SQL statement over the metrics table's path.

The statement is generated from a rules table, not written per rule: the
watched metric columns become (metric, value) rows of the newest date, and a
join with the rules keeps the values beyond their threshold.  Any number of
rules is one statement and one pass over the newest date partition.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from barlake.config import rule_rows
from barlake.schema import KEY, ORDER


def table_ref(path: str, fmt: str = "parquet") -> str:
    return f"{fmt}.`{path}`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def hits_statement(table: str, alerts: Iterable[tuple[str, int]], key: str = KEY, order: str = ORDER) -> str:
    """SQL giving (rule_id, key, order, value) of every rule that fires on the
    table's newest date."""
    rules = [(rule_id, metric, threshold) for rule_id, _, metric, threshold, _, _ in rule_rows(alerts)]
    metrics = list(dict.fromkeys(metric for _, metric, _ in rules))
    pairs = ", ".join(f"{_text(m)}, CAST(`{m}` AS DOUBLE)" for m in metrics)
    values = ", ".join(f"({_text(i)}, {_text(m)}, {t!r}D)" for i, m, t in rules)
    return f"""
WITH newest AS (SELECT max(`{order}`) AS day FROM {table}),
watched AS (SELECT `{key}`, `{order}`, stack({len(metrics)}, {pairs}) AS (metric, value)
            FROM {table} WHERE `{order}` = (SELECT day FROM newest)),
rules AS (SELECT * FROM VALUES {values} AS (rule_id, watches, threshold))
SELECT rule_id, `{key}`, `{order}`, value
FROM watched JOIN rules ON metric = watches AND abs(value) > threshold"""


def run_saved(spark: SparkSession, sql_text: str) -> DataFrame:
    return spark.sql(sql_text)
