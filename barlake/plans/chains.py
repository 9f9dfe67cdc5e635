"""Stage chains over the fixture bars: dirty -> refined -> metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.operators.metrics import compute_metrics
from barlake.operators.refine import refine_prices
from barlake.sources.fixtures import dirty_bars


def refined(spark: SparkSession, sf_dir: str, kind: str = "user") -> DataFrame:
    return refine_prices(dirty_bars(spark, sf_dir, kind))


def metrics(spark: SparkSession, sf_dir: str, kind: str = "user", **kw) -> DataFrame:
    return compute_metrics(refined(spark, sf_dir, kind), **kw)


def metrics_columns(alerts=None) -> list[str]:
    from barlake.config import DEFAULT_ALERTS
    from barlake.operators.metrics import metric_columns
    from barlake.schema import BARS_SCHEMA
    return BARS_SCHEMA.fieldNames() + metric_columns(alerts or DEFAULT_ALERTS)
