"""Refine raw bars: non-positive values to NULL, forward fill, drop incomplete.

All three steps are one projection over one window specification
(``partitionBy(key).orderBy(order)``), so the plan has a single shuffle on
the key and a single sort; the reference's 5 x 5 chained fills collapse into
one ``Window`` node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.exprs import positive_or_null
from barlake.schema import KEY, MEASURES, ORDER


def null_nonpositive(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Every listed column keeps only values > 0 (zero becomes NULL too)."""
    wanted = set(columns)
    return df.select(*[positive_or_null(F.col(c)).alias(c) if c in wanted else F.col(c)
                       for c in df.columns])


def fill_window(key: str | Sequence[str] = KEY, order: str = ORDER) -> Window:
    keys = [key] if isinstance(key, str) else list(key)
    return (Window.partitionBy(*keys).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def forward_fill(df: DataFrame, columns: Sequence[str] = MEASURES,
                 order: str = ORDER, key: str | Sequence[str] = KEY) -> DataFrame:
    """Each listed column takes the last non-NULL value at or before the
    row within its key.  NaN is a value and is carried forward."""
    w = fill_window(key, order)
    wanted = set(columns)
    return df.select(*[F.last(F.col(c), ignorenulls=True).over(w).alias(c) if c in wanted
                       else F.col(c) for c in df.columns])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of the columns (all by default)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def refine_prices(df: DataFrame, measures: Sequence[str] = MEASURES,
                  key: str = KEY, order: str = ORDER) -> DataFrame:
    """Raw -> refined: P2, then W1 over all measures, then P3."""
    return drop_incomplete(forward_fill(null_nonpositive(df, measures), measures, order, key))
