"""Raw rows to metrics rows: per-key windows or bounded segments.

``key`` is one window per ticker and one shuffle.  Raw bars are unique by
(ticker, date), so a task holds at most a ticker's trading days: a bound the
calendar gives, whatever the number of tickers.  ``long`` deals rows into
segments and blocks of a bounded size, for series without such a bound (ticks,
or any key that holds a large share of the rows).  Both give the same rows; the
caller says which, nothing switches by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from barlake.operators.metrics import compute_metrics, compute_metrics_long
from barlake.operators.refine import refine_prices
from barlake.operators.segmented import BLOCK_ROWS, refine_prices_long


def build_metrics(raw: DataFrame, alerts, strategy: str = "key", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Raw rows -> metrics rows (refine + all rules)."""
    if strategy == "key":
        return compute_metrics(refine_prices(raw), alerts)
    if strategy != "long":
        raise ValueError(f"unknown strategy {strategy!r}")
    refined = refine_prices_long(raw, block_rows=block_rows, keep_segments=True)
    return compute_metrics_long(refined, alerts, block_rows=block_rows)
