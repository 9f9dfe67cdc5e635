"""Per-ticker time-series metrics: previous value, % change, SMA, crossover.

Every window here uses the same ``partitionBy(key).orderBy(order)``
specification, so however many rules are configured the physical plan has
one exchange and one sort; rules only add ``Window`` nodes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.config import DEFAULT_ALERTS
from barlake.functions.exprs import above_flag, crossover_sign, pct_change
from barlake.functions.names import change_name, crossover_name, previous_name, sma_name
from barlake.schema import KEY, ORDER


def series_window(key: str | list[str] = KEY, order: str = ORDER) -> Window:
    if key is None or order is None:
        raise ValueError("key and order are required")
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(order)


def sma_expr(value: Column, periods: int, w: Window, exact: bool = False,
             cents: bool = False) -> Column:
    """Mean over the frame ROWS BETWEEN periods PRECEDING AND CURRENT ROW,
    i.e. periods + 1 rows (the reference's definition); ``exact`` uses
    ``periods`` rows.  Partial frames at the start are averaged; NULLs are
    ignored.  ``cents`` sums whole cents as integers so the mean is exact and
    free of summation-order drift."""
    back = periods - 1 if exact else periods
    frame = w.rowsBetween(-back, Window.currentRow)
    if cents:
        whole = F.round(value * 100).try_cast("bigint")
        return F.sum(whole).over(frame) / (F.lit(100.0) * F.count(whole).over(frame))
    return F.avg(value).over(frame)


# Whole-cent SMAs from running integer sums: a running sum/count is an
# incremental frame (O(1) per row), and the frame total is the running value
# minus the running value ``back + 1`` rows earlier.  Integer sums are exact,
# so this equals summing the frame directly, without re-adding up to
# ``periods + 1`` values for every row as a sliding frame does.
CENTS_SUM, CENTS_COUNT = "__cents_sum", "__cents_count"


def cents_running(value: Column, w: Window) -> dict[str, Column]:
    whole = F.round(value * 100).try_cast("bigint")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {CENTS_SUM: F.sum(whole).over(running), CENTS_COUNT: F.count(whole).over(running)}


def cents_sma_from_running(periods: int, w: Window, exact: bool = False) -> Column:
    back = (periods - 1 if exact else periods) + 1
    total = F.col(CENTS_SUM) - F.coalesce(F.lag(F.col(CENTS_SUM), back).over(w), F.lit(0))
    n = F.col(CENTS_COUNT) - F.coalesce(F.lag(F.col(CENTS_COUNT), back).over(w), F.lit(0))
    return F.try_divide(total.cast("double"), F.lit(100.0) * n)


# --- The reference's single-metric building blocks -------------------------

def previous_value(df: DataFrame, column: str, key: str = KEY,
                   order: str = ORDER) -> tuple[DataFrame, str]:
    """Value of the previous row (not the previous calendar day)."""
    name = previous_name(column)
    return df.withColumn(name, F.lag(F.col(column), 1).over(series_window(key, order))), name


def calculate_change(df: DataFrame, new_col: str, current_col: str, previous_col: str) -> DataFrame:
    """Percentage change between two columns."""
    return df.withColumn(new_col, pct_change(F.col(current_col), F.col(previous_col)))


def simple_moving_average(df: DataFrame, column: str, periods: int, key: str = KEY,
                          order: str = ORDER, exact: bool = False,
                          cents: bool = False) -> tuple[DataFrame, str]:
    """Adds ``{column}_sma_{periods}``."""
    name = sma_name(column, periods)
    w = series_window(key, order)
    if cents:
        running = df.select("*", *[c.alias(n) for n, c in cents_running(F.col(column), w).items()])
        out = running.withColumn(name, cents_sma_from_running(periods, w, exact))
        return out.drop(CENTS_SUM, CENTS_COUNT), name
    return df.withColumn(name, sma_expr(F.col(column), periods, w, exact)), name


def crossover(df: DataFrame, trend_col: str, value_col: str, key: str = KEY,
              order: str = ORDER) -> tuple[DataFrame, str]:
    """Adds ``{trend_col}_co``: +1 / -1 on the row where the value moves
    above / below the trend line, else 0."""
    w = series_window(key, order)
    name = crossover_name(trend_col)
    flag = f"__{trend_col}_above"
    out = df.withColumn(flag, above_flag(F.col(value_col), F.col(trend_col)))
    out = out.withColumn(name, crossover_sign(F.col(flag), F.lag(F.col(flag), 1).over(w)))
    return out.drop(flag), name


def add_change_column(df: DataFrame, value_col: str = "close", key: str = KEY,
                      order: str = ORDER) -> tuple[DataFrame, str]:
    """Previous value and % change of ``value_col``."""
    df, prev = previous_value(df, value_col, key, order)
    name = change_name(value_col)
    return calculate_change(df, name, value_col, prev), name


def add_crossover_column(df: DataFrame, value_col: str = "close", periods: int = 20,
                         key: str = KEY, order: str = ORDER) -> tuple[DataFrame, str]:
    """SMA of ``value_col`` and its crossover column."""
    df, trend = simple_moving_average(df, value_col, periods, key, order)
    return crossover(df, trend, value_col, key, order)


# --- All rules in one projection (R1) ---------------------------------------

def metric_columns(alerts: Iterable[tuple[str, int]], value_col: str = "close") -> list[str]:
    """Output column names the rules produce, in first-seen order."""
    names: list[str] = []
    for kind, param in alerts:
        if kind == "eod_change":
            new = [previous_name(value_col), change_name(value_col)]
        elif kind == "sma_crossover":
            trend = sma_name(value_col, int(param))
            new = [trend, crossover_name(trend)]
        else:
            new = []
        names.extend(n for n in new if n not in names)
    return names


def lookback_rows(alerts: Iterable[tuple[str, int]]) -> int:
    """Rows before the current one that the rules read: 1 for a lag, n for an
    SMA(n) frame, n + 1 for its crossover (the previous row's SMA)."""
    need = 0
    for kind, param in alerts:
        if kind == "eod_change":
            need = max(need, 1)
        elif kind == "sma_crossover":
            need = max(need, int(param) + 1)
    return need


def compute_metrics(df: DataFrame, alerts: Iterable[tuple[str, int]] = DEFAULT_ALERTS,
                    value_col: str = "close", key: str | list[str] = KEY, order: str = ORDER,
                    exact: bool = False, cents: bool = False) -> DataFrame:
    """The columns of every configured rule, computed in two projections
    over one window spec.  Duplicate rules collapse; unknown types are ignored.
    """
    alerts = list(alerts)
    w = series_window(key, order)
    value = F.col(value_col)
    base = df
    if cents and any(kind == "sma_crossover" for kind, _ in alerts):
        base = df.select("*", *[c.alias(n) for n, c in cents_running(value, w).items()])
    first: dict[str, Column] = {}
    flags: dict[str, str] = {}
    for kind, param in alerts:
        if kind == "eod_change":
            prev = previous_name(value_col)
            first.setdefault(prev, F.lag(value, 1).over(w))
            first.setdefault(change_name(value_col), pct_change(value, F.lag(value, 1).over(w)))
        elif kind == "sma_crossover":
            n = int(param)
            trend = sma_name(value_col, n)
            if trend not in first:
                first[trend] = (cents_sma_from_running(n, w, exact) if cents
                                else sma_expr(value, n, w, exact))
                flags[trend] = f"__{trend}_above"
    # Pass 1: lag/change/SMA values; the above-flags need the SMA, so they
    # are computed on top of pass 1 and lagged in pass 2 (same window spec:
    # no second shuffle or sort).
    stage1 = base.select(*df.columns, *[c.alias(n) for n, c in first.items()])
    stage1 = stage1.select("*", *[above_flag(value, F.col(t)).alias(f) for t, f in flags.items()])
    co = {crossover_name(t): crossover_sign(F.col(f), F.lag(F.col(f), 1).over(w))
          for t, f in flags.items()}
    stage2 = stage1.select(*df.columns, *first.keys(), *[c.alias(n) for n, c in co.items()])
    return stage2.select(*df.columns, *metric_columns(alerts, value_col))


def compute_metrics_long(df: DataFrame, alerts: Iterable[tuple[str, int]] = DEFAULT_ALERTS,
                         value_col: str = "close", key: str = KEY, order: str = ORDER,
                         exact: bool = False, cents: bool = False, block_rows: int = 1_000_000) -> DataFrame:
    """R1 for series of any length: the same columns as ``compute_metrics``,
    with no task holding more than ``block_rows`` + look-back rows of one
    key (see ``barlake.operators.segmented``)."""
    from barlake.operators.segmented import SEG, blocks_with_halo, drop_halo

    alerts = list(alerts)
    cols = [c for c in df.columns if c != SEG]
    blocked = blocks_with_halo(df, lookback_rows(alerts), key, order, block_rows)
    out = compute_metrics(blocked, alerts, value_col, [key, "__blk"], order, exact, cents)
    return drop_halo(out).select(*cols, *metric_columns(alerts, value_col))
