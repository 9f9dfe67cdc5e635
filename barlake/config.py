"""Configuration as data: exchanges, tickers and alert rules.

The reference keeps these in a nested dict and loops over them on the
driver.  Here they become small DataFrames (``universe`` and
``alert_rules``) so that rule evaluation is a join, not a loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's configuration and defaults).
# ---------------------------------------------------------------------------
DEFAULT_EXCHANGE = "US"
DEFAULT_TICKERS = [
    "NVDA", "TSM", "AVGO", "ASML", "AMD", "QCOM", "AMAT", "TXN", "INTC", "MU",
    "LRCX", "TOELY", "ARM", "ADI", "KLAC", "APH", "NXPI", "MRVL", "MCHP",
    "IFNNY", "TEL", "STM", "MRAAY", "MPWR", "RNECY", "ON", "GLW", "GFS", "FTV",
]
# Alert rules in configuration order: (type, parameter).
DEFAULT_ALERTS = [
    ("eod_change", 5),
    ("eod_change", 10),
    ("sma_crossover", 20),
    ("sma_crossover", 200),
]
# Last loaded date assumed for a ticker with no rows yet; loading starts the
# day after.
DEFAULT_LAST_DATE = dt.date(2023, 1, 1)
# Minimum gap between two notices of one alert.
DEFAULT_REARM = 100
# ---------------------------------------------------------------------------

RULES_SCHEMA = T.StructType([
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("rule_type", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("periods", T.IntegerType(), True),
    T.StructField("rule_order", T.IntegerType(), False),
])

UNIVERSE_SCHEMA = T.StructType([
    T.StructField("exchange", T.StringType(), False),
    T.StructField("ticker", T.StringType(), False),
])


def rule_rows(alerts=DEFAULT_ALERTS, value_col: str = "close"):
    """Expand (type, parameter) pairs into rule rows.

    ``eod_change`` watches ``{value}_change`` against a % threshold;
    ``sma_crossover`` watches ``{value}_sma_{n}_co`` for any non-zero value.
    Unknown types are ignored, as in the reference.
    """
    from barlake.functions.names import change_name, crossover_name, sma_name

    rows = []
    for order, (kind, param) in enumerate(alerts):
        if kind == "eod_change":
            rows.append((f"change_{param}", kind, change_name(value_col),
                         float(param), None, order))
        elif kind == "sma_crossover":
            rows.append((f"sma_{param}", kind,
                         crossover_name(sma_name(value_col, int(param))),
                         0.0, int(param), order))
    return rows


def alert_rules(spark: SparkSession, alerts=DEFAULT_ALERTS, value_col: str = "close") -> DataFrame:
    return spark.createDataFrame(rule_rows(alerts, value_col), RULES_SCHEMA)


def universe(spark: SparkSession, tickers=DEFAULT_TICKERS,
             exchange: str = DEFAULT_EXCHANGE) -> DataFrame:
    return spark.createDataFrame([(exchange, t) for t in tickers], UNIVERSE_SCHEMA)
