"""Alert texts and names as column expressions.

The reference renders these in Python once per rule; here they are columns
of the rule/hit tables, so any number of rules costs one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (texts that must equal the reference's).
#   price alert subject:  "{exchange} - {threshold}% change."
#   price alert body:     "The following tickers prices changed more than  {threshold}% today:"
#   SMA alert subject:    "{exchange} - {days} day moving average"
#   SMA alert body:       "The following tickers crossed the {days} day moving average today:"
#   SMA label:            "Went above {days} day moving average." /
#                         "Went below {days} day moving average." / "N/A"
#   query name:           "{exchange}_{column}_{threshold}" (price), "{exchange}_{column}" (SMA)
#   alert name:           "Alert - {query name}"
# ---------------------------------------------------------------------------
PRICE_SUBJECT = "%s - %s%% change."
PRICE_BODY = "The following tickers prices changed more than  %s%% today:"
SMA_SUBJECT = "%s - %s day moving average"
SMA_BODY = "The following tickers crossed the %s day moving average today:"
SMA_ABOVE = "Went above %s day moving average."
SMA_BELOW = "Went below %s day moving average."
SMA_NONE = "N/A"
ALERT_PREFIX = "Alert - "


def sma_text(crossover: Column, periods: Column | int) -> Column:
    days = periods if isinstance(periods, Column) else F.lit(periods)
    return (F.when(crossover > 0, F.format_string(SMA_ABOVE, days))
            .when(crossover < 0, F.format_string(SMA_BELOW, days))
            .otherwise(F.lit(SMA_NONE)))


def threshold_text(threshold: Column) -> Column:
    """Threshold as the configuration wrote it: 5, not 5.0."""
    return F.when(threshold == F.floor(threshold), threshold.cast("bigint").cast("string")) \
        .otherwise(threshold.cast("string"))


def query_name(rule_type: Column, exchange: Column, metric: Column, threshold: Column) -> Column:
    return F.when(rule_type == "eod_change",
                  F.concat_ws("_", exchange, metric, threshold_text(threshold))) \
        .otherwise(F.concat_ws("_", exchange, metric))


def alert_name(query: Column) -> Column:
    return F.concat(F.lit(ALERT_PREFIX), query)


def subject(rule_type: Column, exchange: Column, threshold: Column, periods: Column) -> Column:
    return F.when(rule_type == "eod_change",
                  F.format_string(PRICE_SUBJECT, exchange, threshold_text(threshold))) \
        .otherwise(F.format_string(SMA_SUBJECT, exchange, periods.cast("string")))


def body(rule_type: Column, threshold: Column, periods: Column) -> Column:
    return F.when(rule_type == "eod_change",
                  F.format_string(PRICE_BODY, threshold_text(threshold))) \
        .otherwise(F.format_string(SMA_BODY, periods.cast("string")))
