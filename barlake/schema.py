"""Table schemas and column names."""

from pyspark.sql import types as T

KEY = "ticker"
ORDER = "date"
MEASURES = ["open", "high", "low", "close", "volume"]
PRICES = ["open", "high", "low", "close"]

# Raw / refined bars.  Prices are DOUBLE and volume BIGINT: a 32-bit volume
# cannot hold values above 2^31-1, which real volumes reach.
BARS_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
])

# Rows of landed files that cannot become bars (no ticker or no valid date).
QUARANTINE_SCHEMA = T.StructType([
    T.StructField("file", T.StringType(), True),
    T.StructField("ticker", T.StringType(), True),
    T.StructField("date_text", T.StringType(), True),
    T.StructField("line", T.StringType(), True),
    T.StructField("reason", T.StringType(), False),
])

# Landed file header names, as the price vendor writes them.
LANDING_FIELDS = {
    "date": "Date",
    "open": "Open",
    "high": "High",
    "low": "Low",
    "close": "Close",
    "volume": "Volume",
}
