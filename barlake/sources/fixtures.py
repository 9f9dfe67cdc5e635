"""Daily bars derived from the driver's tables, and faults added to them.

The driver's data are not prices, so bars are built from them with plain
aggregations (see FIXTURES.md):

* ``user``:       events grouped by (user_id, day)  -> one bar per user-day
* ``brand``:      lineitem x part grouped by (p_brand, ship day)
* ``event_type``: events grouped by (event_type, day)

All are ``groupBy`` aggregations with partial (map-side) aggregation, so a hot
key is pre-aggregated on every mapper before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import MEASURES
from barlake.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the fault rule (FIXTURES.md F4):
#   k = (days(date - 1995-01-01) * 7 + n * 3 + offset) mod 23
#   offsets: close 0, open 1, high 2, low 3, volume 4
#   k = 0 -> NULL, k = 5 -> negated, k = 11 -> 0, otherwise unchanged
# ---------------------------------------------------------------------------
FAULT_EPOCH = "1995-01-01"
FAULT_OFFSETS = {"close": 0, "open": 1, "high": 2, "low": 3, "volume": 4}
FAULT_MOD = 23
FAULT_NULL, FAULT_NEGATE, FAULT_ZERO = 0, 5, 11


def _ohlcv(value: Column, order_key: Column) -> list[Column]:
    return [
        F.min_by(value, order_key).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, order_key).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    ]


def bars_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("ts", "user_id", "value")
    return (ev.groupBy(F.col("user_id").cast("string").alias("ticker"),
                       F.col("ts").cast("date").alias("date"))
            .agg(*_ohlcv(F.col("value"), F.col("ts"))))


def bars_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("ts", "event_type", "value")
    return (ev.groupBy(F.col("event_type").alias("ticker"), F.col("ts").cast("date").alias("date"))
            .agg(*_ohlcv(F.col("value"), F.col("ts"))))


def bars_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a day as one bar of one series."""
    ev = read_table(spark, sf_dir, "events").select("ts", "user_id", "value")
    return ev.groupBy(F.lit("ALL").alias("ticker"), F.col("ts").cast("date").alias("date")).agg(
        *_ohlcv(F.col("value"), F.struct("ts", "user_id", "value")))


def bars_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # (l_orderkey, l_linenumber) is not unique: the price itself completes the
    # order key, so rows that tie have the same value.  The three are packed
    # into one decimal (7 digits of line and whole price, 4 of its decimals),
    # which a hash aggregation can hold, where a struct would sort all rows.
    price = F.col("l_extendedprice")
    key = (F.col("l_orderkey").cast("decimal(18,0)") * F.lit(10 ** 15).cast("decimal(16,0)")
           + (F.col("l_linenumber").cast("decimal(4,0)") * F.lit(10 ** 12).cast("decimal(13,0)")
              + F.round(price * 10_000).cast("decimal(12,0)")))
    joined = li.join(part, li.l_partkey == part.p_partkey, "inner").withColumn("key", key)
    return (joined.groupBy(F.col("p_brand").alias("ticker"), F.col("l_shipdate").cast("date").alias("date"))
            .agg(*_ohlcv(price, F.col("key"))))


BAR_KINDS = {"user": bars_user, "brand": bars_brand, "event_type": bars_event_type}


def bars(spark: SparkSession, sf_dir: str, kind: str = "user") -> DataFrame:
    return BAR_KINDS[kind](spark, sf_dir)


def ticker_number(kind: str) -> Column:
    """The integer n of the fault rule: the user id, or the brand's number."""
    if kind == "brand":
        return F.regexp_extract(F.col("ticker"), r"(\d+)$", 1).cast("int")
    return F.col("ticker").cast("bigint")


def dirty(df: DataFrame, kind: str = "user", measures=MEASURES) -> DataFrame:
    """Deterministic faults: some values become NULL, negative or zero."""
    n = ticker_number(kind)
    days = F.datediff(F.col("date"), F.lit(FAULT_EPOCH).cast("date"))
    out = []
    for c in df.columns:
        if c in measures:
            k = F.pmod(days * 7 + n * 3 + F.lit(FAULT_OFFSETS[c]), F.lit(FAULT_MOD))
            v = F.col(c)
            out.append(F.when(k == FAULT_NULL, F.lit(None).cast(df.schema[c].dataType))
                       .when(k == FAULT_NEGATE, -v)
                       .when(k == FAULT_ZERO, v * 0)
                       .otherwise(v).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def dirty_bars(spark: SparkSession, sf_dir: str, kind: str = "user") -> DataFrame:
    return dirty(bars(spark, sf_dir, kind), kind)


# --- Ingest fixtures (FIXTURES.md F6) ---------------------------------------
SINK_CUT = "2024-01-20"      # sink holds days up to and including this
UPDATE_FROM = "2024-01-15"   # batch starts here: 6 days overlap the sink
REPEATED_DAY = "2024-01-25"  # every bar of this day appears twice in the batch
CHANGED_DAY = "2024-01-16"   # every bar of this old day appears again, close doubled


def sink_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_user(spark, sf_dir).where(F.col("date") <= F.lit(SINK_CUT).cast("date"))


def update_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update batch: every bar from UPDATE_FROM on, plus a second copy
    of the REPEATED_DAY bars and a close-doubled copy of the CHANGED_DAY
    bars.  Built from one aggregation: each bar is fanned out to its copies
    (0 = batch, 1 = repeated, 2 = changed) and the copies it does not have
    are filtered away."""
    b = bars_user(spark, sf_dir)
    day = F.col("date")
    copy = F.col("__copy")
    fan = b.withColumn("__copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    keep = (((copy == 0) & (day >= F.lit(UPDATE_FROM).cast("date")))
            | ((copy == 1) & (day == F.lit(REPEATED_DAY).cast("date")))
            | ((copy == 2) & (day == F.lit(CHANGED_DAY).cast("date"))))
    return (fan.where(keep)
            .withColumn("close", F.when(copy == 2, F.col("close") * 2).otherwise(F.col("close")))
            .select(*b.columns))


def corrected_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update batch with the loaded CHANGED_DAY corrected: a copy of its
    bars with half the close, which wins over the plain copy."""
    b = update_bars(spark, sf_dir)
    day = bars_user(spark, sf_dir).where(F.col("date") == F.lit(CHANGED_DAY).cast("date"))
    plain = b.where((F.col("date") != F.lit(CHANGED_DAY).cast("date")))
    return plain.unionByName(day).unionByName(day.withColumn("close", F.col("close") / 2))


NO_DATA_TICKER = "NODATA"    # configured ticker with no rows: takes the default date
INGEST_AS_OF = "2024-01-20"  # load date of the fixture plan: tickers loaded to it are skipped


def fixture_universe(spark: SparkSession, sf_dir: str, exchange: str = "US") -> DataFrame:
    """Every ticker of the user bars plus one that has no data."""
    tickers = bars_user(spark, sf_dir).select("ticker").distinct()
    extra = spark.range(1).select(F.lit(NO_DATA_TICKER).alias("ticker"))
    return tickers.unionByName(extra).select(F.lit(exchange).alias("exchange"), "ticker")


# --- Landing fixture (FIXTURES.md F6) -----------------------------------------
# Faults of the landed text, same rule as above with further offsets:
#   offset 5, k = 0 -> date written as yyyy/MM/dd (not ISO: quarantined)
#   offset 6, k = 0 -> the last field of the line is missing (a short row)
# Odd-numbered tickers use the reordered header below; NULL values are
# written as the text "bad"; the ticker without data gets a stub file.
LANDING_BAD_DATE_OFFSET = 5
LANDING_SHORT_OFFSET = 6
REORDERED_HEADER = ["date", "close", "volume", "open", "high", "low"]
BAD_CELL = "bad"


def _fault_k(kind: str, offset: int) -> Column:
    days = F.datediff(F.col("date"), F.lit(FAULT_EPOCH).cast("date"))
    return F.pmod(days * 7 + ticker_number(kind) * 3 + F.lit(offset), F.lit(FAULT_MOD))


def fixture_landing_rows(bars_df: DataFrame, kind: str = "user", exchange: str = "US") -> DataFrame:
    from barlake.schema import LANDING_FIELDS
    from barlake.sources.landing import landing_rows

    standard = ["date", "open", "high", "low", "close", "volume"]
    reordered = F.pmod(ticker_number(kind), F.lit(2)) == 1

    def texts(order):
        out = []
        for c in order:
            if c == "date":
                out.append(F.when(_fault_k(kind, LANDING_BAD_DATE_OFFSET) == 0,
                                  F.date_format("date", "yyyy/MM/dd"))
                           .otherwise(F.date_format("date", "yyyy-MM-dd")))
            else:
                out.append(F.coalesce(F.col(c).cast("string"), F.lit(BAD_CELL)))
        return F.array(*out)

    fields = F.when(reordered, texts(REORDERED_HEADER)).otherwise(texts(standard))
    short = _fault_k(kind, LANDING_SHORT_OFFSET) == 0
    fields = F.when(short, F.slice(fields, 1, 5)).otherwise(fields)
    header = F.when(reordered, F.lit(",".join(LANDING_FIELDS[c] for c in REORDERED_HEADER))) \
        .otherwise(F.lit(",".join(LANDING_FIELDS[c] for c in standard)))
    return landing_rows(bars_df, exchange, header=header, line=F.array_join(fields, ","))


def stub_rows(spark: SparkSession, exchange: str = "US") -> DataFrame:
    """The reply for a ticker without data: a file holding only ``Value``."""
    from barlake.sources.landing import STUB_LINE
    return spark.range(1).select(F.lit(f"{NO_DATA_TICKER}.{exchange}").alias("symbol"),
                                 F.lit(0).alias("part"), F.lit(None).cast("date").alias("date"),
                                 F.lit(STUB_LINE).alias("line"))


def write_fixture_landing(spark: SparkSession, sf_dir: str, path: str,
                          date_filter: Column | None = None, with_stub: bool = True, bundled: bool = False) -> str:
    """Landed files for the dirty user bars (optionally only some days), one
    per symbol or the same in bundles."""
    from barlake.sources.landing import write_bundles, write_symbol_files

    b = dirty_bars(spark, sf_dir, "user")
    if date_filter is not None:
        b = b.where(date_filter)
    rows = fixture_landing_rows(b, "user")
    if with_stub:
        rows = rows.unionByName(stub_rows(spark))
    (write_bundles if bundled else write_symbol_files)(rows, path)
    return path


def write_drift_landing(spark: SparkSession, sf_dir: str, path: str, bundled: bool = False) -> str:
    """Landed files of the user bars with two headers: odd tickers have a
    further column (``Trades``, three times the volume), even ones no volume."""
    from barlake.schema import LANDING_FIELDS
    from barlake.sources.landing import landing_rows, write_bundles, write_symbol_files

    odd = F.pmod(ticker_number("user"), F.lit(2)) == 1
    price = [F.col(c).cast("string") for c in ("open", "high", "low", "close")]
    day = F.date_format("date", "yyyy-MM-dd")
    more = F.concat_ws(",", (F.col("volume") * 3).cast("string"), day, *price, F.col("volume").cast("string"))
    names = [LANDING_FIELDS[c] for c in ("date", "open", "high", "low", "close")]
    header = F.when(odd, F.lit(",".join(["Trades", *names, LANDING_FIELDS["volume"]]))).otherwise(F.lit(",".join(names)))
    rows = landing_rows(bars_user(spark, sf_dir), header=header, line=F.when(odd, more).otherwise(F.concat_ws(",", day, *price)))
    (write_bundles if bundled else write_symbol_files)(rows, path)
    return path
