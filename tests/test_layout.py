"""A clustered table: the files a ticker or a day needs, by their footers."""

import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from barlake.schema import BARS_SCHEMA
from barlake.sources import fixtures as FX
from barlake.sources import layout


def _spans(path):
    """Per file the least and greatest value of each column, from its footer."""
    out = []
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        span = {}
        for g in range(meta.num_row_groups):
            for i, n in enumerate(names):
                s = meta.row_group(g).column(i).statistics
                if s is not None and s.has_min_max:
                    lo, hi = span.get(n, (s.min, s.max))
                    span[n] = (min(lo, s.min), max(hi, s.max))
        out.append((meta.num_rows, span))
    return out


def test_a_ticker_and_a_day_open_few_files(spark, tmp_path):
    rows = spark.range(64 * 64).select(
        F.format_string("T%03d", F.col("id") % 64).alias("ticker"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 64).cast("int")).alias("date"),
        F.lit(1.0).alias("close"))
    layout.write_clustered(rows.repartition(5), f"{tmp_path}/t", file_rows=64, block_rows=100)
    spans = _spans(f"{tmp_path}/t")
    assert len(spans) == 64 and max(n for n, _ in spans) <= 128
    hit = lambda c, v: sum(s[c][0] <= v <= s[c][1] for _, s in spans)
    assert max(hit("ticker", f"T{i:03d}") for i in range(64)) <= 16
    assert max(hit("date", dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(64)) <= 16
    assert spark.read.parquet(f"{tmp_path}/t").exceptAll(rows).count() == 0


def test_clustered_keeps_all_rows_with_nulls_and_hot_values(spark, sf_small, tmp_path):
    bars = FX.bars(spark, sf_small, "user").select(*BARS_SCHEMA.fieldNames())
    hot = spark.range(500).select(F.lit("HOT").alias("ticker"), F.lit("2024-01-05").cast("date").alias("date"), *[F.lit(None).cast("double").alias(c) for c in (
        "open", "high", "low", "close")], F.col("id").alias("volume"))
    nulls = bars.limit(3).withColumn("ticker", F.lit(None).cast("string")).unionByName(bars.limit(2).withColumn("date", F.lit(None).cast("date")))
    rows = bars.unionByName(hot).unionByName(nulls).checkpoint()
    files = layout.write_clustered(rows, f"{tmp_path}/t", file_rows=200, block_rows=64)
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == rows.count() and back.exceptAll(rows).count() == 0
    assert len(glob.glob(f"{tmp_path}/t/*.parquet")) <= files
    layout.write_clustered(rows.limit(0), f"{tmp_path}/e")
    assert spark.read.schema(BARS_SCHEMA).parquet(f"{tmp_path}/e").count() == 0
