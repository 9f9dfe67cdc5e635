"""Clustered layout: rows near in ticker and in date lie in one file.

A table partitioned by date answers a day from one folder and a ticker from
all of them; one sorted by ticker the other way round.  ``write_clustered``
interleaves the bits of both places, so the files cut the (ticker, date) plane
into rectangles: the minima and maxima in the footers then let a scan skip
most files for a ticker as well as for a day.

Places are ranks, not values: the rank of a ticker among all tickers and of a
day among all days, each cut to ``BITS`` bits, so that skewed names or gaps in
the calendar do not empty the curve's cells.  Ranks come from ranges of the
distinct values (``operators.ordered``), which no task holds whole.  Files hold
about ``file_rows`` rows; a rectangle with more rows is split between files.

Edge cases: a null ticker or date ranks first; an empty table is written as
one without rows; other columns go along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.operators.ordered import sum_before
from barlake.operators.segmented import BLOCK_ROWS
from barlake.schema import KEY, ORDER

BITS = 16
#: Joins with the ranks are dealt over so many shares of each value's rows.
SHARES = 8


def ranked(df: DataFrame, column: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(value, place) per distinct value: its rank, scaled to ``BITS`` bits."""
    values = df.select(F.col(column).alias("value")).distinct().withColumn("one", F.lit(0))
    order = [F.col("one"), F.col("value").asc_nulls_first()]
    placed = sum_before(values, "one", order, F.lit(1), "rank", block_rows)
    n = values.count()
    return placed.select("value", F.expr(f"cast(rank * {1 << BITS} div {max(n, 1)} AS bigint)").alias("place"))


def interleaved(places: list[Column]) -> Column:
    """Bits of the places in turn, the first column's highest first."""
    terms = [F.shiftleft(F.shiftright(p, i).bitwiseAND(F.lit(1).cast("bigint")), i * len(places) + len(places) - 1 - j)
             for j, p in enumerate(places) for i in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), terms)


def clustered(df: DataFrame, columns: list[str] | tuple[str, ...] = (KEY, ORDER), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``__place``, its place on the curve through the columns."""
    out = df
    for i, c in enumerate(columns):
        # Every value's row is repeated per share, so a hot value's rows are dealt over them.
        places = ranked(df, c, block_rows).select(F.col("value").alias(f"__v{i}"), F.col("place").alias(f"__p{i}"),
                                                  F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias(f"__s{i}"))
        share = F.pmod(F.xxhash64(*df.columns), F.lit(SHARES)).cast("int")
        out = out.join(places, F.col(c).eqNullSafe(F.col(f"__v{i}")) & (share == F.col(f"__s{i}")))
    return out.select(*df.columns, interleaved([F.col(f"__p{i}") for i in range(len(columns))]).alias("__place"))


def write_clustered(df: DataFrame, path: str, file_rows: int = 1_000_000, columns: list[str] | tuple[str, ...] = (KEY, ORDER),
                    block_rows: int = BLOCK_ROWS) -> int:
    """Write ``df`` in files of about ``file_rows`` rows along the curve;
    returns their number."""
    files = max(1, -(-df.count() // file_rows))
    placed = clustered(df, columns, block_rows)
    # Rows of one cell may fill several files, so the columns complete the order.
    dealt = placed.repartitionByRange(files, "__place", *columns).sortWithinPartitions("__place", *columns)
    dealt.drop("__place").write.mode("errorifexists").parquet(path)
    return files
