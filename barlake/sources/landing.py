"""Landed price files: one CSV text file per symbol, header line first.

Files are named ``{TICKER}.{EXCHANGE}.csv`` (or sit under a
``symbol={TICKER}.{EXCHANGE}`` folder, the layout Spark's partitioned text
writer produces).  Symbols by the hundred thousand come in bundles instead,
files under a ``layout=bundle`` folder that hold the files of many symbols:
each line is the symbol (percent-encoded), a tab and a line of that symbol's
file.  A line of a bundle counts as one of the member
``.../part-0.txt!/symbol={TICKER}.{EXCHANGE}/``, so members are told apart like
files; a line without a tab belongs to no symbol.  The header names the columns (``Date,Open,High,Low,Close,Volume``
in any order); every value arrives as text.  A reply with no data is a stub
holding the single line ``Value``.

The files are read line by line with Spark's text source, so no file has to
fit in one row: header lines are found by content (they name the ``Date``
column), joined back to the data lines of the same file, and every field is
picked by its header position, so a reordered header is read correctly.
Unparseable values become NULL; a line without a usable date or ticker goes
to the quarantine output instead of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import LANDING_FIELDS
from barlake.sources.tables import MAX_FILE_AGE

STUB_LINE = "Value"
DATE_FORMAT = "yyyy-MM-dd"
BUNDLE = "layout=bundle"


def symbol_of_path(path: Column) -> Column:
    """S4 reversed / S5: the symbol a file belongs to, from its path:
    ``.../NVDA.US.csv`` or ``.../symbol=NVDA.US/part-....txt``."""
    folder = F.regexp_extract(path, r"/symbol=([^/]+)/", 1)
    name = F.regexp_extract(path, r"([^/]+)\.csv$", 1)
    # Symbols in file and folder names are percent-encoded (a share class such
    # as BRK/B holds a slash; Spark's partitioned writer escapes '#' and the
    # like), and Spark reports file paths URL-encoded once more: decode twice.
    return F.url_decode(F.url_decode(F.when(folder != "", folder).otherwise(name)))


def split_symbol(sym: Column) -> tuple[Column, Column]:
    """``NVDA.US`` -> (``NVDA``, ``US``); a symbol without a dot has no exchange."""
    has_dot = sym.contains(".")
    ticker = F.when(has_dot, F.regexp_extract(sym, r"^(.*)\.[^.]*$", 1)).otherwise(sym)
    exchange = F.when(has_dot, F.regexp_extract(sym, r"\.([^.]*)$", 1))
    return ticker, exchange


def _members(lines: DataFrame) -> DataFrame:
    """(line, file, ...) with the lines of bundles as lines of their members."""
    tab = F.instr("line", "\t")
    inside = F.col("file").contains(f"/{BUNDLE}/") & (tab > 0)
    # Like the paths Spark reports, encoded once more than on disk.
    symbol = F.url_encode(F.substring_index("line", "\t", 1))
    return lines.withColumns({"line": F.when(inside, F.col("line").substr(tab + 1, F.length("line"))).otherwise(F.col("line")),
                              "file": F.when(inside, F.concat("file", F.lit("!/symbol="), symbol, F.lit("/"))).otherwise(F.col("file"))})


def stored_file(file: Column) -> Column:
    """The path of the file on disk that holds a landed file, itself or its bundle."""
    return F.regexp_replace(file, f"(/{BUNDLE}/[^/]+)!/symbol=[^/]*/$", "$1")


def landing_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every non-empty line of every landed file, with its file path."""
    lines = (spark.read.option("recursiveFileLookup", "true").text(path)
             .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")))
    return _members(lines).where(F.trim(F.col("line")) != "")


def parse_lines(lines: DataFrame, split: bool = True, extras: bool = False):
    """Lines -> (typed rows, quarantined lines); with ``split=False`` one frame
    holding both, told apart by a NULL / non-NULL ``reason``.  With ``extras``
    rows carry what their file's header names beyond the known columns.

    ``lines`` has columns ``line`` and ``file``.  The header of a file is the
    line that names most columns, among them ``Date``; only lines that hold
    that word are looked at.  Headers and lines are joined on the file path
    (one header row per file; AQE broadcasts that side at run time when it is
    small, and splits the lines of a long file when it is not).  Lines of the
    ``eod_landing`` source bring their header, ticker and exchange along.
    """
    # Fields with surrounding blanks removed (a regex split keeps this a
    # plain codegen'd expression; no per-element lambda).
    fields = F.split(F.trim(F.col("line")), r"\s*,\s*")
    named = F.col("line").contains(LANDING_FIELDS["date"]) & F.array_contains(fields, LANDING_FIELDS["date"])
    data = lines.where(F.trim(F.col("line")) != STUB_LINE)
    if "header" in lines.columns:
        joined = data.select("file", "line", "header", "ticker", "exchange", fields.alias("fields"), named.alias("named"))
    else:
        # Any other line with a field "Date" than the header is a line like the
        # rest and ends in quarantine.
        known = F.size(F.array_intersect(fields, F.array(*[F.lit(n) for n in LANDING_FIELDS.values()])))
        headers = (lines.where(named).groupBy("file").agg(F.max(F.struct(known.alias("known"), fields.alias("fields"))).alias("h"))
                   .select("file", F.col("h.fields").alias("header")))
        ticker, exchange = split_symbol(symbol_of_path(F.col("file")))
        joined = (data.select("file", "line", fields.alias("fields"), named.alias("named")).join(headers, "file", "left")
                  .withColumns({"ticker": ticker, "exchange": exchange}))
    joined = joined.where(~F.col("named") | ~F.col("fields").eqNullSafe(F.col("header")))

    def field(name: str) -> Column:
        pos = F.array_position(F.col("header"), LANDING_FIELDS[name]).cast("int")
        return F.when(pos > 0, F.try_element_at(F.col("fields"), pos))

    date_text = field("date")
    volume_text = field("volume")
    typed = joined.select(
        "file", "line", "header", "named",
        "ticker", "exchange",
        date_text.alias("date_text"),
        F.try_to_date(date_text, DATE_FORMAT).alias("date"),
        *[field(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.coalesce(volume_text.try_cast("bigint"),
                   volume_text.try_cast("double").try_cast("bigint")).alias("volume"),
        *([extra_fields().alias("extra")] if extras else []),
    )
    reason = (F.when(F.col("named"), F.lit("stray header"))
              .when(F.col("header").isNull(), F.lit("no header"))
              .when((F.col("ticker").isNull()) | (F.col("ticker") == ""), F.lit("no ticker"))
              .when(F.col("date").isNull(), F.lit("bad date")))
    typed = typed.withColumn("reason", reason)
    if not split:
        return typed
    good = typed.where(F.col("reason").isNull()).select(
        "ticker", "date", "open", "high", "low", "close", "volume", "exchange", *(["extra"] if extras else []))
    bad = typed.where(F.col("reason").isNotNull()).select(
        "file", "ticker", "date_text", "line", "reason")
    return good, bad


def extra_fields() -> Column:
    """The fields of a line under the header names no known column has, as a
    map of texts; a name that repeats counts once, the first time."""
    entry = F.transform("header", lambda name, i: F.struct(name.alias("key"), F.try_element_at("fields", i + 1).alias("value"), i.alias("i")))
    known = F.array(*[F.lit(n) for n in LANDING_FIELDS.values()])
    own = F.filter(entry, lambda e: ~F.array_contains(known, e["key"]) & (e["key"] != "") & (F.array_position("header", e["key"]) == e["i"] + 1)
                   & e["value"].isNotNull())
    return F.map_from_entries(F.transform(own, lambda e: F.struct(e["key"], e["value"])))


def union_landing(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """U1 with drift: files whose headers differ become one table by name.  A
    column a file lacks is NULL, and a column beyond the known ones is kept in
    ``extra``, so no header change loses a value."""
    return parse_lines(landing_lines(spark, path), extras=True)


def widened(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with extra columns of their own (texts, NULL where a file lacks
    them) instead of ``extra``."""
    return rows.select(*[c for c in rows.columns if c != "extra"], *[F.col("extra")[n].alias(n) for n in names])


def extra_names(rows: DataFrame) -> DataFrame:
    """(name, n_rows) of all extra columns: the merged header beyond the known one."""
    return rows.select(F.explode(F.map_keys("extra")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))


def read_landing(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Landed files -> (bars with exchange, quarantine)."""
    return parse_lines(landing_lines(spark, path))


def symbol_col(ticker: Column, exchange: str) -> Column:
    return F.concat_ws(".", F.upper(ticker), F.lit(exchange.upper()))


def standard_header() -> str:
    return ",".join(LANDING_FIELDS[c] for c in ("date", "open", "high", "low", "close", "volume"))


def standard_line() -> Column:
    return F.concat_ws(",", F.date_format("date", DATE_FORMAT),
                       *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in
                         ("open", "high", "low", "close", "volume")])


def write_symbol_files(lines: DataFrame, path: str) -> None:
    """Write (symbol, part, date, line) rows as one text file per symbol under
    ``path/symbol={symbol}/``, header first, with Spark's partitioned writer.
    One file holds one symbol's history, bounded by its trading days.  The
    number of tasks is fixed: opening files is the cost here, not their bytes,
    by which adaptive execution would merge the tasks into one."""
    width = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartition(width, "symbol").sortWithinPartitions("symbol", "part", "date")
     .select("symbol", "line").write.mode("append").partitionBy("symbol").text(path))


def write_bundles(lines: DataFrame, path: str) -> None:
    """Write the same rows as bundles under ``path/layout=bundle/``, a file a
    task, each symbol's lines together and its header first."""
    width = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartition(width, "symbol").sortWithinPartitions("symbol", "part", "date")
     .select(F.concat(F.url_encode("symbol"), F.lit("\t"), F.coalesce("line", F.lit(""))).alias("value")).write.mode("append").text(f"{path}/{BUNDLE}"))


def landing_rows(bars: DataFrame, exchange: str = "US", header: Column | None = None,
                 line: Column | None = None) -> DataFrame:
    """Bars as (symbol, part, date, line) rows: one header row per symbol
    (``header`` may depend on the ticker) and one data row per bar."""
    header = header if header is not None else F.lit(standard_header())
    line = line if line is not None else standard_line()
    rows = bars.select(symbol_col(F.col("ticker"), exchange).alias("symbol"), "date",
                       header.alias("header"), line.alias("line"))
    heads = (rows.groupBy("symbol").agg(F.min("header").alias("line"))
             .select("symbol", F.lit(0).alias("part"), F.lit(None).cast("date").alias("date"), "line"))
    return heads.unionByName(rows.select("symbol", F.lit(1).alias("part"), "date", "line"))


def write_landing(bars: DataFrame, path: str, exchange: str = "US") -> None:
    """Write bars as landed files in the standard layout."""
    write_symbol_files(landing_rows(bars, exchange), path)


def read_landing_source(spark: SparkSession, path: str, tickers: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The same through the ``eod_landing`` data source, of some tickers if asked."""
    from barlake.sources.eod_source import landing_rows_of

    return parse_lines(landing_rows_of(spark, path, tickers))


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed lines as a stream of Spark's text source: (line, file, modified)."""
    reader = spark.readStream.format("text").option("maxFileAge", MAX_FILE_AGE).option("recursiveFileLookup", "true")
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    return _members(reader.load(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                                             F.col("_metadata.file_modification_time").alias("modified")))


def source_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed lines as a stream of the ``eod_landing`` source, headers along."""
    from barlake.sources.eod_source import FORMAT, register

    register(spark)
    reader = spark.readStream.format(FORMAT)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


#: Loaders by name, for jobs that take the source as a setting: how a folder is
#: read at once, and as a stream.
LOADERS = {"text": (read_landing, text_stream), "eod_landing": (read_landing_source, source_stream)}


def loader(name: str):
    """(batch reader, stream reader) of a loader."""
    if name not in LOADERS:
        raise ValueError(f"unknown loader {name!r}; known: {', '.join(sorted(LOADERS))}")
    return LOADERS[name]
