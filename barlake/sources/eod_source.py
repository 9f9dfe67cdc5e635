"""Landed price files as a Spark data source: ``spark.read.format("eod_landing")``.

``register(spark)`` makes the format known.  A read gives one row per line
that is not empty, a stub or the header: (file, ticker, exchange, header,
line); ``landing.parse_lines`` turns those into typed rows and quarantine, so
this source and the text reader end in the same columns.

Planning lists the folder once, keeps the files of the asked tickers and
exchange (``ticker`` and ``exchange`` filters are pushed into the source, and
the ``tickers`` option does the same), cuts long files into ranges of bytes and
packs ranges into partitions of about ``partition_bytes``.  A task opens its
own ranges only; a range begins at the first line that starts in it, and reads
the file's header from its head.

The stream reader (``spark.readStream.format("eod_landing")``) moves by
(modification time, path): a batch holds the files after the last offset, as
many as ``maxFilesPerTrigger`` allows.  A file that appears with a time before
that offset would be missed, so deliveries must not carry older times.

A bundle (see ``landing``) is read whole by one task, which keeps the members
of the asked tickers; a member's lines stand together.

Files are read through Arrow's file systems, so a path needs a scheme that
those know (local, ``hdfs://``, ``s3://``, ``gs://``).  For stores that only
Spark reads, use the text reader (``landing.read_landing``).

Edge cases: a file without a header in its first ``HEAD`` bytes gives rows
with a null header (quarantined as such); a name without an exchange gives a
null exchange; bytes that are no UTF-8 become replacement characters; an empty
folder gives no rows, a missing one is an error for batch reads and empty for
streams.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby, islice
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In,
                                    InputPartition)

from barlake.schema import LANDING_FIELDS

FORMAT = "eod_landing"
SCHEMA = "file string, ticker string, exchange string, header array<string>, line string"
STUB_LINE = "Value"
#: Bytes of a partition, and what opening a file counts as.
PARTITION_BYTES, OPEN_BYTES = 64 << 20, 1 << 20
#: The header stands within so many bytes of a file's head.
HEAD = 1 << 16
#: The most lines of a member of a bundle among which its header is looked for.
HEAD_LINES = 2000
_ROWS = 8192
_NAME = re.compile(r"([^/]+)\.csv$")
_COMMA = re.compile(r"[ \t\n\x0b\f\r]*,[ \t\n\x0b\f\r]*")
_FOLDER = re.compile(r"/symbol=([^/]+)/")
_BUNDLE = "/layout=bundle/"
_ARROW = pa.schema([("file", pa.string()), ("ticker", pa.string()), ("exchange", pa.string()), ("header", pa.list_(pa.string())), ("line", pa.string())])


@dataclass
class FileRange:
    path: str
    start: int
    end: int
    ticker: str | None
    exchange: str | None


@dataclass
class Ranges(InputPartition):
    """Ranges of files that one task reads."""

    ranges: tuple[FileRange, ...]

    def __init__(self, ranges):
        super().__init__(None)
        self.ranges = tuple(ranges)


def split_path(path: str) -> tuple[str | None, str | None]:
    """(ticker, exchange) of a landed file, from its folder or its name; names
    are percent-encoded."""
    found = _FOLDER.search(path) or _NAME.search(path)
    if not found:
        return None, None
    ticker, dot, exchange = unquote_plus(found[1]).rpartition(".")
    return (ticker, exchange) if dot else (exchange, None)


def fields_of(line: str) -> list[str]:
    """The fields of a line without the blanks around them, as ``landing`` cuts it."""
    return _COMMA.split(line.strip(" "))


def known_names(line: str) -> int:
    """How many columns a line names; 0 unless it names the date."""
    fields = fields_of(line)
    return len(set(fields) & set(LANDING_FIELDS.values())) if LANDING_FIELDS["date"] in fields else 0


class _Landing:
    """What batch and stream readers share."""

    def __init__(self, options):
        self.path = options.get("path")
        if not self.path:
            raise ValueError(f"{FORMAT} needs a path")
        self.bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        asked = options.get("tickers")
        self.tickers = None if asked is None else {t.strip() for t in asked.split(",") if t.strip()}
        self.exchanges: set[str] | None = None

    def _system(self):
        from pyarrow import fs

        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", self.path))
        return fs.LocalFileSystem(), self.path

    def files(self, missing_ok: bool = False):
        """The folder's data files as Arrow's file infos, by path."""
        from pyarrow import fs

        system, root = self._system()
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=missing_ok, recursive=True))
        base = root.rstrip("/") + "/"
        hidden = re.compile(r"(^|/)[_.]")
        return sorted((f for f in found if f.is_file and f.size and not hidden.search(f.path.removeprefix(base))), key=lambda f: f.path)

    def ranges(self, infos) -> list[Ranges]:
        """Partitions over the files of the asked tickers and exchanges."""
        out: list[Ranges] = []
        held: list[FileRange] = []
        size = 0
        for f in infos:
            bundle = _BUNDLE in f.path
            ticker, exchange = (None, None) if bundle else split_path(f.path)
            if not bundle and not self._asked(ticker, exchange):
                continue
            step = f.size if bundle else self.bytes
            for start in range(0, f.size, step):
                part = FileRange(f.path, start, min(start + step, f.size), ticker, exchange)
                cost = part.end - part.start + OPEN_BYTES
                if held and size + cost > self.bytes:
                    out.append(Ranges(held))
                    held, size = [], 0
                held.append(part)
                size += cost
        return out + [Ranges(held)] if held else out

    def _asked(self, ticker: str | None, exchange: str | None) -> bool:
        return (self.tickers is None or ticker in self.tickers) and (self.exchanges is None or exchange in self.exchanges)

    def _members(self, path: str, lines: Iterator[str]) -> Iterator[tuple]:
        """The rows of a bundle's asked members, no more than ``HEAD_LINES``
        lines held."""
        for name, tagged in groupby(((name if tab else None, line if tab else name) for name, tab, line in (x.partition("\t") for x in lines)),
                                    key=lambda x: x[0]):
            file = path if name is None else f"{path}!/symbol={name}/"
            ticker, exchange = (None, None) if name is None else split_path(file)
            if not self._asked(ticker, exchange):
                continue
            own = (line for _, line in tagged)
            head = list(islice(own, HEAD_LINES))
            yield from _rows_of(file, ticker, exchange, _header(head), chain(head, own))

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        system, _ = self._system()
        rows: list[tuple] = []
        for part in partition.ranges if partition else ():  # without any, Spark plans one of nothing
            with system.open_input_file(part.path) as f:
                if _BUNDLE in part.path:
                    found = self._members(part.path, _lines(f, part.start, part.end))
                else:
                    header = _header(f.read(HEAD).decode("utf-8", "replace").splitlines())
                    found = _rows_of(part.path, part.ticker, part.exchange, header, _lines(f, part.start, part.end))
                for row in found:
                    rows.append(row)
                    if len(rows) >= _ROWS:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)


def _header(lines: list[str]) -> list[str] | None:
    """The fields of the line that names most columns, if one names the date."""
    best = max(lines, key=known_names, default="")
    return fields_of(best) if known_names(best) else None


def _rows_of(file: str, ticker: str | None, exchange: str | None, header: list[str] | None, lines: Iterator[str]) -> Iterator[tuple]:
    """A file's rows: its lines but blank ones, stubs and the header."""
    for line in lines:
        bare = line.strip(" ")
        if not bare or bare == STUB_LINE or (header and LANDING_FIELDS["date"] in bare and fields_of(line) == header):
            continue
        yield file, ticker, exchange, header, line


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _lines(f, start: int, end: int, block: int = 1 << 20) -> Iterator[str]:
    """The lines that start in [start, end) of a file; a line ends with a line
    feed, and a carriage return before it goes."""
    at = max(start - 1, 0)  # the byte before tells whether a line starts at ``start``
    f.seek(at)
    rest, first = b"", start > 0
    while True:
        data = f.read(block)
        if not data:
            break
        pieces = (rest + data).split(b"\n")
        rest = pieces.pop()
        for p in pieces:
            if first:
                first = False
            elif at >= end:
                return
            else:
                yield p.removesuffix(b"\r").decode("utf-8", "replace")
            at += len(p) + 1
        if at >= end and not first:
            return
    if rest and not first and at < end:
        yield rest.removesuffix(b"\r").decode("utf-8", "replace")


class LandingReader(_Landing, DataSourceReader):
    def pushFilters(self, filters: list[Filter]):
        """Takes equality and membership on ``ticker`` and ``exchange``."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in ("ticker", "exchange"):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            before = self.tickers if name == "ticker" else self.exchanges
            values = values if before is None else values & before
            if name == "ticker":
                self.tickers = values
            else:
                self.exchanges = values

    def partitions(self) -> list[Ranges]:
        return self.ranges(self.files())


class LandingStreamReader(_Landing, DataSourceStreamReader):
    def __init__(self, options):
        super().__init__(options)
        self.most = int(options.get("maxFilesPerTrigger", 0))
        self.done: tuple[int, str] = (-1, "")

    @staticmethod
    def _place(info) -> tuple[int, str]:
        return info.mtime_ns, info.path

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        places = sorted(self._place(f) for f in self.files(missing_ok=True))
        after = [p for p in places if p > self.done]
        if self.most:
            after = after[:self.most]
        if after:
            self.done = after[-1]
        return {"time": self.done[0], "path": self.done[1]}

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        low, high = ((o["time"], o["path"]) for o in (start, end))
        self.done = max(self.done, high)
        return self.ranges(f for f in self.files(missing_ok=True) if low < self._place(f) <= high)

    def commit(self, end: dict) -> None:
        self.done = max(self.done, (end["time"], end["path"]))


class LandingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandingReader:
        return LandingReader(self.options)

    def streamReader(self, schema) -> LandingStreamReader:
        return LandingStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take filters."""
    spark.dataSource.register(LandingSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def landing_rows_of(spark: SparkSession, path: str, tickers: list[str] | None = None) -> DataFrame:
    """The source's rows of a folder, of some tickers if asked."""
    register(spark)
    reader = spark.read.format(FORMAT)
    if tickers is not None:
        reader = reader.option("tickers", ",".join(tickers))
    return reader.load(path)
