"""Delimited files with quoted line breaks, read in byte ranges by many tasks.

A byte range does not tell whether its first line is the start of a record or lies inside a quoted field. So a
first pass follows the quotes of each range from both states at once, which gives the state behind it
for either; ranges in order then have one state each. The second pass starts every range at its first true record.
A record that goes on in later ranges is put together from its pieces, and only those are shuffled.
"""

from __future__ import annotations

import csv
import re
import sys
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workers get the functions below with the task, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
# So many runs of ranges are named in a filter.
MOST_RUNS = 200
# Encodings in which quotes, separators and line feeds are the bytes that ASCII has.
ASCII_LIKE = {"UTF-8", "ISO-8859-1", "US-ASCII", "WINDOWS-1252", "CP1252", "ISO-8859-15"}
BYTE_ORDER_MARK = b"\xef\xbb\xbf"


class Quotes:
    """Where records end in lines, each with its line feed.

    A field is quoted if its first character is a quote; two quotes in it are one. What follows the closing
    quote belongs to the field, up to the separator.
    """

    def __init__(self, sep: str) -> None:
        s = re.escape(sep.encode())
        rest = rb"(?:[^" + s + rb"])*+"
        quoted = rb'(?:[^"]++|"")*+"' + rest
        plain = rb'(?!")' + rest
        more = rb"(?:" + s + rb'(?:"' + quoted + rb"|" + plain + rb"))*+"
        self.from_outside = re.compile(rb'(?:"' + quoted + rb"|" + plain + rb")" + more)
        self.from_inside = re.compile(quoted + more)
        self.beside = np.zeros(256, dtype=bool)
        self.beside[[ord(sep), ord(QUOTE), 10, 13]] = True

    def inside_after(self, line: bytes, inside: bool) -> bool:
        """Does a line end inside a quoted field, from how it begins?"""
        if b'"' not in line:
            return inside
        return (self.from_inside if inside else self.from_outside).fullmatch(line) is None

    def ends(self, data: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
        """Behind which bytes records end, and whether the data end inside a quoted field.

        If every quote that opens a field stands behind a separator, and every one that closes it before one, an
        even number of quotes before a line feed tells that it ends a record. Otherwise line by line.
        """
        feeds = np.flatnonzero(data == 10) + 1
        quotes = np.flatnonzero(data == 34)
        if not len(quotes):
            return (feeds[:0] if inside else feeds), inside
        opens, closes = quotes[int(inside) :: 2], quotes[1 - int(inside) :: 2]
        before, after = data[opens - 1], data[np.minimum(closes + 1, len(data) - 1)]
        if self.beside[before[opens > 0]].all() and self.beside[after].all():
            odd = (np.searchsorted(quotes, feeds) + inside) % 2 == 1
            return feeds[~odd], bool((len(quotes) + inside) % 2)
        found, begin, whole = [], 0, data.tobytes()
        for feed in feeds.tolist():
            inside = self.inside_after(whole[begin : feed - 1], inside)
            if not inside:
                found.append(feed)
            begin = feed
        return np.array(found, dtype=np.int64), inside


@dataclass(frozen=True)
class Layout:
    """What the first pass has found, by the hash of a file's path: headers, states behind ranges, and files of CRLF lines."""

    headers: dict[int, bytes] = field(default_factory=dict)
    returns: frozenset[int] = frozenset()
    states: dict[int, tuple[list[int], list[bool]]] = field(default_factory=dict)
    # A file's first range has no whole record.
    open_header: bool = False
    # Files that are not valid UTF-8.
    invalid: frozenset[int] = frozenset()

    def of(self, file: int) -> Layout:
        """The part for one file."""
        keep = {file}
        return Layout(
            {f: h for f, h in self.headers.items() if f in keep}, self.returns & keep, {f: s for f, s in self.states.items() if f in keep},
            self.open_header and file not in self.headers, self.invalid & keep,
        )

    def begins_inside(self, file: int, start: int) -> bool:
        """Does a range begin inside a quoted field? Ranges without a quote leave the state as it is."""
        if file not in self.states:
            return False
        starts, inside = self.states[file]
        at = bisect_left(starts, start)
        return at > 0 and inside[at - 1]

    def ends_inside(self, file: int, start: int) -> bool:
        """Does a range end inside a quoted field?"""
        return self.begins_inside(file, start + 1)

    def crossing(self) -> list[tuple[int, int, float]]:
        """``(file, first, last)``: runs of ranges over whose edges a record goes."""
        runs: list[tuple[int, int, float]] = []
        for file, (starts, inside) in self.states.items():
            for at, (start, is_inside) in enumerate(zip(starts, inside, strict=True)):
                if is_inside:
                    last = starts[at + 1] if at + 1 < len(starts) else float("inf")
                    if runs and runs[-1][0] == file and runs[-1][2] == start:
                        runs[-1] = (file, runs[-1][1], last)
                    else:
                        runs.append((file, start, last))
        return runs

    def may_cross(self) -> Column:
        """Lines of those runs; of all files that have one, if there are very many."""
        runs = self.crossing()
        if len(runs) > MOST_RUNS:
            return F.col("file").isin(*self.states) if len(self.states) <= MOST_RUNS else F.lit(True)
        return reduce(Column.__or__, [
            (F.col("file") == f) & (F.col("start") >= a) & ((F.col("start") <= b) if b < float("inf") else F.lit(True)) for f, a, b in runs
        ])


def lines(spark: SparkSession, path: str | list[str], **options: object) -> DataFrame:
    """``(file, start, line)``: all lines, each with a line feed, with the hash of their file's path and the start of their range."""
    text = spark.read.options(**options).text(path, lineSep="\n")
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.concat("value", F.lit("\n")).cast("binary").alias("line"),
    )


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """The bytes of each run of lines of one range within a batch; a range's lines come in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        values = batch.column(2)
        offsets = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset : values.offset + len(values) + 1]
        data = np.frombuffer(values.buffers()[2], dtype=np.uint8)
        edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1
        for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(files)], strict=True):
            yield (int(files[begin]), int(starts[begin])), data[offsets[begin] : offsets[end]]


def survey(spark: SparkSession, path: str | list[str], sep: str, **options: object) -> Layout:
    """The first pass: lines with a quote or without a meaning in UTF-8, and each file's first range for its header, reach Python.

    One row per range with a quote reaches the driver: some bytes for each hundred megabytes. ``options`` choose files.
    """
    quotes = Quotes(sep)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for key, data in ranges(batches):
            # States from outside and from inside, header, what there is of it, CRLF, valid UTF-8.
            own = found.setdefault(key, [False, True, None, b"", None, True])
            own[5] = own[5] and is_utf8(data.tobytes())
            if key[1] == 0 and own[2] is None:
                text = own[3] + data.tobytes()
                own[4] = text.partition(b"\n")[0].endswith(b"\r")
                stop = quotes.ends(np.frombuffer(text, dtype=np.uint8), False)[0][:1].tolist()
                own[2], own[3] = (text[: stop[0] - 1], b"") if stop else (None, text)
            if own[0] != own[1]:
                # The wrong one of two states becomes the right one within a few lines.
                text, begin = data.tobytes(), 0
                while own[0] != own[1] and (feed := text.find(b"\n", begin)) >= 0:
                    own[:2] = (quotes.inside_after(text[begin:feed], state) for state in own[:2])
                    begin = feed + 1
                data = data[begin:]
            own[0] = quotes.ends(data, own[0])[1] if len(data) else own[0]
            own[1] = own[0] if len(data) else own[1]
        rows = [(*key, own[0], own[1], own[2], own[4], own[5]) for key, own in found.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.bool_(), pa.bool_()), strict=True)],
            names=["file", "start", "outside", "inside", "header", "returns", "valid"],
        )

    text = F.col("line").cast("string")
    wanted = lines(spark, path, **options).filter(F.contains(text, F.lit(QUOTE)) | ~F.is_valid_utf8(text) | (F.col("start") == 0))
    found = wanted.mapInArrow(
        follow, "file long, start long, outside boolean, inside boolean, header binary, returns boolean, valid boolean"
    ).collect()
    headers, states = {}, {}
    state, before = False, None
    for r in sorted(found, key=lambda r: (r["file"], r["start"])):
        state = r["inside"] if r["file"] == before and state else r["outside"]
        before = r["file"]
        starts, inside = states.setdefault(r["file"], ([], []))
        starts.append(r["start"])
        inside.append(state)
        if r["header"] is not None:
            header = bytes(r["header"]).removeprefix(BYTE_ORDER_MARK)
            headers[r["file"]] = header.replace(b"\r\n", b"\n").removesuffix(b"\r") if r["returns"] else header
    return Layout(
        headers, frozenset(r["file"] for r in found if r["returns"]), {f: s for f, s in states.items() if any(s[1])},
        any(r["start"] == 0 and r["header"] is None for r in found), frozenset(r["file"] for r in found if not r["valid"]),
    )


def is_utf8(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


HEAD, TAIL = 1, 2


def records(spark: SparkSession, path: str | list[str], sep: str, layout: Layout) -> DataFrame:
    """``record``: the bytes of every record but the headers, each once, with its line feed."""
    quotes = Quotes(sep)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray, bool]]:
        """Per run of lines: bytes from the start of a record (of the range, if that begins inside one), and where records end.

        What is behind the last end comes again with the next lines of the range; ``True`` tells that the range is over.
        """
        key, inside, rest = None, False, np.zeros(0, dtype=np.uint8)
        for new, data in ranges(batches):
            if new != key:
                if key is not None:
                    yield key, rest, np.zeros(0, dtype=np.int64), True
                key, inside, rest = new, layout.begins_inside(*new), rest[:0]
            if key[0] in layout.returns:
                data = np.frombuffer(data.tobytes().replace(b"\r\n", b"\n"), dtype=np.uint8)
            data = np.concatenate([rest, data]) if len(rest) else data
            ends = quotes.ends(data, inside)[0]
            yield key, data, ends, False
            if len(ends):
                inside, data = False, data[ends[-1] :]
            rest = data
        if key is not None:
            yield key, rest, np.zeros(0, dtype=np.int64), True

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records that begin and end in their range."""
        key, skip = None, False
        for new, data, ends, _ in cut(batches):
            if new != key:
                # The first record is a header, or the rest of one that begins in an earlier range.
                key, skip = new, new[1] == 0 or layout.begins_inside(*new)
            starts = np.concatenate([[0], ends]).astype(np.int32)
            if skip and len(ends):
                starts, skip = starts[1:], False
            if len(starts) > 1:
                yield pa.RecordBatch.from_arrays(
                    [pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data))])], names=["record"]
                )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a range has of records that begin before it or end behind it."""
        key, head = None, False
        for new, data, ends, over in cut(batches):
            if new != key:
                key, head = new, layout.begins_inside(*new)
            kind = HEAD if head else TAIL
            piece = data[: ends[0]] if head and len(ends) else data if over and len(data) and layout.ends_inside(*new) else None
            head = head and not len(ends)
            if piece is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip((*new, kind, piece.tobytes()), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
                    names=["file", "start", "kind", "record"],
                )

    every = lines(spark, path)
    found = every.mapInArrow(whole, "record binary")
    if not layout.states:
        return found
    crossing = every.filter(layout.may_cross()).mapInArrow(pieces, "file long, start long, kind int, record binary")
    return found.unionByName(assembled(crossing))


def assembled(pieces: DataFrame) -> DataFrame:
    """``record`` from its tail at the end of one range and its heads in the next ones; at most two pieces per range."""
    in_order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A piece belongs to the last tail that is not behind it.
    owner = F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(in_order)
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "record")))
    text = F.array_join(F.transform(parts, lambda p: p["record"].cast("string")), "")
    return pieces.withColumn("owner", owner).groupBy("file", "owner").agg(text.cast("binary").alias("record")).select("record")


def column_names(header: bytes, sep: str, encoding: str) -> list[str]:
    """Names of a header record: empty ones and repeated ones carry their position."""
    names = next(csv.reader([header.decode(encoding, "replace")], delimiter=sep), [])
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def decoded(record: Column, encoding: str) -> Column:
    """A record as text, without its line feed."""
    text = F.make_valid_utf8(record.cast("string")) if encoding.upper() == "UTF-8" else F.decode(record, encoding)
    return F.when(text.endswith("\n"), F.left(text, F.length(text) - 1)).otherwise(text)


def parsed(records: DataFrame, schema: T.StructType, sep: str, encoding: str) -> DataFrame:
    """The columns of each record; empty lines are no records."""
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "lineSep": "\n", "inputBufferSize": "1024"}
    text = records.select(decoded(F.col("record"), encoding).alias("text")).filter("text <> ''")
    return text.select(F.from_csv("text", ddl, options).alias("r")).select("r.*")


def whole_files(spark: SparkSession, sep: str, encoding: str, schema: T.StructType | None = None, infer: bool = False) -> DataFrameReader:
    """Spark's own reader of records with line breaks, which reads a file by one task."""
    reader = spark.read.options(header=True, sep=sep, encoding=encoding, quote=QUOTE, escape=QUOTE, multiLine=True, enforceSchema=False)
    return reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)


def read_records(
    spark: SparkSession, path: str | list[str], sep: str, schema: T.StructType | None = None, encoding: str = "UTF-8", layout: Layout | None = None
) -> DataFrame:
    """Delimited files with a header in each, read by as many tasks as they have byte ranges.

    Equal to Spark's whole-file (``multiLine``) reading of files whose lines end in LF or CRLF; in files whose first
    line ends in CRLF, that is one line feed in quoted fields, too. All columns are text without a ``schema``, whose names must be those of the header. The first pass runs when this is called,
    unless its ``layout`` is given.
    """
    layout = layout or survey(spark, path, sep)
    if layout.open_header:
        return whole_files(spark, sep, encoding, schema).csv(path)
    headers = {tuple(n.lower() for n in column_names(h, sep, encoding)) for h in layout.headers.values()}
    if len(headers) > 1:
        raise ValueError(f"the files have different headers: {sorted(headers)[:3]}")
    if not headers:
        return spark.read.schema(schema or T.StructType()).csv(path)
    names = column_names(next(iter(layout.headers.values())), sep, encoding)
    if schema is None:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif [f.name.lower() for f in schema] != [n.lower() for n in names]:
        raise ValueError(f"the header {names} is not that of the schema {schema.names}")
    return parsed(records(spark, path, sep, layout), schema, sep, encoding)
