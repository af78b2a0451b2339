"""Delimited files whose quoted values may hold line breaks, read by ranges of bytes.

Whether a range begins inside a quoted value is told by the number of quotes before it. A first pass counts the quotes of
every range, one number for each; added up along the file they give the parity at each range's start. A second pass reads the ranges:
a task skips to the first line end outside quotes and reads every record that begins in its range, on beyond the range's end where
the last one does. A record is read once, whatever it spans, and no file is read as a whole.

Ranges are of a fixed size, so both passes agree on them whatever the cluster looks like. Quotes stand around values and are doubled
inside them; a single quote inside an unquoted value would be taken for the begin of a quoted one.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions.text import na_to_null
from cellweave.session import settle

RANGE_BYTES = 64 << 20
CHUNK_BYTES = 1 << 20
BATCH_RECORDS = 5_000
QUOTE, BREAK, MARK = b'"', b"\n", b"\xef\xbb\xbf"
# Stands for a carriage return in an unquoted value, which the parser would refuse. No text uses it (private use area).
RETURN = "\ue00d"


def read_quoted(spark: SparkSession, paths: list[str] | str, separator: str = ",", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Grid rows of delimited files; every value is text, and ``row_idx`` is the byte at which the record begins.

    Lines end with a line feed, with or without a carriage return before it. Empty lines are left out. Files are UTF-8
    and not compressed.
    """
    ranges = settle(_parities(_ranges(spark, paths, range_bytes)))
    read = _spread(ranges).mapInArrow(_reader(separator), "path string, row_idx long, values array<string>")
    return read.select(
        "path",
        F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("sheet"),
        F.lit(0).alias("sheet_idx"),
        "row_idx",
        F.transform("values", na_to_null).alias("values"),
    )


def _ranges(spark: SparkSession, paths: list[str] | str, size: int) -> DataFrame:
    """``path``, ``start``, ``end`` of every range; only the files' lengths are read."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length").filter("length > 0")
    each = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("start"))
    return each.select("path", "start", F.least(F.col("start") + size, "length").alias("end"))


def _spread(ranges: DataFrame) -> DataFrame:
    """Ranges dealt over the tasks, since many of them lie in one small table."""
    return ranges.repartition("path", "start")


def _parities(ranges: DataFrame) -> DataFrame:
    """Ranges with ``inside``: whether their first byte lies in a quoted value."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in _rows(batch, "path", "start", "end"):
                with _opened(path) as file:
                    file.seek(start)
                    quotes, left = 0, end - start
                    while left and (chunk := file.read(min(left, CHUNK_BYTES))):
                        quotes += chunk.count(QUOTE)
                        left -= len(chunk)
                yield pa.RecordBatch.from_pylist([{"path": path, "start": start, "end": end, "quotes": quotes}])

    counted = _spread(ranges).mapInArrow(count, "path string, start long, end long, quotes long")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return counted.select("path", "start", "end", odd.alias("inside"))


def _reader(separator: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            for path, start, end, inside in _rows(batch, "path", "start", "end", "inside"):
                with _opened(path) as file:
                    held: list[tuple[int, str]] = []
                    for record in records(file, start, end, inside):
                        held.append(record)
                        if len(held) == BATCH_RECORDS:
                            yield _frame(path, held, separator)
                            held = []
                    if held:
                        yield _frame(path, held, separator)

    return work


def records(file, start: int, end: int, inside: bool) -> Iterator[tuple[int, str]]:
    """The records that begin behind ``start`` and not behind ``end``, or at 0, with the byte at which they begin."""
    parts: list[bytes] = []
    first, skipping = start, start > 0
    for at, line in _lines(file, start):
        if not parts and at > end:
            return
        if line.count(QUOTE) % 2:
            inside = not inside
        if skipping:
            # The record this line belongs to begins at ``start`` or before it.
            skipping = inside
            continue
        if not parts:
            first = at
        parts.append(line)
        if not inside:
            yield first, _text(first, parts)
            parts = []
    if parts:
        yield first, _text(first, parts)


def _text(at: int, lines: list[bytes]) -> str:
    whole = BREAK.join(lines)
    whole = whole.removeprefix(MARK) if at == 0 else whole
    return whole.removesuffix(b"\r").decode(errors="replace")


def _lines(file, start: int) -> Iterator[tuple[int, bytes]]:
    """Lines from a byte on, with their places; read a chunk at a time."""
    file.seek(start)
    at, held = start, []
    while chunk := file.read(CHUNK_BYTES):
        *whole, rest = chunk.split(BREAK)
        for line in whole:
            held.append(line)
            line = b"".join(held)
            held = []
            yield at, line
            at += len(line) + 1
        held.append(rest)
    if last := b"".join(held):
        yield at, last


def _frame(path: str, held: list[tuple[int, str]], separator: str) -> pa.RecordBatch:
    parsed = [(at, values) for at, text in held if (values := fields(text, separator))]
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(parsed), pa.string()), pa.array([a for a, _ in parsed], pa.int64()), pa.array([v for _, v in parsed], pa.list_(pa.string()))],
        ["path", "row_idx", "values"],
    )


def fields(record: str, separator: str) -> list[str]:
    """Values of a record."""
    if QUOTE.decode() not in record:
        return record.split(separator) if record else []
    marked = record.replace("\r", RETURN)
    return [v.replace(RETURN, "\r") for v in next(csv.reader([marked], delimiter=separator))]


def _opened(uri: str):
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + uri[5:].lstrip("/"))
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _rows(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
