"""Workbooks (.xlsx) to grid rows.

First the zip is opened and every sheet becomes a record of its own, carrying the compressed sheet
and what is needed to read it; these records are spread over the tasks, so the sheets of a large
workbook decode in parallel. A sheet is parsed as a stream and yields rows batch by batch.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.text import NA_TOKENS
from cellweave.operators.shape import ROWS
from cellweave.session import task_count
from cellweave.sources.listing import ARROW_SCHEMES, SCHEME, arrow_path, literal_path, qualified

SHEETS = (
    "path string, sheet string, sheet_idx int, n_sheets int, part binary, strings binary, "
    "date_styles array<int>, date1904 boolean, error string"
)
# Built-in number formats that show a date or a time.
BUILTIN_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
BATCH_ROWS = 5_000
# Row number that marks a sheet which could not be read.
BROKEN_ROW = -1
CHUNK_BYTES = 1 << 20
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def read_workbooks(spark: SparkSession, paths: list[str] | str, first_sheet_only: bool = False) -> DataFrame:
    """All sheets of the workbooks as grid rows. A file that cannot be opened fails the read with its reason."""
    sheets = list_sheets(spark, paths, first_sheet_only)
    reason = F.concat_ws(": ", "path", "error")
    sheets = sheets.withColumn("path", F.when(F.col("error").isNull(), F.col("path")).otherwise(F.raise_error(reason)))
    return decode_sheets(sheets)


def list_sheets(spark: SparkSession, paths: list[str] | str, first_only: bool = False) -> DataFrame:
    """One record per sheet, or one with an error for a file that cannot be opened. ``first_only`` unpacks no sheet but the first."""
    return open_workbooks(spark.read.format("binaryFile").load(paths), first_only)


def list_sheets_of(spark: SparkSession, files: list[str]) -> DataFrame:
    """``list_sheets`` of files named one by one, with their paths as written. Tasks open them, so the driver looks none of them up.

    A file that is missing has no record.
    """
    folders = dict(qualified(spark, {_folder(f) for f in files}))
    if any(uri.partition(":")[0] not in ARROW_SCHEMES for uri in folders.values()):
        sheets = list_sheets(spark, [literal_path(f) for f in files])
        return sheets if re.match(SCHEME, files[0]) else sheets.withColumn("path", F.regexp_replace("path", SCHEME, ""))
    named = [(f, folders[_folder(f)], f.rpartition("/")[2]) for f in files]
    places = spark.createDataFrame(named, "path string, folder string, name string")
    return places.repartition(min(len(named), task_count(spark))).mapInPandas(_open_files, SHEETS)


def _folder(file: str) -> str:
    folder, slash, _ = file.rpartition("/")
    return "." if not slash else f"{folder}/" if folder in ("", "file:") else folder


def open_workbooks(files: DataFrame, first_only: bool = False) -> DataFrame:
    """Sheets of the workbooks held in a frame with columns ``path`` and ``content``."""
    return files.select("path", "content").mapInPandas(lambda batches: _open_workbooks(batches, first_only), SHEETS)


def decode_sheets(sheets: DataFrame, report_errors: bool = False) -> DataFrame:
    """Grid rows of the sheets. A sheet that cannot be read to its end fails the job, or, with
    ``report_errors``, gives a row ``BROKEN_ROW`` whose value is the reason; its other rows are not to be used.
    """
    spark = sheets.sparkSession
    columns = sheets.drop("n_sheets", "error")
    return columns.repartition(task_count(spark), "path", "sheet_idx").mapInPandas(
        lambda batches: _decode(batches, report_errors), ROWS
    )


def _open_workbooks(batches: Iterator[pd.DataFrame], first_only: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            yield from _open_workbook(path, content, first_only)


def _open_workbook(path: str, content: bytes, first_only: bool = False) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in SHEETS.split(", ")]
    try:
        for record in _sheets_of(path, content, first_only):
            yield pd.DataFrame([record], columns=names)
    except Exception as e:
        failed = [path, None, None, 0, None, None, None, None, f"{type(e).__name__}: {e}"]
        yield pd.DataFrame([failed], columns=names)


def _open_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    opened = {}
    for batch in batches:
        for path, folder, name in zip(batch["path"], batch["folder"], batch["name"]):
            system, root = opened.get(folder) or opened.setdefault(folder, arrow_path(folder))
            try:
                with system.open_input_file(f"{root.rstrip('/')}/{name}") as file:
                    content = file.read()
            except FileNotFoundError:
                continue
            yield from _open_workbook(path, content)


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


@dataclass
class Book:
    """What a workbook says of its sheets: name and part of each, and what their cells need to be read."""

    sheets: list[tuple[str, str]]
    strings: str | None
    styles: list[int]
    date1904: bool


def read_book(z: zipfile.ZipFile) -> Book:
    entries = set(z.namelist())
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    relations = ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in relations}
    sheets = []
    for sheet in (e for e in book.iter() if _tag(e) == "sheet"):
        target = targets[sheet.get(_RELATION)]
        sheets.append((sheet.get("name"), target.lstrip("/") if target.startswith("/") else "xl/" + target))
    return Book(
        sheets,
        "xl/sharedStrings.xml" if "xl/sharedStrings.xml" in entries else None,
        _date_styles(z.read("xl/styles.xml")) if "xl/styles.xml" in entries else [],
        any(_tag(e) == "workbookPr" and e.get("date1904") in ("1", "true") for e in book.iter()),
    )


def _sheets_of(path: str, content: bytes, first_only: bool = False) -> Iterator[list]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        book = read_book(z)
        strings = _packed(z, book.strings) if book.strings else None
        for i, (name, part) in enumerate(book.sheets[:1] if first_only else book.sheets):
            yield [path, name, i, len(book.sheets), _packed(z, part), strings, book.styles, book.date1904, None]


def unpacked(z: zipfile.ZipFile, name: str) -> Iterator[bytes]:
    """A part of the zip, unpacked a chunk at a time and no further than it is read."""
    with z.open(name) as part:
        while chunk := part.read(CHUNK_BYTES):
            yield chunk


def _packed(z: zipfile.ZipFile, name: str) -> bytes:
    """A part of the zip, compressed by itself; never held unpacked."""
    packer = zlib.compressobj()
    return b"".join([*map(packer.compress, unpacked(z, name)), packer.flush()])


def _inflated(packed: bytes) -> Iterator[bytes]:
    unpacker = zlib.decompressobj()
    waiting, at = b"", 0
    while not unpacker.eof:
        if not waiting:
            waiting, at = packed[at : at + CHUNK_BYTES], at + CHUNK_BYTES
            if not waiting:
                raise ValueError("a part of the workbook ends early")
        yield unpacker.decompress(waiting, CHUNK_BYTES)
        waiting = unpacker.unconsumed_tail


def elements(chunks: Iterable[bytes], name: str) -> Iterator:
    """Stream the elements of one name out of a part, dropping each once it is used."""
    parser = ElementTree.XMLPullParser(("start", "end"))
    parents: list = []
    for chunk in chunks:
        parser.feed(chunk)
        for event, e in parser.read_events():
            if event == "start":
                parents.append(e)
                continue
            parents.pop()
            if _tag(e) == name:
                yield e
                if parents:
                    parents[-1].clear()
    # Fails if the document is not complete, so a cut-off sheet is never taken for a short one.
    parser.close()


def _date_styles(xml: bytes) -> list[int]:
    """Indexes of the cell styles whose number format shows a date or a time."""
    root = ElementTree.fromstring(xml)
    dated = set(BUILTIN_DATE_FORMATS)
    for e in root.iter():
        if _tag(e) == "numFmt":
            code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", e.get("formatCode", ""))
            if re.search("[dmyhs]", code, re.I):
                dated.add(int(e.get("numFmtId")))
    formats = next((e for e in root.iter() if _tag(e) == "cellXfs"), [])
    return [i for i, xf in enumerate(formats) if int(xf.get("numFmtId", 0)) in dated]


def _shared_strings(packed: bytes | None) -> list[str]:
    return [] if packed is None else [_rich_text(e) for e in elements(_inflated(packed), "si")]


class SharedStrings:
    """The shared strings of a workbook, read as far as a cell has asked for them."""

    def __init__(self, chunks: Iterable[bytes]) -> None:
        self._items, self._known = elements(chunks, "si"), []

    def __getitem__(self, i: int) -> str:
        while i >= len(self._known):
            item = next(self._items, None)
            if item is None:
                raise IndexError(f"no shared string {i}")
            self._known.append(_rich_text(item))
        return self._known[i]


def _rich_text(item) -> str:
    """Text of a string item without its phonetic runs."""
    runs = [item, *[r for r in item if _tag(r) == "r"]]
    return "".join(t.text or "" for run in runs for t in run if _tag(t) == "t")


def _decode(batches: Iterator[pd.DataFrame], report_errors: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for s in batch.itertuples(index=False):
            try:
                yield from _decode_sheet(s)
            except Exception as error:
                if not report_errors:
                    raise
                yield _frame([(s.path, s.sheet, s.sheet_idx, BROKEN_ROW, [f"{type(error).__name__}: {error}"])])


def _decode_sheet(s) -> Iterator[pd.DataFrame]:
    strings, styles = _shared_strings(s.strings), set(s.date_styles)
    rows = []
    for row_idx, values in sheet_rows(_inflated(s.part), strings, styles, s.date1904):
        rows.append((s.path, s.sheet, s.sheet_idx, row_idx, values))
        if len(rows) >= BATCH_ROWS:
            yield _frame(rows)
            rows = []
    if rows:
        yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["path", "sheet", "sheet_idx", "row_idx", "values"])


def sheet_rows(chunks: Iterable[bytes], strings: list[str] | SharedStrings, styles: set[int], date1904: bool):
    """Stream (row index, values) out of a sheet; gaps in a row become null."""
    next_row = 0
    for e in elements(chunks, "row"):
        row = int(e.get("r", next_row + 1)) - 1
        next_row = row + 1
        values: list[str | None] = []
        for cell in e:
            at = _column(cell.get("r")) if cell.get("r") else len(values)
            values.extend([None] * (at - len(values)))
            value = _cell_text(cell, strings, styles, date1904)
            values.append(None if value in NA_TOKENS else value)
        yield row, values


def _column(reference: str) -> int:
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _cell_text(cell, strings: list[str] | SharedStrings, styles: set[int], date1904: bool) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return next((_rich_text(c) for c in cell if _tag(c) == "is"), None)
    raw = next((c.text for c in cell if _tag(c) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind in ("str", "d"):
        return raw.replace("T", " ") if kind == "d" else raw
    number = float(raw)
    if int(cell.get("s", 0)) in styles:
        return _date_text(number, date1904)
    return str(int(number)) if number.is_integer() else repr(number)


def _date_text(days: float, date1904: bool) -> str:
    """A dated cell prints as date and time, or as a time alone below one day."""
    moment = timedelta(microseconds=round(days * 86_400_000) * 1000)
    if 0 <= days < 1:
        return str((datetime.min + moment).time())
    return str((datetime(1904, 1, 1) if date1904 else datetime(1899, 12, 30)) + moment)
