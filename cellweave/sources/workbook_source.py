"""Workbooks as a Spark data source that is told which sheets and rows are wanted.

Sheets that are not wanted are not unpacked, and a sheet is left once its rows are past the last one wanted: the zip is read where
it lies, through its directory, so neither the rest of the sheet nor the other parts are fetched. Shared strings are read as far as a
cell asks for them.

The plan is made of names and lengths alone. Small files share a task. A large one is dealt to several, each of which takes
every n-th sheet, so the sheets of a workbook are read in parallel without opening it for the plan.

What is wanted is said to ``scan_workbooks``, not pushed down by the optimizer: Spark 4.1 keeps the filters pushed to a Python source with
the relation, so another scan of the same frame, in a union, a self-join or a later query, would read the rows of the first one's filter.
"""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cellweave.operators.shape import ROWS
from cellweave.sources.listing import arrow_path, files_in, qualified
from cellweave.sources.workbook import BATCH_ROWS, SharedStrings, read_book, sheet_rows, unpacked

FORMAT = "workbook"
# Packed bytes for a task; they unpack tenfold.
TASK_BYTES = 16 << 20
# Tasks that share the sheets of one workbook.
MAX_PARTS = 64
RECORD = pa.schema(
    [("path", pa.string()), ("sheet", pa.string()), ("sheet_idx", pa.int32()), ("row_idx", pa.int64()), ("values", pa.list_(pa.string()))]
)


def scan_workbooks(
    spark: SparkSession,
    paths: list[str] | str,
    sheets: Iterable[int] | None = None,
    names: Iterable[str] | None = None,
    below: int | None = None,
    head: int | None = None,
) -> DataFrame:
    """Grid rows of the sheets of workbooks, given as files or folders of them.

    ``sheets`` and ``names`` keep the sheets at these places and of these names, ``below`` the rows of smaller number, ``head`` the
    rows of each sheet up to the ``head``-th that holds a value, which is what a header search looks at.

    A file that cannot be read fails the read with its path. A read that ends early, by ``below`` or ``head``, does not look at
    the rest of the sheet, so it notices no damage there. Rows of a sheet are in ascending order, as the format wants.
    """
    spark.dataSource.register(WorkbookSource)
    wanted = {
        "places": qualified(spark, [paths] if isinstance(paths, str) else paths),
        "sheets": None if sheets is None else sorted(sheets),
        "names": None if names is None else sorted(names),
        "below": below,
        "head": head,
    }
    return spark.read.format(FORMAT).option("wanted", json.dumps(wanted)).load()


class Slice(InputPartition):
    """Workbooks, as path and URI, of which every ``parts``-th sheet from ``part`` on is read."""

    def __init__(self, files: list[tuple[str, str]], part: int = 0, parts: int = 1) -> None:
        super().__init__(files)
        self.files, self.part, self.parts = files, part, parts


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(**json.loads(self.options["wanted"]))


class WorkbookReader(DataSourceReader):
    def __init__(
        self,
        places: list[tuple[str, str]],
        sheets: list[int] | None = None,
        names: list[str] | None = None,
        below: int | None = None,
        head: int | None = None,
    ) -> None:
        self.places, self.sheets, self.names, self.below, self.head = places, sheets, names, below, head

    def _wanted(self, sheet_idx: int, sheet: str) -> bool:
        return (self.sheets is None or sheet_idx in self.sheets) and (self.names is None or sheet in self.names)

    def partitions(self) -> list[Slice]:
        slices, shared, size = [], [], 0
        for path, uri, length in sorted(self._files()):
            parts = min(MAX_PARTS, -(-length // TASK_BYTES))
            if parts > 1:
                asked = range(parts) if self.sheets is None else sorted({i % parts for i in self.sheets})
                slices += [Slice([(path, uri)], part, parts) for part in asked]
                continue
            if shared and size + length > TASK_BYTES:
                slices.append(Slice(shared))
                shared, size = [], 0
            shared.append((path, uri))
            size += length
        if shared:
            slices.append(Slice(shared))
        return slices or [Slice([])]

    def _files(self) -> Iterator[tuple[str, str, int]]:
        """Path, URI and length of the files; those of a folder that a folder listing hides are left out."""
        for written, uri in self.places:
            system, root = arrow_path(uri)
            info = system.get_file_info(root)
            if info.is_file:
                yield written, uri, info.size
            elif info.type == fs.FileType.NotFound:
                raise FileNotFoundError(written)
            else:
                for path, length, _ in files_in(written, uri):
                    name = path.rpartition("/")[2]
                    if not name.startswith((".", "_")):
                        yield path, f"{uri.rstrip('/')}/{quote(name)}", length

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        for path, uri in partition.files:
            try:
                yield from self._read_file(path, uri, partition)
            except Exception as error:
                raise ValueError(f"{path}: {type(error).__name__}: {error}") from error

    def _read_file(self, path: str, uri: str, partition: Slice) -> Iterator[pa.RecordBatch]:
        system, name = arrow_path(uri)
        with system.open_input_file(name) as file, _opened(file) as z:
            book = read_book(z)
            strings = SharedStrings(unpacked(z, book.strings) if book.strings else ())
            for i, (sheet, part) in enumerate(book.sheets):
                if i % partition.parts == partition.part and self._wanted(i, sheet):
                    rows = self._rows(sheet_rows(unpacked(z, part), strings, set(book.styles), book.date1904))
                    yield from _batches(rows, path, sheet, i)

    def _rows(self, rows: Iterator[tuple[int, list]]) -> Iterator[tuple[int, list]]:
        left = self.head
        if left == 0 or self.below is not None and self.below <= 0:
            return
        for row_idx, values in rows:
            if self.below is not None and row_idx >= self.below:
                return
            yield row_idx, values
            if left is not None:
                left -= any(v is not None for v in values)
            if left == 0 or row_idx + 1 == self.below:
                return


def _opened(file) -> zipfile.ZipFile:
    """The zip in a file. One too short to look for the end of a zip is none; Arrow refuses the place looked at."""
    try:
        return zipfile.ZipFile(file)
    except pa.ArrowInvalid:
        raise zipfile.BadZipFile("File is not a zip file") from None


def _batches(rows: Iterator[tuple[int, list]], path: str, sheet: str, sheet_idx: int) -> Iterator[pa.RecordBatch]:
    numbers, values = [], []

    def batch() -> pa.RecordBatch:
        n = len(numbers)
        columns = ([path] * n, [sheet] * n, [sheet_idx] * n, numbers, values)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, RECORD, strict=True)], schema=RECORD)

    for row_idx, cells in rows:
        numbers.append(row_idx)
        values.append(cells)
        if len(numbers) == BATCH_ROWS:
            yield batch()
            numbers, values = [], []
    if numbers:
        yield batch()
