"""Workbooks as a data source: what is unpacked, and that rows are those of the plain reader."""

import zipfile

import pytest
from pyspark.sql import functions as F

from cellweave.operators import shape
from cellweave.plans import rules as R
from cellweave.sources import workbook_source as source
from cellweave.sources.listing import qualified
from cellweave.sources.workbook import read_workbooks
from cellweave.sources.workbook_source import WorkbookReader, scan_workbooks
from workloads.books import workbook

LONG = {f"Feuille {k}": [[f"titre {k}"], [], *[[f"t{k}-{i}", i, f"x{i * 7919 % 10_007}"] for i in range(60_000)]] for k in range(3)}


@pytest.fixture(scope="module")
def long_book(tmp_path_factory):
    path = tmp_path_factory.mktemp("long") / "long.xlsx"
    path.write_bytes(workbook(LONG))
    return str(path)


@pytest.fixture
def looked_at(monkeypatch):
    """Unpacked bytes of each part."""
    seen, original = {}, source.unpacked

    def counted(z, name):
        for chunk in original(z, name):
            seen[name] = seen.get(name, 0) + len(chunk)
            yield chunk

    monkeypatch.setattr(source, "unpacked", counted)
    return seen


def rows_of(reader):
    return [r for p in reader.partitions() for batch in reader.read(p) for r in zip(*[c.to_pylist() for c in batch.columns], strict=True)]


def test_rows_are_those_of_the_plain_reader(spark, tmp_path):
    rows = [["partagé", "inline:en ligne", 12, 12.5, True, None, "#N/A", "N/A"], [], [3.0, False, None, "a & b", 1e16, -0.25]]
    folder = tmp_path / "Dépôt 100% [a]"
    folder.mkdir()
    for k in range(3):
        (folder / f"a#{k} é.xlsx").write_bytes(workbook({"Un": rows, "Deux": [["b"], ["c"]], "Vide": []}))
    (folder / ".caché.xlsx").write_bytes(b"no workbook")
    key = ["name", "sheet_idx", "row_idx"]

    def told(df):
        name = F.regexp_extract("path", "[^/]*$", 0).alias("name")
        return [tuple(r) for r in df.select(name, "sheet", "sheet_idx", "row_idx", "values").orderBy(*key).collect()]

    plain = read_workbooks(spark, [str(folder / f"a#{k} é.xlsx").replace("[", "\\[").replace("]", "\\]") for k in range(3)])
    got = scan_workbooks(spark, str(folder))
    assert told(got) == told(plain) and len(told(got)) == 12
    assert {r.path for r in got.select("path").distinct().collect()} == {str(folder / f"a#{k} é.xlsx") for k in range(3)}
    assert [f.dataType for f in got.schema] == [f.dataType for f in plain.schema]


def test_one_sheet_unpacks_no_other(spark, long_book, looked_at):
    got = rows_of(WorkbookReader(qualified(spark, [long_book]), sheets=[1]))
    assert len(got) == 60_001 and {(r[1], r[2]) for r in got} == {("Feuille 1", 1)}
    assert set(looked_at) == {"xl/worksheets/sheet2.xml", "xl/sharedStrings.xml"}


def test_header_search_unpacks_no_body(spark, long_book, looked_at):
    sizes = {i.filename: i.file_size for i in zipfile.ZipFile(long_book).infolist()}
    head = rows_of(WorkbookReader(qualified(spark, [long_book]), head=25))
    assert [r[3] for r in head if r[2] == 0] == [0, *range(2, 26)] and len(head) == 75
    # One chunk of each sheet; of the strings those of the heads and what lies before them.
    assert all(looked_at[f"xl/worksheets/sheet{k}.xml"] <= source_chunk() < sizes[f"xl/worksheets/sheet{k}.xml"] for k in (1, 2, 3))
    looked_at.clear()
    some = rows_of(WorkbookReader(qualified(spark, [long_book]), names=["Feuille 0"], below=25))
    assert [r[3] for r in some] == [0, *range(2, 25)]
    assert set(looked_at) == {"xl/worksheets/sheet1.xml", "xl/sharedStrings.xml"}
    assert max(looked_at.values()) <= source_chunk() < sizes["xl/sharedStrings.xml"]


def source_chunk():
    from cellweave.sources.workbook import CHUNK_BYTES

    return CHUNK_BYTES


def test_two_scans_of_one_frame_keep_their_own_filters(spark, long_book):
    """Filters stay in Spark; pushed to a Python source they would stay with the relation and meet the next scan."""
    rows = scan_workbooks(spark, long_book, below=4)
    assert rows.filter("sheet_idx = 2").count() == 3 and rows.count() == 9
    both = rows.filter("sheet_idx = 0").union(rows.filter("sheet_idx = 1 AND row_idx = 2"))
    assert sorted((r.sheet_idx, r.row_idx) for r in both.collect()) == [(0, 0), (0, 2), (0, 3), (1, 2)]
    assert rows.filter("sheet_idx = 1 OR sheet_idx = 5").count() == 3 and rows.count() == 9


def test_bounds(spark, long_book):
    def places(**wanted):
        return [(r.sheet_idx, r.row_idx) for r in scan_workbooks(spark, long_book, **wanted).orderBy("sheet_idx", "row_idx").collect()]

    assert places(below=0) == places(head=0) == places(sheets=[]) == places(names=["feuille 0"]) == places(sheets=[0], names=["Feuille 1"]) == []
    assert places(below=2) == places(head=1) == places(below=1) == [(0, 0), (1, 0), (2, 0)]
    assert places(sheets=[0, 2, 9], below=3, head=5) == [(0, 0), (0, 2), (2, 0), (2, 2)]
    assert places(names=["Feuille 1"], below=9, head=2) == [(1, 0), (1, 2)]


def test_large_workbooks_are_dealt_by_sheets(spark, tmp_path, long_book, monkeypatch):
    monkeypatch.setattr(source, "TASK_BYTES", 1 << 20)
    for k in range(5):
        (tmp_path / f"k{k}.xlsx").write_bytes(workbook({"s": [["a"], [k]]}))
    reader = WorkbookReader(qualified(spark, [long_book, str(tmp_path)]))
    slices = reader.partitions()
    assert sum(len(s.files) == 5 for s in slices) == 1 and len(slices) >= 3
    got = rows_of(reader)
    assert len(got) == len({(r[0], r[2], r[3]) for r in got}) == 3 * 60_001 + 10
    reader = WorkbookReader(qualified(spark, [long_book]), sheets=[1])
    assert [s.part for s in reader.partitions()] == [1 % s.parts for s in reader.partitions()] and len(rows_of(reader)) > 60_000


def test_headers_of_heads_are_those_of_whole_sheets(spark, tmp_path):
    titles = [["Suivi"], [], [None, "Édité le", "2025"]]
    body = [["abc", f"2025-01-{d:02}", d] for d in range(1, 29)]
    for k in range(4):
        head = [[] for _ in range(40 * k)] + titles[:k] + [["Trigramme", "Semaine", "Heures"], *body]
        (tmp_path / f"h{k}.xlsx").write_bytes(workbook({"s": head, "t": body, "Vide": []}))
    for rules in (R.RPA, R.SPA):
        whole = shape.find_headers(scan_workbooks(spark, str(tmp_path)), rules).drop("sheet_id")
        heads = shape.find_headers(scan_workbooks(spark, str(tmp_path), head=rules.scan), rules).drop("sheet_id")
        assert sorted(heads.collect()) == sorted(whole.collect()) and heads.count() == 8


def test_broken_and_missing_files_are_named(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook({"s": [["a"]]}))
    (tmp_path / "faux.xlsx").write_bytes(b"no workbook")
    with pytest.raises(Exception, match="faux.xlsx: BadZipFile"):
        scan_workbooks(spark, str(tmp_path)).collect()
    assert scan_workbooks(spark, str(tmp_path / "a.xlsx")).count() == 1
    with pytest.raises(Exception, match="absent.xlsx"):
        scan_workbooks(spark, str(tmp_path / "absent.xlsx")).collect()
    (tmp_path / "empty").mkdir()
    assert scan_workbooks(spark, str(tmp_path / "empty")).count() == 0
