"""Delimited files with line breaks in quoted values, in ranges of any size."""

import csv
import io
import random

import pytest

from cellweave.sources import quoted
from cellweave.sources.delimited import read_delimited

SIGNS = ["a", "é", "中", " ", ",", ";", '"', "\n", "\r\n", "\r", "''", "N/A", "12,5", "x" * 40]


def table(seed, rows):
    choose = random.Random(seed)
    return [["".join(choose.choices(SIGNS, k=choose.randint(0, 6))) for _ in range(4)] for _ in range(rows)]


def written(rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    return out.getvalue().encode()


def plain(rows):
    return [[None if v in ("", "N/A") else v for v in r] for r in rows]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 10**9])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_record_comes_from_one_range(size, end):
    """All ranges of a file, read by hand: each record once, where it begins, whatever bytes the ranges cut."""
    rows = [r for r in table(size, 60) if any(r)]
    data = written(rows, end, csv.QUOTE_ALL)
    found, inside = [], False
    for start in range(0, len(data), size):
        stop = min(start + size, len(data))
        found += quoted.records(io.BytesIO(data), start, stop, inside)
        inside ^= data[start:stop].count(b'"') % 2 == 1
    assert [at for at, _ in found] == sorted({at for at, _ in found})
    assert [quoted.fields(text, ",") for _, text in found] == rows


def test_chunks_do_not_show(monkeypatch):
    data = written(table(5, 80))
    whole = list(quoted.records(io.BytesIO(data), 0, len(data), False))
    monkeypatch.setattr(quoted, "CHUNK_BYTES", 3)
    assert list(quoted.records(io.BytesIO(data), 0, len(data), False)) == whole


@pytest.mark.parametrize("size", [50, 997, 1 << 20])
def test_files_of_many_ranges(spark, tmp_path, size):
    books = {f"f{i}.csv": table(i, 150) for i in range(3)}
    for name, rows in books.items():
        (tmp_path / name).write_bytes((quoted.MARK if name == "f1.csv" else b"") + written(rows))
    (tmp_path / "empty.csv").write_bytes(b"")
    found = quoted.read_quoted(spark, str(tmp_path), ",", size).collect()
    for name, rows in books.items():
        own = sorted((r for r in found if r.path.endswith(name)), key=lambda r: r.row_idx)
        assert [r["values"] for r in own] == plain(rows)
        assert {(r.sheet, r.sheet_idx) for r in own} == {(name[:-4], 0)}
    assert len(found) == 450


def test_a_value_longer_than_many_ranges(spark, tmp_path):
    long = "line, with \"quotes\"\n" * 500
    rows = [["1", "before"], ["2", long], ["3", "after\nit"]]
    (tmp_path / "a.csv").write_bytes(written(rows))
    found = quoted.read_quoted(spark, str(tmp_path / "a.csv"), ",", 100).collect()
    assert [r["values"] for r in sorted(found, key=lambda r: r.row_idx)] == rows


def test_odd_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,b\r\n\r\n\n"x\r\ny",2\r\nlast,"not closed\nat all')
    found = quoted.read_quoted(spark, str(tmp_path / "a.csv"), ",", 4).collect()
    assert [r["values"] for r in sorted(found, key=lambda r: r.row_idx)] == [["a", "b"], ["x\r\ny", "2"], ["last", "not closed\nat all"]]


def test_the_delimited_source_reads_them(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'1;"a\nb"\n2;"c;""d"""\n')
    found = read_delimited(spark, str(tmp_path / "a.csv"), ";", line_breaks=True).collect()
    assert sorted(r["values"] for r in found) == [["1", "a\nb"], ["2", 'c;"d"']]
