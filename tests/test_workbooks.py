from datetime import date, datetime

from cellweave.sources import workbook as source
from cellweave.sources.delimited import read_delimited
from cellweave.sources.workbook import decode_sheets, list_sheets, read_workbooks
from workloads.books import workbook


def write(folder, name, sheets):
    path = folder / name
    path.write_bytes(workbook(sheets) if isinstance(sheets, dict) else sheets)
    return str(path)


def test_cell_kinds(spark, tmp_path):
    rows = [
        ["partagé", "inline:en ligne", 12, 12.5, True, None, "#N/A", "N/A"],
        [],
        [date(2025, 1, 2), datetime(2025, 1, 2, 10, 30), 3.0, False, None, "a & b", 1e16, -0.25],
    ]
    path = write(tmp_path, "a.xlsx", {"Feuille 1": rows})
    got = {r.row_idx: r["values"] for r in read_workbooks(spark, path).collect()}
    assert got == {
        0: ["partagé", "en ligne", "12", "12.5", "True", None, None, None],
        2: ["2025-01-02 00:00:00", "2025-01-02 10:30:00", "3", "False", None, "a & b", "10000000000000000", "-0.25"],
    }


def test_sheets_and_first_sheet(spark, tmp_path):
    for k in range(3):
        write(tmp_path, f"b{k}.xlsx", {"Un": [["a"]], "Deux": [["b"], ["c"]], "Vide": []})
    rows = read_workbooks(spark, str(tmp_path))
    assert sorted((r.path[-7:], r.sheet, r.sheet_idx) for r in rows.select("path", "sheet", "sheet_idx").distinct().collect()) == [
        (f"b{k}.xlsx", s, i) for k in range(3) for s, i in (("Deux", 1), ("Un", 0))
    ]
    assert {r.sheet for r in read_workbooks(spark, str(tmp_path), first_sheet_only=True).collect()} == {"Un"}
    sheets = list_sheets(spark, str(tmp_path))
    assert sheets.select("n_sheets").distinct().collect()[0][0] == 3 and sheets.count() == 9


def test_first_sheet_only_unpacks_no_other(monkeypatch):
    content, packed = workbook({"Un": [["a"]], "Deux": [["b"]], "Trois": [["c"]]}), []
    original = source._packed
    monkeypatch.setattr(source, "_packed", lambda z, name: packed.append(name) or original(z, name))
    assert [(r[1], r[3]) for r in source._sheets_of("p", content, first_only=True)] == [("Un", 3)]
    assert packed == ["xl/sharedStrings.xml", "xl/worksheets/sheet1.xml"]
    packed.clear()
    assert len(list(source._sheets_of("p", content))) == 3 and len(packed) == 4


def test_unreadable_file_is_reported(spark, tmp_path):
    write(tmp_path, "old.xls", b"\xd0\xcf\x11\xe0 not a zip")
    write(tmp_path, "ok.xlsx", {"s": [["a"]]})
    sheets = list_sheets(spark, str(tmp_path))
    assert [r.path.endswith("old.xls") for r in sheets.filter("error is not null").collect()] == [True]
    assert decode_sheets(sheets.filter("error is null")).count() == 1


def test_long_sheet_keeps_every_row(spark, tmp_path):
    path = write(tmp_path, "long.xlsx", {"s": [[i, f"texte {i % 7}"] for i in range(12_345)]})
    rows = read_workbooks(spark, path)
    assert rows.count() == 12_345
    assert rows.agg({"row_idx": "max"}).first()[0] == 12_344


def test_delimited_keeps_wide_rows_below_a_title(spark, tmp_path):
    (tmp_path / "x.csv").write_text('Titre\n\nDate;Site;"Libellé; long"\n01/02/2025;A;"dit ""oui"""\n;N/A;z\n', encoding="utf8")
    (tmp_path / "y.csv").write_text("a;b\n", encoding="utf8")
    rows = read_delimited(spark, str(tmp_path), ";").orderBy("path", "row_idx").collect()
    assert [r["values"][:3] for r in rows] == [
        ["Titre", None, None], ["Date", "Site", "Libellé; long"], ["01/02/2025", "A", 'dit "oui"'], [None, None, "z"], ["a", "b", None],
    ]
    assert [r.sheet for r in rows] == ["x"] * 4 + ["y"]


def test_delimited_order_over_several_blocks(spark, tmp_path):
    (tmp_path / "big.csv").write_text("".join(f"{i},v{i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_delimited(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 5
        got = [int(r["values"][0]) for r in rows.orderBy("row_idx").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(20_000))
