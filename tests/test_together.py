"""Many workbooks of one dataset in one load."""

import os

import pytest
from pyspark.sql import functions as F

from cellweave.operators import audit, gate
from cellweave.plans import ingest, runner, together
from cellweave.plans import rules as R
from cellweave.sinks.published import PublishedSink
from cellweave.sinks.tables import FolderSink, TableSink
from tests.test_runs import cut_short
from workloads.books import workbook

HEAD = ["Trigramme", "Semaine", "Heures"]


def hours(n):
    return [HEAD, *[["abc", f"2025-01-{1 + d % 28:02}", d] for d in range(1, n + 1)]]


def put(folder, files):
    for name, content in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)
    return [str(folder / n) for n in files]


def run_all(spark, paths, sink, run_id="r1", **options):
    contract = gate.make_contract(spark.createDataFrame([("FILE_PATH_RPA", p) for p in paths], "env_key string, path string"))
    records = runner.run_once(spark, contract, sink, audit.Run(id=run_id, user="u"), grace=0.0, **options)
    return {os.path.basename(r.path): (r.status, r.reason, r.rows) for r in records.collect()}


def jobs_of(spark, action):
    """How many jobs an action starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"count-{id(action)}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        action()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


FILES = {
    "a.xlsx": workbook({"s": hours(5)}),
    "b.xlsx": workbook({"Un": hours(3), "Deux": [["Nom", "Heures"], ["x", 1.5], ["y", "rien"]], "Vide": []}),
    "c.xlsx": b"no workbook",
    "d.xlsx": cut_short(workbook({"Un": hours(9), "Deux": hours(9)}), "xl/worksheets/sheet2.xml"),
    "e.xlsx": cut_short(workbook({"Un": hours(9)}), "xl/worksheets/sheet1.xml"),
    "sous/a.xlsx": workbook({"s": hours(4)}),
    "[f] {g}.xlsx": workbook({"Feuille 1": hours(2), "Feuille-1": hours(1)}),
    "vide.xlsx": workbook({"s": []}),
}


def test_together_gives_what_one_after_another_does(spark, tmp_path, monkeypatch):
    paths = put(tmp_path, FILES)

    def outcome(folder):
        got = {p: str(r.error) if r.error else (r.report.rows, r.report.tables, r.report.note()) for p, r in runner._load(
            spark, "rpa", dict.fromkeys(sorted(paths)), FolderSink(folder), audit.Run(id="r", user="u"), {}).items()}
        tables = {}
        for name in os.listdir(folder):
            df = spark.read.parquet(f"{folder}/{name}")
            tables[name] = (sorted(df.drop("created_at").dtypes), sorted(map(str, df.drop("created_at").collect())))
        return got, tables

    joint = outcome(str(tmp_path / "joint"))

    def spoilt(*args):
        raise ValueError("spoilt")

    monkeypatch.setattr(runner, "load_together", spoilt)
    assert joint == outcome(str(tmp_path / "single"))
    got, tables = joint
    assert got[paths[1]] == (5, 2, "1 values lost") and "sous" not in tables and len(tables["a"][1]) == 5
    assert "already written" in got[paths[5]] and "BadZipFile" in got[paths[2]]


def test_jobs_do_not_grow_with_the_workbooks(spark, tmp_path):
    def load(n):
        paths = put(tmp_path / str(n), {f"livre_{i}.xlsx": workbook({"s": hours(3)}) for i in range(n)})
        sink = FolderSink(str(tmp_path / f"out{n}"))
        loads, run = dict.fromkeys(paths), audit.Run(id="r", user="u")
        jobs = jobs_of(spark, lambda: together.load_together(spark, "rpa", loads, sink, run))
        assert spark.read.parquet(f"{sink.root}/livre_{n - 1}").count() == 3 and len(os.listdir(sink.root)) == n
        return jobs

    few, many = load(4), load(200)
    assert many <= few + 5  # a job more lists many paths in parallel, and more staged rows mean a few more tasks' looks


def test_folders_on_the_way_do_not_grow_with_the_workbooks(spark, tmp_path, monkeypatch):
    """Sheets lie together in files of the tasks, none of a folder is listed for a sheet, and a table's folder is moved as one."""
    heads = [[*HEAD, "Montant"], HEAD]
    paths = put(tmp_path, {f"livre_{i}.xlsx": workbook({"s": [heads[i % 2], *[[*r, r[2]][: len(heads[i % 2])] for r in hours(1 + i % 3)[1:]]]}) for i in range(60)})
    written, asked = {}, []
    original, sink = together._body, FolderSink(str(tmp_path / "out"))

    def spy(staged, layouts):
        body = original(staged, layouts)
        written.update({"staged": staged.inputFiles(), "dealt": body.inputFiles(), "layouts": layouts.select("layout").distinct().count()})
        return body

    monkeypatch.setattr(together, "_body", spy)
    monkeypatch.setattr(FolderSink, "can_adopt", lambda self, spark, folder: asked.append(folder) or True)
    results = together.load_together(spark, "rpa", dict.fromkeys(paths), sink, audit.Run(id="r", user="u"))
    tasks = max(spark.sparkContext.defaultParallelism, 4)
    assert len(written["staged"]) <= tasks + 1 and 2 <= written["layouts"] <= 4 and len(written["dealt"]) <= written["layouts"] * tasks and len(asked) == 1
    for i, path in enumerate(paths):
        table = spark.read.parquet(f"{sink.root}/livre_{i}")
        assert results[path].report.rows == 1 + i % 3 and len(table.columns) == 6 - i % 2
        assert i > 3 or table.count() == 1 + i % 3


def test_a_missing_file_spoils_no_other(spark, tmp_path):
    paths = [*put(tmp_path, {"un deux%20.xlsx": workbook({"s": hours(2)})}), str(tmp_path / "absent.xlsx")]
    got = runner._load(spark, "rpa", dict.fromkeys(paths), FolderSink(str(tmp_path / "out")), audit.Run(id="r", user="u"), {})
    assert (got[paths[0]].error, got[paths[0]].report.rows) == (None, 2) and "PATH_NOT_FOUND" in str(got[paths[1]].error)


def test_layouts_are_shared_by_sheets_alike(spark, tmp_path):
    paths = put(tmp_path, {"a.xlsx": workbook({"s": hours(3), "t": hours(2), "u": [["Nom"], ["x"]]})})
    seen = []
    original = together._write_layouts

    def spy(*args):
        seen.append(original(*args))
        return seen[-1]

    with pytest.MonkeyPatch.context() as m:
        m.setattr(together, "_write_layouts", spy)
        together.load_together(spark, "rpa", dict.fromkeys(paths), FolderSink(str(tmp_path / "out")), audit.Run(user="u"))
    assert len(seen[0]) == 2 and len(os.listdir(tmp_path / "out")) == 3


def test_catalog_tables_take_the_files(spark, tmp_path):
    paths = put(tmp_path, {"pris_un.xlsx": workbook({"s": hours(3)}), "pris_deux.xlsx": workbook({"s": hours(4)})})
    for _ in range(2):
        got = run_all(spark, paths, TableSink())
        assert got == {"pris_un.xlsx": ("Loaded", None, 3), "pris_deux.xlsx": ("Loaded", None, 4)}
    assert spark.table("pris_deux").count() == 4 and spark.table("pris_un").columns == ["trigramme", "semaine", "heures", "created_at", "created_by"]
    external = TableSink(root=str(tmp_path / "dehors"))
    for name in ("pris_un", "pris_deux"):
        spark.sql(f"DROP TABLE {name}")
    run_all(spark, paths, external)
    assert spark.table("pris_un").count() == spark.read.parquet(str(tmp_path / "dehors" / "pris_un")).count() == 3


def test_append_adds_and_a_published_load_is_taken_once(spark, tmp_path):
    paths = put(tmp_path, {"publie_un.xlsx": workbook({"s": hours(3)}), "publie_deux.xlsx": workbook({"s": hours(4)})})
    appended = FolderSink(str(tmp_path / "more"), mode="append")
    published = PublishedSink(str(tmp_path / "published"))
    for run_id in ("r1", "r2"):
        run_all(spark, paths, appended, run_id)
        assert run_all(spark, paths, published, run_id, repeatable=True)["publie_un.xlsx"] == ("Loaded", None, 3)
    assert spark.read.parquet(f"{appended.root}/publie_deux").count() == 8
    assert spark.table("publie_deux").count() == 4
    assert spark.table("publie_deux").filter(F.col("heures").isNull()).count() == 0


def test_mixed_paths_are_loaded_in_two_groups(spark, tmp_path):
    paths = put(tmp_path, {f"{n}.xlsx": workbook({"s": hours(2)}) for n in "abcd"})
    paths = [f"file:{p}" if i % 2 else p for i, p in enumerate(paths)]
    with pytest.raises(ValueError):
        together.load_together(spark, "rpa", dict.fromkeys(paths), None, audit.Run(user="u"))
    got = run_all(spark, paths, FolderSink(str(tmp_path / "out")))
    assert got == {f"{n}.xlsx": ("Loaded", None, 2) for n in "abcd"}


def lost_in(spark, folder):
    names = ["run_id", "table", "sheet_idx", "row_idx", "col_idx", "name", "text"]
    return sorted(tuple(r) for r in spark.read.parquet(folder).select(*names).collect())


def test_lost_texts_are_kept_with_their_place(spark, tmp_path, monkeypatch):
    body = [["Nom", "Heures"], ["x", 1.5], ["y", " rien "], ["z", 2]]
    paths = put(tmp_path, {"perdu.xlsx": workbook({"Un": body, "Deux": hours(3)}), "autre.xlsx": workbook({"s": body[:3]})})
    want = [("r1", "autre", 0, 2, 1, "heures", "rien"), ("r1", "perdu__un", 0, 2, 1, "heures", "rien")]
    for way in ("together", "one by one"):
        folder = str(tmp_path / way / "lost")
        for _ in range(2):
            sink = FolderSink(str(tmp_path / way / "out"))
            got = run_all(spark, paths, sink, losses=folder)
            assert got == {"perdu.xlsx": ("Loaded", "1 values lost", 6), "autre.xlsx": ("Loaded", "1 values lost", 2)}
        assert lost_in(spark, folder) == want
        table = spark.read.parquet(f"{sink.root}/perdu__un")
        assert table.columns == ["nom", "heures", "created_at", "created_by"]
        assert sorted((r.nom, r.heures) for r in table.collect()) == [("x", 1.5), ("y", None), ("z", 2.0)]

        def spoilt(*args):
            raise ValueError("spoilt")

        monkeypatch.setattr(runner, "load_together", spoilt)


def test_as_many_texts_are_lost_as_the_profile_says(spark, grid):
    texts = ["12", "1 234,5", "13/02/2025", "31/02/2025", "2025-01-06", "2025-13-01", "oui", "NON", "peut-être", "0", "", " ", "inf", "45000", "1e400", None]
    body = [[f"n{i}", *[t if (i + k) % 9 else "x" for k, t in enumerate([texts[i % len(texts)]] * 3)], "13/02/2025" if i % 20 else "?", str(i) if i % 20 else "?", "oui" if i % 20 else "?"] for i in range(120)]
    rows, _ = ingest.stage(grid({"s": [["Nom", "Date début", "Montant", "Heures", "Échéance", "Budget", "Retour"], *body]}))
    for rules in R.INFERRED.values():
        (table,) = ingest.typed_sheets(rows, rules, losses=True)
        n = 0 if table.losses is None else table.losses.count()
        assert n == table.lost_values
        if n:
            cells = {(r.name, r.row_idx): r.text for r in table.losses.collect()}
            assert len(cells) == n and all(t is not None for t in cells.values())
            plan = table.losses._jdf.queryExecution().executedPlan().toString()
            assert "echeance" not in plan.split("ReadSchema")[-1].split("__lost")[0]
