"""Gate, run, manifest, sinks and streams on real files."""

import io
import os
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cellweave.operators import audit, decide, dedupe, gate
from cellweave.plans import rules as R
from cellweave.plans.runner import run_once, update_manifest
from cellweave.sinks import outcomes
from cellweave.sinks.tables import FolderSink, JdbcSink, TableSink, column_types
from cellweave.sources.listing import list_arrivals
from cellweave.streaming import watch
from workloads.books import workbook

SPA = {
    "Projets": [["Suivi", None, None], ["Projet", "Échéance", "Budget"], ["P1", "13/02/2025", "1 234,5"], ["P2", "14/02/2025", "x"]],
    "Vide": [],
}


@pytest.fixture
def depot(tmp_path):
    def put(name, content=b"x"):
        (tmp_path / name).write_bytes(workbook(content) if isinstance(content, dict) else content)

    put("suivi.xlsx", SPA)
    put("pointages.xlsx", {"s": [["Trigramme", "Semaine", "Heures"], ["abc", "2025-01-06", 7.5], ["def", "2025-01-13", 8]]})
    put("conditions.xls", b"not a workbook")
    put("clients.csv", b"a;b")
    put("~$suivi.xlsx")
    put(".cache")
    put("vide.xlsx", b"")
    put("inconnu.xlsx", {"s": [["a"]]})
    (tmp_path / "sous-dossier").mkdir()
    return tmp_path


@pytest.fixture
def contract(spark, depot):
    settings = [("SPA", "suivi.xlsx"), ("RPA", "pointages.xlsx"), ("CDP", "conditions.xls"), ("CATCLIENTS", "clients.csv")]
    rows = [(f"FILE_PATH_{k}", str(depot / n)) for k, n in settings] + [("FILE_PATH_FNP", "  ")]
    return gate.make_contract(spark.createDataFrame(rows, "env_key string, path string"))


def test_contract(spark, contract, depot):
    assert {r.dataset for r in contract.collect()} == {"spa", "rpa", "cdp", "catclients"}
    assert [r.parent for r in gate.watched_folders(contract).collect()] == [str(depot)]


def test_run_once(spark, contract, depot, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    run = audit.Run(user="chargeur")
    records = run_once(spark, contract, FolderSink(out), run, grace=0.0)
    got = {os.path.basename(r.path): r for r in records.collect()}
    assert {n: (r.status, r.reason) for n, r in got.items() if r.reason in (gate.EMPTY, gate.UNLISTED, gate.TEMP_OR_HIDDEN)} == {
        "~$suivi.xlsx": ("Rejects", gate.TEMP_OR_HIDDEN),
        ".cache": ("Rejects", gate.TEMP_OR_HIDDEN),
        "vide.xlsx": ("Rejects", gate.EMPTY),
        "inconnu.xlsx": ("Rejects", gate.UNLISTED),
    }
    assert got["clients.csv"].reason == gate.BAD_EXTENSION + ".csv"
    assert got["conditions.xls"].status == "Rejects" and "ETL failed" in got["conditions.xls"].reason
    assert (got["suivi.xlsx"].status, got["suivi.xlsx"].rows) == ("Loaded", 2)
    assert got["suivi.xlsx"].dest.endswith("/suivi.xlsx") and "/Archives/Loaded_" in got["suivi.xlsx"].dest
    assert {r.run_id for r in got.values()} == {run.id}
    summary = gate.run_summary(records).first()
    assert (summary.ok, summary.reject) == (2, 6)

    spa = spark.read.parquet(out + "/suivi__projets")
    assert spa.dtypes == [("projet", "string"), ("echeance", "date"), ("budget", "double"), ("created_at", "timestamp"), ("created_by", "string")]
    assert sorted((r.projet, r.budget) for r in spa.collect()) == [("P1", 1234.5), ("P2", None)]
    assert {r.created_by for r in spa.collect()} == {"chargeur"}
    rpa = spark.read.parquet(out + "/pointages")
    assert rpa.dtypes[:3] == [("trigramme", "string"), ("semaine", "date"), ("heures", "double")]


def test_contract_takes_known_keys_and_the_last_of_a_path(spark):
    rows = [("FILE_PATH_AUTRE", "/d/a.xlsx"), ("FILE_PATH_FQT", "\t/d/b.xlsx\xa0"), ("FILE_PATH_CDP", "/d/b.xlsx"), ("FILE_PATH_SPA", " \t"), ("FILE_PATH_RPA", None), ("FILE_PATH_FNP", "file:///d/c.xlsx")]
    got = gate.make_contract(spark.createDataFrame(rows, "env_key string, path string")).collect()
    assert sorted((r.path, r.dataset) for r in got) == [("/d/b.xlsx", "cdp"), ("file:/d/c.xlsx", "fnp")]


def cut_short(content, part):
    """The workbook with one of its parts cut in half, in a zip that is sound."""
    source, out = zipfile.ZipFile(io.BytesIO(content)), io.BytesIO()
    with zipfile.ZipFile(out, "w") as target:
        for name in source.namelist():
            data = source.read(name)
            target.writestr(name, data[: len(data) // 2] if name == part else data)
    return out.getvalue()


HOURS = [["Trigramme", "Semaine", "Heures"], *[["abc", f"2025-01-{d:02}", d] for d in range(1, 29)]]


def load(spark, folder, files, **options):
    """Write workbooks, list them all as one dataset each, run, and return outcomes and the tables' folder."""
    keys = ["RPA", "FQT", "SPA"]
    for name, content in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)
    rows = [(f"FILE_PATH_{k}", options.get("prefix", "") + str(folder / n)) for k, n in zip(keys, files)]
    contract = gate.make_contract(spark.createDataFrame(rows, "env_key string, path string"))
    out = str(folder / "out")
    records = run_once(spark, contract, FolderSink(out), audit.Run(user="u"), grace=0.0, store=options.get("store"))
    return {os.path.basename(r.path): r for r in records.collect()}, out


def test_one_broken_sheet_of_three_is_reported_and_the_others_load(spark, tmp_path):
    content = cut_short(workbook({"Un": HOURS, "Deux": HOURS, "Trois": HOURS}), "xl/worksheets/sheet2.xml")
    got, out = load(spark, tmp_path, {"pointages.xlsx": content})
    record = got["pointages.xlsx"]
    assert (record.status, record.rows) == ("Loaded", 56)
    assert record.reason.startswith("Deux: ParseError")
    assert sorted(os.listdir(out)) == ["pointages__trois", "pointages__un"]


def test_a_cut_off_sheet_is_rejected(spark, tmp_path):
    got, out = load(spark, tmp_path, {"a.xlsx": cut_short(workbook({"Un": HOURS}), "xl/worksheets/sheet1.xml")})
    assert got["a.xlsx"].status == "Rejects" and "ParseError" in got["a.xlsx"].reason
    assert not os.path.exists(out)


def test_tables_of_equal_name_are_numbered_and_all_rows_kept(spark, tmp_path):
    long_name = "Une feuille au nom long, numero"
    book = workbook({"Feuille 1": HOURS, "Feuille-1": HOURS[:9], long_name[:30] + "A": HOURS[:5], long_name[:30] + "B": HOURS[:3]})
    got, out = load(spark, tmp_path, {f"{'classeur au nom tres long ' * 2}.xlsx": book})
    (record,) = got.values()
    names = os.listdir(out)
    assert len(names) == 4 and all(len(n) <= 63 for n in names)
    assert record.rows == sum(spark.read.parquet(f"{out}/{n}").count() for n in names) == 28 + 8 + 4 + 2


def test_a_second_file_never_overwrites_the_first(spark, tmp_path):
    got, out = load(spark, tmp_path, {"x/releve.xlsx": workbook({"s": HOURS}), "y/releve.xlsx": workbook({"s": HOURS[:4]})})
    assert spark.read.parquet(f"{out}/releve").count() == 28


def test_paths_with_scheme_and_signs(spark, tmp_path):
    got, out = load(spark, tmp_path, {"Suivi [2025] {a}.xlsx": workbook({"s": HOURS})}, prefix="file:")
    (record,) = got.values()
    assert (record.status, record.rows) == ("Loaded", 28)
    assert record.path == f"file:{tmp_path}/Suivi [2025] {{a}}.xlsx"


def test_outcomes_are_kept(spark, tmp_path, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("outcomes"))
    files = {"a.xlsx": workbook({"s": HOURS}), "b.xlsx": b"no workbook"}
    first, _ = load(spark, tmp_path, files, store=store)
    second, _ = load(spark, tmp_path, files, store=store)
    kept = outcomes.read(spark, store).collect()
    assert len(kept) == len(first) + len(second) and len({r.run_id for r in kept}) == 2
    assert first["a.xlsx"].duration_s > 0 and "BadZipFile" in first["b.xlsx"].reason


def test_staged_rows_are_removed(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    load(spark, tmp_path, {"a.xlsx": workbook({"s": HOURS}), "b.xlsx": b"no workbook"}, store=str(tmp_path / "outcomes"))
    assert set(os.listdir(shared)) <= before


def test_unstable_or_vanished_files_wait(spark, contract, depot):
    first = list_arrivals(spark, [str(depot)])
    second = first.filter(~F.col("name").startswith("point")).withColumn("length", F.col("length") + (F.col("name") == "suivi.xlsx").cast("int"))
    got = {r.name: r.decision for r in gate.gate(gate.stability(first, second), contract).collect()}
    assert got["suivi.xlsx"] == got["pointages.xlsx"] == "defer"
    assert got["inconnu.xlsx"] == "reject"


def test_manifest(spark, depot):
    arrivals = list_arrivals(spark, [str(depot)])
    empty = spark.createDataFrame([], "path string, mtime timestamp, length long, run_id string")
    first = update_manifest(empty, arrivals, audit.Run(id="r1"))
    seen = spark.createDataFrame(first.collect(), first.schema)
    assert gate.new_or_updated(arrivals, seen).count() == 0
    os.utime(depot / "suivi.xlsx", (2_000_000_000, 2_000_000_000))
    os.remove(depot / ".cache")
    later = list_arrivals(spark, [str(depot), str(depot / "absent")])
    assert [r.name for r in gate.new_or_updated(later, seen).collect()] == ["suivi.xlsx"]
    after = {os.path.basename(r.path): r.run_id for r in update_manifest(seen, later, audit.Run(id="r2")).collect()}
    assert after["suivi.xlsx"] == "r2" and after["vide.xlsx"] == "r1" and ".cache" not in after


def test_watch_ignores(spark):
    names = ["a.xlsx", "~$a.xlsx", "x.part", "x.TMP", "x.lock", "x.tmpx"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r.name for r in df.filter(~gate.is_ignored_by_watch(F.col("name"))).collect()] == ["a.xlsx", "x.tmpx"]


def test_path_parts(spark):
    paths = ["/d/a.b.xlsx", "/d/.hidden", "/d/nom", "/d/x.XLSX"]
    got = gate.path_parts(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert [(r.name, r.ext) for r in got] == [("a.b.xlsx", ".xlsx"), (".hidden", ""), ("nom", ""), ("x.XLSX", ".XLSX")]


def test_archive_names_of_a_hot_name(spark):
    rows = [(f"/d/{n}", datetime(2025, 1, 1, 10, 30, s)) for n in ("a.xlsx", "b") for s in (5, 5, 1, 59)]
    files = gate.path_parts(spark.createDataFrame(rows, "path string, mtime timestamp"))
    got = sorted(r.dest for r in gate.destinations(files, F.lit("Loaded"), F.col("mtime")).collect())
    folder = "/d/Archives/Loaded_2025-01-01_1030/"
    assert got == sorted(folder + n for n in ["a.xlsx", "a__1.xlsx", "a__2.xlsx", "a__3.xlsx", "b", "b__1", "b__2", "b__3"])


def test_number_within_matches_a_plain_window(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("k"), (F.col("id") * 7 % 501).alias("t"))
    got = dedupe.number_within(df, ["k"], F.floor(F.col("t") / 50), [F.col("t")], "n").collect()
    by_key = {}
    for r in sorted(got, key=lambda r: r.t):
        by_key.setdefault(r.k, []).append(r.n)
    assert len(got) == 500 and all(v == list(range(1, len(v) + 1)) for v in by_key.values())


def test_loader_user():
    assert audit.loader_user({"LOADER_USER": "", "USERNAME": "u", "USER": "x"}) == "u"
    assert audit.loader_user({})


def test_jdbc_options():
    sink = JdbcSink("jdbc:example:db", options={"user": "u"}, write_partitions=4)
    options = sink.writer_options("t", {"a": "INTEGER", "b": "TEXT", "c": "DATE"})
    assert options == {
        "url": "jdbc:example:db", "dbtable": "public.t", "batchsize": "1000", "numPartitions": "4",
        "createTableColumnTypes": "`a` INTEGER", "user": "u",
    }
    assert column_types({"x": "TEXT", "y": "TIMESTAMP WITH TIME ZONE", "z": "DOUBLE PRECISION"}) == ""
    assert "createTableColumnTypes" not in sink.writer_options("t", {"b": "TEXT"})


def test_database_accepts_the_columns_of_every_dataset(spark):
    """Spark's own table definition for the dialect, which needs no database."""
    jvm = spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils
    dialects = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects
    frame = audit.with_audit(spark.sql("SELECT 1L AS n, 1.5D AS x, 'a' AS t, true AS b, DATE '2025-01-01' AS d, TIMESTAMP_NTZ '2025-01-01 00:00:00' AS at"), audit.Run(user="u"))
    for rules in R.INFERRED.values():
        kinds = decide.sql_types(rules)
        types = {"n": kinds["INT"], "x": kinds["FLOAT"], "t": "TEXT", "b": kinds["BOOL"], "d": kinds["DATE"], "at": kinds["DATETIME"], "created_at": "TIMESTAMP WITH TIME ZONE", "created_by": "TEXT"}
        columns = column_types(types)
        option = spark._jvm.scala.Option.apply(columns or None)
        text = jvm.schemaString(dialects.get("jdbc:postgresql://h/d"), frame._jdf.schema(), False, option)
        assert ('"n" INTEGER' in text) == (kinds["INT"] == "INTEGER")
        assert '"x" FLOAT8' in text and '"at" TIMESTAMP ' in text and '"created_at" TIMESTAMP WITH TIME ZONE' in text
    assert R.PAAE.sql_integer == "BIGINT" and R.FQT.sql_integer == "INTEGER"


def test_table_sink_replaces_and_appends(spark):
    df = spark.range(3)
    TableSink().write(df.withColumn("x", F.lit("a")), "t_replace")
    TableSink().write(df, "t_replace")
    assert spark.table("t_replace").columns == ["id"] and spark.table("t_replace").count() == 3
    TableSink(mode="append").write(df, "t_replace")
    assert spark.table("t_replace").count() == 6


def test_a_changed_file_is_loaded_again_and_an_unchanged_one_once(spark, tmp_path, tmp_path_factory):
    state, out = str(tmp_path_factory.mktemp("state")), str(tmp_path_factory.mktemp("tables"))
    for name in ("a.xlsx", "b.xlsx"):
        (tmp_path / name).write_bytes(workbook({"s": HOURS}))
    (tmp_path / "c.part").write_bytes(b"x")
    rows = [("FILE_PATH_RPA", str(tmp_path / "a.xlsx")), ("FILE_PATH_FQT", str(tmp_path / "b.xlsx"))]
    contract = gate.make_contract(spark.createDataFrame(rows, "env_key string, path string"))

    def poll():
        done = watch.run_on_changes(spark, contract, FolderSink(out), state)
        return None if done is None else sorted((os.path.basename(r.path), r.rows) for r in done.collect())

    assert poll() == [("a.xlsx", 28), ("b.xlsx", 28)]
    assert poll() is None
    (tmp_path / "a.xlsx").write_bytes(workbook({"s": HOURS[:5]}))
    os.utime(tmp_path / "a.xlsx", (2_000_000_000, 2_000_000_000))
    assert poll() == [("a.xlsx", 4)]
    assert poll() is None
    assert outcomes.read(spark, f"{state}/outcomes").count() == 3


def test_stream_sees_each_file_once(spark, tmp_path):
    folder, seen, checkpoint = tmp_path / "in", str(tmp_path / "seen"), str(tmp_path / "ck")
    folder.mkdir()

    def record(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{seen}/batch_id={batch_id}")

    def run():
        watch.watch(watch.arriving_files(spark, str(folder)), checkpoint, record, None).awaitTermination()
        return sorted(r.name for r in spark.read.parquet(seen).collect())

    (folder / "a.xlsx").write_bytes(b"x")
    (folder / "b.part").write_bytes(b"x")
    assert run() == ["a.xlsx"]
    (folder / "c.xlsx").write_bytes(b"xy")
    assert run() == ["a.xlsx", "c.xlsx"]


def test_numbers_left_free_by_earlier_runs(spark):
    at = datetime(2025, 1, 1, 10, 30)
    files = gate.path_parts(spark.createDataFrame([(f"/d/{n}", at) for n in ("a.xlsx",) * 3 + ("b", "c.xlsx", "a__2.xlsx")], "path string, mtime timestamp"))
    folder = "/d/Archives/Loaded_2025-01-01_1030/"
    old = ["a.xlsx", "a__2.xlsx", "b", *(f"b__{i}" for i in range(1, 9000)), "x.xlsx"]
    taken = spark.createDataFrame([(folder + n,) for n in old] + [("/d/Archives/Loaded_2025-01-01_1031/c.xlsx",)], "dest string")
    got = sorted(r.dest for r in gate.destinations(files, F.lit("Loaded"), F.col("mtime"), taken).collect())
    assert got == sorted(folder + n for n in ["a__1.xlsx", "a__3.xlsx", "a__4.xlsx", "b__9000", "c.xlsx", "a__2__1.xlsx"])


def test_a_second_run_in_the_same_minute_gets_the_next_name(spark, tmp_path, tmp_path_factory):
    store, out = str(tmp_path_factory.mktemp("outcomes")), str(tmp_path_factory.mktemp("tables"))
    (tmp_path / "a.xlsx").write_bytes(workbook({"s": HOURS}))
    contract = gate.make_contract(spark.createDataFrame([("FILE_PATH_RPA", str(tmp_path / "a.xlsx"))], "env_key string, path string"))
    at = datetime(2025, 1, 1, 10, 30)
    for run_id in ("r1", "r2", "r2", "r3"):
        run_once(spark, contract, FolderSink(out), audit.Run(id=run_id, at=at, user="u"), grace=0.0, store=store)
    names = {r.run_id: os.path.basename(r.dest) for r in outcomes.read(spark, store).collect()}
    assert names == {"r1": "a.xlsx", "r2": "a__1.xlsx", "r3": "a__2.xlsx"}


def test_folders_are_listed_in_tasks(spark, tmp_path):
    """Names with spaces, accents and signs of URIs, dot-files and empty files; no file passes through the driver."""
    rooms = [tmp_path / n for n in ("Mes fichiers", "été 100%", "a#b?c", "vide")]
    for i, room in enumerate(rooms):
        room.mkdir()
        for k in range(i % 3 + 1 if i < 3 else 0):
            (room / f"pièce {k}%20.xlsx").write_bytes(b"x" * k)
        (room / "dossier").mkdir()
    (rooms[0] / ".caché").write_bytes(b"")
    os.utime(rooms[0] / ".caché", (1_700_000_000, 1_700_000_000.123456))
    found = list_arrivals(spark, [*map(str, rooms), str(tmp_path / "absent"), f"file:{rooms[2]}"])
    plan = found._jdf.queryExecution().toString()
    assert "MapInPandas" in plan and "Scan ExistingRDD[folder" in plan
    got = {r.path: (r.name, r.parent, r.ext, r.length) for r in found.collect()}
    want = {}
    for room in rooms:
        for f in room.iterdir():
            if f.is_file():
                want[str(f)] = (f.name, str(room), "" if f.name.startswith(".") else ".xlsx", f.stat().st_size)
    for f in rooms[2].iterdir():
        if f.is_file():
            want[f"file:{f}"] = (f.name, f"file:{rooms[2]}", ".xlsx", f.stat().st_size)
    assert got == want
    at = found.filter(F.col("name") == ".caché").select(F.unix_millis("mtime").alias("t")).first().t
    assert at == 1_700_000_000_123
    assert list_arrivals(spark, []).count() == 0
