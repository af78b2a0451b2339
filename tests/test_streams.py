"""Stability in a stream, repeatable publishing, and what runs leave behind."""

import os
import time
from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from cellweave.operators import audit, gate
from cellweave.plans import ingest, runner
from cellweave.session import new_folder, scratch_space, shared_dir
from cellweave.sinks import outcomes
from cellweave.sinks.published import PublishedSink
from cellweave.sinks.tables import FolderSink
from cellweave.streaming import stable, watch
from workloads.books import workbook

HOURS = [["Trigramme", "Semaine", "Heures"], *[["abc", f"2025-01-{d:02}", d] for d in range(1, 29)]]
START = datetime(2025, 1, 1)
LISTED = "path string, length long, mtime timestamp, listed_at timestamp"


def contract_of(spark, **paths):
    rows = [(f"FILE_PATH_{k}", str(p)) for k, p in paths.items()]
    return gate.make_contract(spark.createDataFrame(rows, "env_key string, path string"))


class Listings:
    """A stream of listings, one micro-batch for each call."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, str(folder), 0

    def add(self, second, *files):
        rows = [(p, n, START, START + timedelta(seconds=second)) for p, n in files]
        self.spark.createDataFrame(rows, LISTED).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(LISTED).parquet(self.folder)


def test_a_growing_file_waits_over_three_batches_and_is_loaded_once(spark, tmp_path):
    path = tmp_path / "a.xlsx"
    path.write_bytes(workbook({"s": HOURS}))
    size = path.stat().st_size
    contract, listings = contract_of(spark, RPA=path), Listings(spark, tmp_path / "listings")
    state, out = str(tmp_path / "state"), str(tmp_path / "out")

    def poll(second, *files):
        listings.add(second, *files)
        watch.load_stable(
            spark, listings.stream(), contract, FolderSink(out), state, str(tmp_path / "checkpoint"), grace=2.0, poll_seconds=None
        ).awaitTermination()
        return [] if not os.path.exists(f"{state}/outcomes") else sorted((os.path.basename(r.path), r.status) for r in outcomes.read(spark, f"{state}/outcomes").collect())

    assert poll(0, (str(path), 10), (str(tmp_path / "b.part"), 5)) == []
    assert poll(3, (str(path), 20), (str(tmp_path / "b.part"), 5)) == []
    assert poll(6, (str(path), size)) == []
    assert poll(7, (str(path), size)) == []
    assert poll(8, (str(path), size)) == [("a.xlsx", "Loaded")]
    assert poll(12, (str(path), size)) == [("a.xlsx", "Loaded")]
    assert spark.read.parquet(f"{out}/a").count() == 28


def test_versions_of_a_file_each_come_once(spark, tmp_path):
    listings, found = Listings(spark, tmp_path / "in"), {}

    def record(batch, batch_id):
        found[batch_id] = sorted((r.path, r.length) for r in batch.collect())

    def run(*polls):
        for second, *files in polls:
            listings.add(second, *files)
        query = stable.stable_files(listings.stream(), 5.0).writeStream.outputMode("update").foreachBatch(record)
        query.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()

    run((0, ("x", 1), ("y", 7)), (4, ("x", 1)), (5, ("x", 1)), (6, ("x", 1)))
    run((9, ("x", 2), ("y", 7)), (20, ("x", 3)), (21, ("x", 3)))
    run((25, ("x", 3)), (40, ("x", 2), (None, 4)), (46, ("x", 2)))
    assert [found[k] for k in sorted(found)] == [[("x", 1)], [("y", 7)], [("x", 2), ("x", 3)]]


def test_live_stream_loads_a_file_that_rests(spark, tmp_path):
    depot, out, state = tmp_path / "depot", str(tmp_path / "out"), str(tmp_path / "state")
    depot.mkdir()
    (depot / "a.xlsx").write_bytes(workbook({"s": HOURS}))
    before = set(os.listdir(shared_dir(spark)))
    contract = contract_of(spark, RPA=depot / "a.xlsx", FQT=tmp_path / "missing" / "b.xlsx")
    query = watch.watch_contract(spark, contract, FolderSink(out), state, str(tmp_path / "ck"), poll_seconds=1, grace=1.0)
    try:
        until = time.monotonic() + 90
        loaded: list[str] = []
        # The batch that loads the file has to end by itself, or stopping the stream races with its last steps.
        while not any(os.path.exists(tmp_path / "ck" / "commits" / n) for n in loaded) and time.monotonic() < until:
            assert query.isActive, query.exception()
            time.sleep(0.5)
            stored = os.listdir(f"{state}/outcomes") if os.path.isdir(f"{state}/outcomes") else []
            loaded = [n.removeprefix("run_id=batch-") for n in stored if n.startswith("run_id=batch-")]
    finally:
        query.stop()
    assert [(os.path.basename(r.path), r.rows) for r in outcomes.read(spark, f"{state}/outcomes").collect()] == [("a.xlsx", 28)]
    assert set(os.listdir(shared_dir(spark))) <= before


def test_a_poll_waits_for_a_file_that_grows(spark, tmp_path, monkeypatch):
    path, state = tmp_path / "a.xlsx", str(tmp_path / "state")
    whole = workbook({"s": HOURS})
    path.write_bytes(whole[:100])
    contract, sink = contract_of(spark, RPA=path), FolderSink(str(tmp_path / "out"))
    # The poll's own sleep alone: threads of the session sleep as well.
    monkeypatch.setattr(watch, "time", SimpleNamespace(sleep=lambda seconds: path.write_bytes(whole)))
    assert watch.run_on_changes(spark, contract, sink, state).count() == 0
    monkeypatch.setattr(watch, "time", SimpleNamespace(sleep=lambda seconds: None))
    assert [r.rows for r in watch.run_on_changes(spark, contract, sink, state).collect()] == [28]
    assert watch.run_on_changes(spark, contract, sink, state) is None


def test_a_poll_that_breaks_before_its_manifest_is_repeated_once(spark, tmp_path, monkeypatch):
    path, state = tmp_path / "releve.xlsx", str(tmp_path / "state")
    path.write_bytes(workbook({"s": HOURS}))
    contract, sink = contract_of(spark, RPA=path), PublishedSink(str(tmp_path / "tables"))

    def poll():
        return watch.run_on_changes(spark, contract, sink, state, grace=0.0)

    def broken(*args):
        raise OSError("lost")

    monkeypatch.setattr(watch, "update_manifest", broken)
    with pytest.raises(OSError):
        poll()
    monkeypatch.undo()
    # A file that comes meanwhile makes it another poll, but not another load of the first one.
    other = tmp_path / "autre.xlsx"
    other.write_bytes(workbook({"s": HOURS[:5]}))
    contract = contract_of(spark, RPA=path, FQT=other)
    assert sorted(r.rows for r in poll().collect()) == [4, 28]
    assert spark.table("releve").count() == 28 and spark.table("autre").count() == 4
    assert outcomes.read(spark, f"{state}/outcomes").count() == 2
    path.write_bytes(workbook({"s": HOURS[:3]}))
    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert [r.rows for r in poll().collect()] == [2]
    assert spark.table("releve").count() == 30


def test_what_is_not_published_is_not_seen(spark, tmp_path, monkeypatch):
    sink, df = PublishedSink(str(tmp_path / "t")), spark.range(3).withColumn("x", F.lit("a"))
    sink.write(df, "unseen", load_id="a")
    df.write.parquet(sink.folder("unseen", "b"))  # as a load that broke before its change of the catalog
    assert spark.table("unseen").count() == 3
    assert sink.write(df.limit(2), "unseen", load_id="b") is None
    assert sink.write(df, "unseen", load_id="b") == 2
    assert spark.table("unseen").count() == 5
    with pytest.raises(ValueError, match="x is string, not bigint"):
        sink.write(spark.range(1).withColumn("x", F.lit(1).cast("long")), "unseen", load_id="c")
    with pytest.raises(ValueError, match="needs an id"):
        sink.write(df, "unseen")
    sink.write(spark.range(1).withColumn("y", F.lit(1)), "unseen", load_id="d")
    assert {(r.x, r.y) for r in spark.table("unseen").collect()} == {("a", None), (None, 1)}


def test_a_replaced_table_keeps_the_load_before(spark, tmp_path):
    sink = PublishedSink(str(tmp_path / "t"), mode="overwrite")
    for n, load_id in enumerate("abcd", 1):
        sink.write(spark.range(n).withColumnRenamed("id", f"c{n}"), "replaced", load_id=load_id)
    assert spark.table("replaced").columns == ["c4"] and spark.table("replaced").count() == 4
    assert sink.write(spark.range(9), "replaced", load_id="d") == 4
    assert sorted(os.listdir(tmp_path / "t" / "replaced")) == ["load_id=c", "load_id=d"]


def test_runs_and_idle_polls_leave_no_folder(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook({"s": HOURS}))
    (tmp_path / "b.xlsx").write_bytes(b"no workbook")
    contract, state = contract_of(spark, RPA=tmp_path / "a.xlsx", SPA=tmp_path / "b.xlsx"), str(tmp_path / "state")
    before = set(os.listdir(shared_dir(spark))) if os.path.isdir(shared_dir(spark)) else set()
    assert watch.run_on_changes(spark, contract, FolderSink(str(tmp_path / "out")), state, grace=0.0).count() == 2
    for _ in range(10):
        assert watch.run_on_changes(spark, contract, FolderSink(str(tmp_path / "out")), state, grace=0.0) is None
    assert set(os.listdir(shared_dir(spark))) <= before


def test_scratch_space_goes_whatever_happens(spark):
    with pytest.raises(KeyError):
        with scratch_space(spark, "outer") as outer:
            inner = new_folder(spark, "x")
            assert inner.startswith(f"{outer}/")
            spark.range(1).write.parquet(inner)
            raise KeyError
    assert not os.path.exists(outer) and not new_folder(spark, "x").startswith(outer)


def test_a_worker_without_the_package_ends_the_run(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook({"s": HOURS}))

    class Broken:
        def write(self, *args):
            raise PythonException("ModuleNotFoundError: No module named 'cellweave'")

    assert not ingest.is_data_error(PythonException("ImportError: x")) and ingest.is_data_error(ValueError("bad cell"))
    with pytest.raises(PythonException):
        runner.run_once(spark, contract_of(spark, RPA=tmp_path / "a.xlsx"), Broken(), audit.Run(user="u"), grace=0.0)


def test_states_of_many_paths_lie_in_buckets(spark, tmp_path):
    """A path with a state and a call of its own each cost a hundred times the work."""
    n, found = 3 * stable.BUCKETS, []
    parts = "'p' || id AS path", "id % 5 AS length", "timestamp_seconds(id % 3) AS mtime"
    for at in (100, 104, 106):
        spark.range(n).selectExpr(*parts, f"timestamp_seconds({at} + id % 7) AS listed_at").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("path string, length long, mtime timestamp, listed_at timestamp").parquet(str(tmp_path / "in"))
        writer = stable.stable_files(stream, 5.0).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ck"))
        query = writer.foreachBatch(lambda b, _: found.extend(b.collect())).trigger(availableNow=True).start()
        query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= stable.BUCKETS
    assert sorted((r.path, r.length, r.listed_at.second) for r in found) == sorted((f"p{i}", i % 5, (106 + i % 7) % 60) for i in range(n))


def test_versions_let_through_are_those_of_one_listing_after_another():
    random, wait = np.random.default_rng(3), 5
    records, states = None, {}
    for batch in range(6):
        size = 400
        listed = pd.DataFrame({
            "path": random.choice([f"p{i}" for i in range(40)], size), "length": random.choice(2, size, p=[0.9, 0.1]),
            "mtime": random.choice(2, size, p=[0.9, 0.1]), "listed_at": random.integers(0, 20, size) + 7 * batch,
        })
        records, through = stable._advance(records, listed, wait, batch)
        expected = []
        for r in listed.sort_values(["listed_at", "mtime", "length"]).itertuples():
            version, since, released = states.get(r.path, (None, 0, False))
            if version != (r.length, r.mtime):
                version, since, released = (r.length, r.mtime), r.listed_at, False
            if not released and r.listed_at - since >= wait:
                released = True
                expected.append((r.path, *version, r.listed_at))
            states[r.path] = version, since, released
        assert expected and sorted(through.itertuples(index=False, name=None)) == sorted(expected)
        records = stable._unpacked(stable._packed(records))
        assert {r.path: ((r.length, r.mtime), r.since, r.released) for r in records.itertuples()} == states
        assert set(records[records["seen"] == batch]["path"]) == set(listed["path"])
