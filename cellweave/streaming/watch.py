"""Watch folders with Structured Streaming."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from cellweave.operators import gate
from cellweave.operators.audit import Run
from cellweave.plans.runner import GRACE_SECONDS, run_once, update_manifest
from cellweave.session import new_folder, remove, scratch_space, settle
from cellweave.sources.listing import child_folders, list_arrivals
from cellweave.streaming.stable import FORGET_SECONDS, listing_stream, stable_files

POLL_SECONDS = 5
MANIFEST = "path string, mtime timestamp, length long, run_id string"

FILES = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)


def arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of new files as arrivals; only file metadata is read, not the contents."""
    files = spark.readStream.format("binaryFile").schema(FILES).load(folder)
    arrivals = files.select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"),
        "length",
        F.col("modificationTime").alias("mtime"),
    )
    return gate.path_parts(arrivals).filter(~gate.is_ignored_by_watch(F.col("name")))


def watch(
    arrivals: DataFrame,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None],
    poll_seconds: int | None = POLL_SECONDS,
) -> StreamingQuery:
    """Run ``on_batch`` for each micro-batch; without a poll interval, process what is there and stop.

    The checkpoint keeps what was seen, so a restart does not load everything again. The file
    stream does not emit a changed file again: for updates, compare a listing with the manifest
    (``gate.new_or_updated``).
    """
    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if poll_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()


def run_on_changes(
    spark: SparkSession, contract: DataFrame, sink, state: str, run: Run | None = None, grace: float = GRACE_SECONDS
) -> DataFrame | None:
    """One poll: list the contract's folders, run what is new or changed, remember it. None if nothing is.

    What is new is listed again after ``grace`` seconds; a listed file whose length has changed by then waits for another
    poll, which sees it as new again. ``state`` is a folder with the outcomes of all polls and the manifest, one small
    record for each file that still exists; a poll writes the next version of the manifest and removes those before
    the last. A poll that broke before that is repeated under its number with the same loads, so its outcomes replace
    those of the broken one and a sink that publishes adds nothing twice. An idle poll writes nothing.
    """
    folders = [r.parent for r in gate.watched_folders(contract).orderBy("parent").toLocalIterator()]

    def listing() -> DataFrame:
        return list_arrivals(spark, folders).filter(~gate.is_ignored_by_watch(F.col("name")))

    versions = sorted(int(v) for v in child_folders(spark, f"{state}/manifest"))
    last = f"{state}/manifest/{versions[-1]}" if versions else None
    known = spark.read.schema(MANIFEST).parquet(last) if last else spark.createDataFrame([], MANIFEST)
    if gate.new_or_updated(listing(), known).isEmpty():
        return None
    with scratch_space(spark, "poll"):
        arrivals = settle(listing())
        changed = gate.new_or_updated(arrivals, known)
        time.sleep(grace)
        checked = settle(gate.stability(changed, listing()))
        after = versions[-1] + 1 if versions else 0
        run = run or Run(id=f"poll-{after}")
        records = run_once(spark, contract, sink, run, arrivals=checked, store=f"{state}/outcomes", repeatable=True)
        waiting = gate.gate(checked, contract).filter(F.col("decision") == gate.DEFER)
        seen = arrivals.join(waiting, "path", "left_anti")
        # A poll that broke while it wrote the manifest has left a part of it under this number.
        update_manifest(known, seen, run).write.mode("overwrite").parquet(f"{state}/manifest/{after}")
    for old in versions[:-1]:
        remove(spark, f"{state}/manifest/{old}")
    return records


def load_stable(
    spark: SparkSession,
    listings: DataFrame,
    contract: DataFrame,
    sink,
    state: str,
    checkpoint: str,
    grace: float = GRACE_SECONDS,
    poll_seconds: int | None = POLL_SECONDS,
) -> StreamingQuery:
    """Load files of a stream of listings once they have kept their length for ``grace`` seconds.

    The stream's state stands for the manifest. A micro-batch that is repeated has the same number and the same loads,
    so its outcomes replace themselves and a sink that publishes adds nothing twice.
    """
    wanted = listings.filter(~gate.is_ignored_by_watch(F.regexp_extract("path", "[^/]*$", 0)))
    ready = stable_files(wanted, grace, FORGET_SECONDS if poll_seconds else None)

    def load(batch: DataFrame, batch_id: int) -> None:
        with scratch_space(spark, "batch"):
            # Written once, since reading the batch again would list the folders and move the state again.
            folder = new_folder(spark, "ready")
            batch.write.parquet(folder)
            arrivals = gate.path_parts(spark.read.schema(batch.schema).parquet(folder))
            if not arrivals.isEmpty():
                run_once(spark, contract, sink, Run(id=f"batch-{batch_id}"), arrivals=arrivals, store=f"{state}/outcomes", repeatable=True)

    writer = ready.writeStream.outputMode("update").foreachBatch(load).option("checkpointLocation", checkpoint)
    if poll_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()


def watch_contract(
    spark: SparkSession,
    contract: DataFrame,
    sink,
    state: str,
    checkpoint: str,
    poll_seconds: int = POLL_SECONDS,
    grace: float = GRACE_SECONDS,
) -> StreamingQuery:
    """Poll the contract's folders and load files that are new or changed and stable, for as long as the query runs."""
    folders = [r.parent for r in gate.watched_folders(contract).orderBy("parent").toLocalIterator()]
    return load_stable(spark, listing_stream(spark, folders), contract, sink, state, checkpoint, grace, poll_seconds)


def latest_versions(listings: DataFrame) -> DataFrame:
    """Change feed: the newest (mtime, length) per path over a stream of listings.

    The state is one small record per path; use update mode, so that a batch emits changes only.
    """
    newest = F.max(F.struct("mtime", "length")).alias("v")
    return listings.groupBy("path").agg(newest).select("path", "v.mtime", "v.length")


def first_sightings(listings: DataFrame) -> DataFrame:
    """Each (path, mtime) once: new files and new versions."""
    return listings.dropDuplicates(["path", "mtime"])


def append_versions(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer for ``latest_versions``: one folder per batch, so a retried batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The newest version per path from what ``append_versions`` wrote."""
    written = spark.read.parquet(path)
    return latest_versions(written.select("path", "mtime", "length"))
