"""Listings as a stream, and the files in them that have come to rest."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cellweave.sources.listing import list_folders, qualified

# Of the paths of a bucket: a table in Arrow's file format.
STATE = "paths binary"
# Paths are dealt by hash to so many groups, since a call of Python for each path costs far more than its work. A running stream keeps
# its states by bucket, so the number is fixed: of a hundred million paths a bucket has a hundred thousand.
BUCKETS = 1024
FOUND = "path string, length long, mtime long, listed_at long"
# A path that has not been listed for so long is forgotten.
FORGET_SECONDS = 3600.0


def listing_stream(spark: SparkSession, folders: Iterable[str]) -> DataFrame:
    """A listing of the folders with every micro-batch: ``path``, ``length``, ``mtime``, ``listed_at``.

    A clock gives one row a batch, and a task lists a folder. Folders without scheme are those of Spark's
    default file system; paths are written like their folders. A folder that is missing is empty.
    """
    named = qualified(spark, folders)
    places = F.array(*[F.struct(F.lit(n).alias("folder"), F.lit(u).alias("uri")) for n, u in named])
    clock = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    each = clock.select(F.inline(places)).repartition(max(1, len(named)), "folder")
    return list_folders(each).select("path", "length", F.timestamp_micros("mtime").alias("mtime"), F.current_timestamp().alias("listed_at"))


def stable_files(listings: DataFrame, grace: float, forget: float | None = None) -> DataFrame:
    """Of a stream of listings each version of a file once, when a listing shows it unchanged for ``grace`` seconds.

    The state has a record for each path: its length and time of change, since when they have been so, and whether the version has
    been let through; records of paths of one hash bucket lie together. A change starts the time again. Listings of one path come in the
    order of their batches; within a batch they are sorted. With ``forget`` a path that no listing has had for so many seconds, by the
    clock, is forgotten and would be new; such a stream has batches as long as it runs, so it is not one to process what is there and stop.
    """
    wait = round(grace * 1_000_000)
    keep = None if forget is None else round(forget * 1000)
    timeout = GroupStateTimeout.NoTimeout if forget is None else GroupStateTimeout.ProcessingTimeTimeout

    def step(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = 0 if keep is None else state.getCurrentProcessingTimeMs()
        known = _unpacked(state.get[0]) if state.exists else None
        if state.hasTimedOut:
            records = known
        else:
            records, through = _advance(known, pd.concat(list(batches)), wait, now)
            yield through
        if keep is not None:
            records = records[records["seen"] + keep > now]
            if records.empty:
                state.remove()
                return
        state.update((_packed(records),))
        if keep is not None:
            state.setTimeoutDuration(max(1, int(records["seen"].min()) + keep - now))

    known = listings.filter("path is not null and listed_at is not null").select(
        "path",
        F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length"),
        F.coalesce(F.unix_micros(F.col("mtime").cast("timestamp")), F.lit(0)).alias("mtime"),
        F.unix_micros(F.col("listed_at").cast("timestamp")).alias("listed_at"),
    )
    dealt = known.withColumn("bucket", F.pmod(F.xxhash64("path"), F.lit(BUCKETS)))
    found = dealt.groupBy("bucket").applyInPandasWithState(step, FOUND, STATE, "update", timeout)
    return found.withColumns({c: F.timestamp_micros(c) for c in ("mtime", "listed_at")})


def _packed(records: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(records, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_file(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_file(pa.BufferReader(bytes(packed))).read_all().to_pandas()


def _advance(known: pd.DataFrame | None, listed: pd.DataFrame, wait: int, now: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The records of the paths of a bucket after some listings of them, and the versions that are let through."""
    new = listed.assign(since=listed["listed_at"], released=False, seen=now)
    rows = new.assign(old=False) if known is None else pd.concat([known.assign(listed_at=known["since"], old=True), new.assign(old=False)])
    path = pd.factorize(rows["path"])[0]
    # A path's record stands before its listings, whatever their times.
    order = np.lexsort((rows["length"], rows["mtime"], rows["listed_at"], ~rows["old"].to_numpy(bool), path))
    rows, path = rows.iloc[order], path[order]
    length, mtime, listed_at, old = (rows[c].to_numpy() for c in ("length", "mtime", "listed_at", "old"))
    first = np.r_[True, path[1:] != path[:-1]]
    fresh = first | np.r_[True, (length[1:] != length[:-1]) | (mtime[1:] != mtime[:-1])]
    start = np.flatnonzero(fresh)
    version = np.cumsum(fresh) - 1
    since, released = rows["since"].to_numpy()[start], rows["released"].to_numpy(bool)[start]
    ripe = np.flatnonzero(~old.astype(bool) & ~released[version] & (listed_at - since[version] >= wait))
    ripened, nth = np.unique(version[ripe], return_index=True)
    through = rows.iloc[ripe[nth]][["path", "length", "mtime", "listed_at"]].reset_index(drop=True)
    released = released.copy()
    released[ripened] = True
    last = np.flatnonzero(np.r_[first[1:], True])
    records = rows.iloc[last][["path", "length", "mtime"]].assign(since=since[version[last]], released=released[version[last]])
    # Only what these listings had was seen now.
    return records.assign(seen=rows["seen"].to_numpy()[last]), through
