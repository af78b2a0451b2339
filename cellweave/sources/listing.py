"""Folder listing of arrivals.

Folders are listed in tasks, since the binary file source hides dot-files and drops empty files, which the gate must
see. A listing holds names only, one entry per file, and none of them in the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.gate import path_parts

# Schemes of the file systems Arrow opens by themselves; folders of others are listed by the driver through Hadoop.
ARROW_SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss")
FOUND_BATCH = 10_000
SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def literal_path(path: str) -> str:
    """The path for a reader that would take brackets, braces, stars and question marks for patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def qualified(spark: SparkSession, paths: Iterable[str]) -> list[tuple[str, str]]:
    """Each path with its URI, which names its file system: Spark's default one where the path has no scheme."""
    conf, named = spark._jsc.hadoopConfiguration(), []
    for written in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(written)
        named.append((written, path.getFileSystem(conf).makeQualified(path).toUri().toASCIIString()))
    return named


def arrow_path(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as ``qualified`` gives it."""
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))


def files_in(folder: str, uri: str) -> Iterator[tuple[str, int, int]]:
    """Path, length and time of change in microseconds of a folder's files. A folder that is missing is empty."""
    system, root = arrow_path(uri)
    for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if f.is_file:
            yield f"{folder.rstrip('/')}/{f.base_name}", f.size, f.mtime_ns // 1000


def list_folders(folders: DataFrame) -> DataFrame:
    """``path``, ``length``, ``mtime`` (microseconds) of the files of folders, given as ``folder`` and ``uri``, a task for some of them."""
    return folders.mapInPandas(_list, "path string, length long, mtime long")


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for folder, uri in zip(batch["folder"], batch["uri"], strict=True):
            files = list(files_in(folder, uri))
            for at in range(0, len(files), FOUND_BATCH):
                yield pd.DataFrame(files[at : at + FOUND_BATCH], columns=["path", "length", "mtime"])


def list_arrivals(spark: SparkSession, folders: Iterable[str]) -> DataFrame:
    """Arrivals of the folders: (path, name, parent, ext, length, mtime), a path written like its folder. Missing folders are skipped.

    The folders are listed whenever the frame is computed; settle it to hold on to a listing. Times are in milliseconds.
    """
    named = qualified(spark, folders)
    if all(uri.partition(":")[0] in ARROW_SCHEMES for _, uri in named):
        places = spark.createDataFrame(named, "folder string, uri string")
        tasks = min(len(named), 4 * spark.sparkContext.defaultParallelism)
        files = list_folders(places.repartition(max(1, tasks))).select("path", "length", F.floor(F.col("mtime") / 1000).alias("millis"))
    else:
        files = spark.createDataFrame(_listed_by_driver(spark, [f for f, _ in named]), "path string, length long, millis long")
    return path_parts(files).select("path", "name", "parent", "ext", "length", F.timestamp_millis("millis").alias("mtime"))


def _listed_by_driver(spark: SparkSession, folders: list[str]) -> list[tuple[str, int, int]]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs_ = path.getFileSystem(conf)
        if not fs_.exists(path):
            continue
        entries = fs_.listStatusIterator(path)
        while entries.hasNext():
            e = entries.next()
            if e.isFile():
                # A path reads like that of its folder: with scheme and bucket if the folder has them.
                name = e.getPath().toString() if ":" in folder else e.getPath().toUri().getPath()
                found.append((name, e.getLen(), e.getModificationTime()))
    return found


def child_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder, none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return [e.getPath().getName() for e in fs.listStatus(path) if e.isDirectory()]
