"""What the operators share: the scratch folder, frames kept as tables, files written by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, label: str) -> str:
    """A path not used before in the folder all executors share.

    ``spark.checkpoint.dir`` names that folder. Where it is unset, as in tests, a folder
    in the warehouse, which is shared as well, takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    # Tasks do not know which file system a path without scheme belongs to.
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def tune(spark: SparkSession) -> SparkSession:
    """Hand rows to Python workers in small batches, since a text may have a hundred thousand characters.

    Workers of this machine find the package whatever the working folder; on a cluster it travels with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a frame to the scratch folder and read it back: computed once, no lineage to lose. Also gives the folder."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def keep(df: DataFrame, label: str) -> DataFrame:
    """As ``written``, for a frame the result reads, so that its folder stays."""
    return written(df, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch`` named and no frame reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder in the form Spark names it (``file:/x``, ``hdfs://…``, ``/x``)."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


@contextmanager
def whole_file(folder: str, name: str) -> Iterator[pa.NativeFile]:
    """Open a file for writing that appears under its name only once complete.

    A repeated attempt of a task replaces the file by an equal one.
    """
    system, root = filesystem(folder)
    system.create_dir(root, recursive=True)
    draft = f"{root}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        yield out
    system.move(draft, f"{root}/{name}")


def rows(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """Rows of a batch, converted a slice at a time so that long texts are not all held twice."""
    step = 256
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)
