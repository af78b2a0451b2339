"""Session helpers: recommended settings and the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from py4j.java_gateway import JavaClass
from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. ANSI mode stays on: every conversion of untyped text
# goes through try_cast, so a bad value becomes null and never fails a job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM compiles no method above 8000 bytes of bytecode; a larger fused stage would be
    # interpreted, so let Spark generate it in smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows get heavy text work, so even a small file is worth a task for each of its row groups.
    "spark.sql.files.openCostInBytes": "262144",
}


def local_session(cores: int | str = 8, **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cellweave")
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cores) if str(cores).isdigit() else "8",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere, and let Python workers of this machine find the package.

    On a cluster the package travels with ``--py-files``.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a folder in the warehouse, which is shared as well, takes its place.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return named.rstrip("/")


_SPACE: ContextVar[str | None] = ContextVar("scratch space", default=None)


@contextmanager
def scratch_space(spark: SparkSession, label: str) -> Iterator[str]:
    """Folders made inside are removed at the end, however that comes; no frame that reads them is to be used after it."""
    space = new_folder(spark, label)
    before = _SPACE.set(space)
    try:
        yield space
    finally:
        _SPACE.reset(before)
        remove(spark, space)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path not used before inside the scratch space, or the shared folder if there is none."""
    return f"{_SPACE.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def task_count(spark: SparkSession) -> int:
    """Tasks to deal rows to where these are few and the work on each of them is much."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hadoop_path(spark: SparkSession) -> JavaClass:
    """Hadoop's class of paths, without a look at each package of its name, which costs more than what is done with a path."""
    return JavaClass("org.apache.hadoop.fs.Path", spark._jvm._gateway_client)


def can_move(spark: SparkSession, source: str, target: str) -> bool:
    """Whether both paths are on one file system, so that moving files moves no data through the driver."""
    conf, path = spark._jsc.hadoopConfiguration(), hadoop_path(spark)
    return path(source).getFileSystem(conf).getUri().equals(path(target).getFileSystem(conf).getUri())


def move(spark: SparkSession, source: str, target: str, replace: bool) -> None:
    """Move the files of a folder to another one of the same file system, in place of what is there or beside it.

    Where nothing is beside them the folder moves as a whole, which costs the same whatever it holds.
    """
    path = hadoop_path(spark)
    start, end = path(source), path(target)
    fs = end.getFileSystem(spark._jsc.hadoopConfiguration())
    if replace:
        fs.delete(end, True)
    if replace or not fs.exists(end):
        fs.mkdirs(end.getParent())
        if not fs.rename(start, end):
            raise OSError(f"{source} could not be moved to {target}")
        return
    for status in fs.listStatus(start):
        if not fs.rename(status.getPath(), path(end, status.getPath().getName())):
            raise OSError(f"{status.getPath().toString()} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder that no frame reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
