"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches, those of the largest ids first. A batch's line hashes are added up to one row
for each hash (how many documents hold it, the largest id among them), merge-anti-joined with the hashes
the runs already have in enough documents, whose fate is settled, and written as a run: a table sorted
by hash in buckets of hash. As soon as a level has two runs they are merged into one of the next level, so there
are as many runs as the logarithm of the batches. Runs meet bucket by bucket, without a shuffle.

A line costs a hash and three numbers, added up before anything is shuffled, so a line that all documents hold is
a row for each task. Documents move once, to meet the places of the lines they lose.

Everything is DataFrame functions.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import discard, keep, scratch, text_or_empty

# The white space that does not count at both ends of a line.
ENDS = " \t\n\x0b\f\r"
HASH = ("h1", "h2")
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(ENDS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def _hashes(key: Column) -> tuple[Column, Column]:
    """96 bits of hash from two functions."""
    return F.xxhash64(key).alias("h1"), F.hash(key).alias("h2")


def lines_of(text: str) -> Column:
    return F.split(text_or_empty(text), "\n", -1)


@dataclass
class Run:
    name: str
    path: str
    level: int


class Runs:
    """The runs so far, at most one of each level between batches."""

    def __init__(self, spark: SparkSession, min_docs: int):
        self.spark = spark
        self.min_docs = min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[Run] = []

    def add(self, sightings: DataFrame) -> None:
        """Anti-join a batch with what is settled and add the rest as a run of level 0."""
        for run in self.runs:
            settled = self.spark.table(run.name).where(F.col("docs") >= self.min_docs).select(*HASH)
            sightings = sightings.join(settled, list(HASH), "left_anti")
        self.runs.append(self._write(sightings, 0))
        while len(self.runs) > 1 and self.runs[-1].level == self.runs[-2].level:
            second, first = self.runs.pop(), self.runs.pop()
            self.runs.append(self._write(self._merged(first, second), first.level + 1))
            self._drop(first, second)

    def repeated(self) -> DataFrame:
        """Hashes in enough documents, with the largest id that holds them."""
        while len(self.runs) > 1:
            second, first = self.runs.pop(), self.runs.pop()
            self.runs.append(self._write(self._merged(first, second), first.level + 1))
            self._drop(first, second)
        (run,) = self.runs
        found = self.spark.table(run.name).where(F.col("docs") >= self.min_docs)
        found = keep(found.select(*HASH, "keeper"), "repeated-lines")
        self._drop(run)
        self.runs = []
        return found

    def _merged(self, first: Run, second: Run) -> DataFrame:
        a, b = self.spark.table(first.name).alias("a"), self.spark.table(second.name).alias("b")
        docs = F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))
        keeper = F.greatest("a.keeper", "b.keeper")
        return a.join(b, list(HASH), "full").select(*HASH, docs.alias("docs"), keeper.alias("keeper"))

    def _write(self, rows: DataFrame, level: int) -> Run:
        run = Run(f"line_run_{uuid.uuid4().hex}", scratch(self.spark, "line-run"), level)
        writer = rows.select(*HASH, "docs", "keeper").write.format("parquet").option("path", run.path)
        writer.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(run.name)
        return run

    def _drop(self, *runs: Run) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE {run.name}")
            discard(self.spark, run.path)


def sightings(docs: DataFrame, min_chars: int) -> DataFrame:
    """Per line hash: the documents that hold it and the largest id among them; a line counts once for a document."""
    bare = F.transform(lines_of("text"), line_key)
    long_enough = F.filter(bare, lambda key: F.char_length(key) >= min_chars)
    hashed = F.array_distinct(F.transform(long_enough, lambda key: F.struct(*_hashes(key))))
    each = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.explode(hashed).alias("h"))
    return each.groupBy(F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2")).agg(
        F.count("*").alias("docs"), F.max("id").alias("keeper")
    )


def batches_of(docs: DataFrame, count: int) -> list[DataFrame]:
    """Ranges of document ids holding about as many rows each, the largest ids first, those without id last."""
    shares = [i / count for i in range(1, count)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares)).first()[0] if shares else None
    bounds = sorted(set(bounds or []))
    column, parts = F.col("doc_id"), []
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        inside = F.lit(True) if high is None else column <= high
        inside = inside & (column > low) if low is not None else inside | column.isNull()
        parts.append(docs.where(inside))
    return parts[::-1]


def without_repeated_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 3
) -> DataFrame:
    """Documents with ``lines`` (all lines), ``dropped`` (places of those to drop, null if none) and a struct ``doc`` of
    their columns.

    A line's key is the line without white space (blank, tab to carriage return) at both ends, A-Z in lower case. Keys of
    at least ``min_chars`` code points in at least ``min_docs`` documents lose their lines except in the document of
    the largest id that holds them.

    Defined cases: a null or empty text is one empty line; every row is a document, and rows that share the largest
    id all keep the line; a missing id is the smallest; a text or line of any length counts whole; a document may lose all its lines; other columns, whatever
    their names, come along; an empty table gives no rows.
    """
    runs = Runs(docs.sparkSession, min_docs)
    for batch in batches_of(docs.select("doc_id", "text"), batches):
        runs.add(sightings(batch, min_chars))
    repeated = runs.repeated()
    identity = (F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_text"))
    placed = docs.select(*identity, F.posexplode(lines_of("text")).alias("place", "line"))
    key = line_key(F.col("line"))
    placed = placed.where(F.char_length(key) >= min_chars).select("_id", "_text", "place", *_hashes(key))
    lost = placed.join(repeated, list(HASH)).where("_id <> keeper")
    lost = lost.groupBy("_id", "_text").agg(F.collect_set("place").alias("dropped"))
    whole = docs.select(*identity, F.struct(*docs.columns).alias("doc"))
    whole = whole.join(lost, ["_id", "_text"], "left")
    return whole.select("doc", lines_of("doc.text").alias("lines"), "dropped")


def kept_text() -> Column:
    """The text left of ``lines`` without ``dropped`` ones."""
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    stays = F.transform(F.array_except(places, "dropped"), lambda i: F.get("lines", i))
    return F.when(F.col("dropped").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(stays, "\n"))


def describe(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 3) -> DataFrame:
    """Per document: its lines, how many are dropped, and a digest of what stays."""
    docs = docs.select("doc_id", "text")
    return without_repeated_lines(docs, min_chars, min_docs, batches).select(
        F.col("doc.doc_id").alias("doc_id"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.sha2(kept_text(), 256).alias("kept_sha256"),
    )


def cleaned(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 3) -> DataFrame:
    """Documents without their repeated lines, all columns kept; ``n_chars``, if there, counts what stays.

    A text that loses nothing stays as it is, null included.
    """
    done = without_repeated_lines(docs, min_chars, min_docs, batches)
    text = F.when(F.col("dropped").isNull(), F.col("doc.text")).otherwise(kept_text())
    changed = {"text": text}
    if "n_chars" in docs.columns:
        stays = F.col("dropped").isNull()
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(stays, F.col("doc.n_chars")).otherwise(F.char_length(kept_text()).cast(kind))
    return done.select(*(changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))
