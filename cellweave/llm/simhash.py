"""Near-duplicates by SimHash, found through anchor points of covering codes.

A fingerprint has 64 bits: two blocks of 23 and one of 18. The anchors of a 23-bit block are the words of
the perfect binary Golay code, so every block lies within radius 3 of exactly one, its home. For the
18-bit block every word is an anchor of radius 0. Of two fingerprints that differ in at most
``2 a + 2`` bits, either one 23-bit block differs in at most ``a`` bits or the last one in none; so if
each fingerprint is copied to all anchors within radius plus ``a``, one of the two finds the other at
its home. Only fingerprints at the same anchor are compared.

Fingerprints are made unique first, so copies of a text are one. An anchor with many is compared in
blocks of bounded size, in tasks of their own. A task passes on a spanning forest of the links it finds,
not the links, and components are found from these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cellweave.llm.common import keep, rows, text_or_empty
from cellweave.llm.components import components

SEED = 42
# Fixed values of the binary Golay code: length, message bits, covering radius, generator polynomial.
LENGTH, MESSAGE, RADIUS, GENERATOR = 23, 12, 3, 0b110001110101
CHECK = LENGTH - MESSAGE
# Copies at one anchor that are compared as one block.
BLOCK = 4096
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str, width: int) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit integer."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))
    digest, ones = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), 8192):
        hashed = b"".join([digest(s, SEED) for s in shingles[at : at + 8192]])
        bits = np.unpackbits(np.frombuffer(hashed, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id`` and ``fp`` of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(doc_id, fingerprint(text, width)) for doc_id, text in rows(batch, "doc_id", "text")]
            ids, prints = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(work, "doc_id long, fp long")


class GolayAnchors:
    """For 23-bit words: the anchors within radius plus ``extra`` bits, the home first."""

    def __init__(self, extra: int):
        rest = np.arange(1 << MESSAGE, dtype=np.uint32) << CHECK
        for bit in range(LENGTH - 1, CHECK - 1, -1):
            rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK)), rest)
        self.rest = rest.astype(np.uint32)
        errors = np.array(
            [sum(1 << p for p in places) for w in range(RADIUS + extra + 1) for places in combinations(range(LENGTH), w)],
            dtype=np.uint32,
        )
        # The code is perfect, so of the errors of a syndrome the first is the only one within the radius.
        syndrome = self.syndrome(errors)
        order = np.argsort(syndrome, kind="stable")
        self.count = np.bincount(syndrome, minlength=1 << CHECK)
        place = np.arange(len(errors)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        self.errors = np.zeros((1 << CHECK, int(self.count.max())), dtype=np.uint32)
        self.errors[syndrome[order], place] = errors[order]

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return (words & ((1 << CHECK) - 1)) ^ self.rest[words >> CHECK]

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position of the word, anchor, whether it is the home."""
        syndrome = self.syndrome(words)
        count = self.count[syndrome]
        position = np.repeat(np.arange(len(words)), count)
        place = np.arange(len(position)) - np.repeat(np.cumsum(count) - count, count)
        anchors = (words[position] ^ self.errors[syndrome[position], place]) >> CHECK
        return position, anchors, place == 0


@lru_cache(maxsize=4)
def golay_anchors(extra: int) -> GolayAnchors:
    """One for each worker process."""
    return GolayAnchors(extra)


def copies(unique: DataFrame, max_bits: int) -> DataFrame:
    """Copy every fingerprint (``fp``) to its anchors: ``anchor`` numbers the block and the word."""
    extra = max(0, (max_bits - 1) // 2)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = golay_anchors(extra)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                prints = batch.column("fp").slice(at, 8192).to_numpy(zero_copy_only=False)
                words = prints.view(np.uint64)
                found = []
                for block, shift in enumerate((0, LENGTH)):
                    part = (words >> np.uint64(shift) & np.uint64((1 << LENGTH) - 1)).astype(np.uint32)
                    position, anchors, home = code.near(part)
                    found.append((prints[position], anchors.astype(np.int64) + (block << MESSAGE), home))
                last = (words >> np.uint64(2 * LENGTH)).astype(np.int64)
                found.append((prints, last + (2 << MESSAGE), np.ones(len(prints), dtype=bool)))
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["fp", "anchor", "home"])

    return unique.select("fp").mapInArrow(work, "fp long, anchor long, home boolean")


def links(copied: DataFrame, max_bits: int, block: int = BLOCK) -> DataFrame:
    """Compare stored copies anchor by anchor; ``a``, ``b`` rows that span every group of links.

    An anchor of at most ``block`` copies is one comparison. A larger one is dealt by hash into parts of
    about that size, and each part of its homes meets each part of all its copies. The table of such
    anchors has at most 2 * 2**12 + 2**18 rows, the number of anchors there are.
    """
    large = copied.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > block)
    large = large.select("anchor", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    dealt = copied.join(F.broadcast(large), "anchor", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("home").alias("left"), F.lit(True).alias("right")))
    as_left = F.transform(every, lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(True).alias("left"), (j == own).alias("right")))
    as_right = F.transform(every, lambda i: F.struct(i.alias("i"), own.alias("j"), (F.col("home") & (i == own)).alias("left"), F.lit(True).alias("right")))
    # A home in its own square would come twice; keep it once, as both.
    as_right_home = F.filter(as_right, lambda s: s["i"] != s["j"])
    squares = (
        F.when(F.col("parts").isNull(), one)
        .when(F.col("home"), F.concat(as_left, as_right_home))
        .otherwise(as_right)
    )
    dealt = dealt.select("fp", "anchor", F.explode(squares).alias("s")).select("fp", "anchor", "s.*")
    key = ("anchor", "i", "j")
    ordered = dealt.repartition(*key).sortWithinPartitions(*key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for prints, left, right in _groups(batches, key):
            a, b = _forest(prints, left, right, max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return ordered.mapInArrow(work, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of equal key in sorted batches that have something to compare."""
    names = (*key, "fp", "left", "right")
    waiting = [np.empty(0, dtype=t) for t in (*["i8"] * len(key), "i8", "?", "?")]
    for batch in batches:
        fresh = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        waiting = [np.concatenate((w, f.astype(w.dtype))) for w, f in zip(waiting, fresh, strict=True)]
        ends = np.flatnonzero(np.any([np.diff(w) != 0 for w in waiting[: len(key)]], axis=0)) + 1
        if len(ends):
            yield from _cut(waiting[len(key) :], np.concatenate(([0], ends)))
            waiting = [w[ends[-1] :] for w in waiting]
    yield from _cut(waiting[len(key) :], np.array([0, len(waiting[0])]))


def _cut(columns: list[np.ndarray], bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    for k in np.flatnonzero(np.diff(bounds) > 1):
        yield tuple(c[bounds[k] : bounds[k + 1]] for c in columns)


def _forest(prints: np.ndarray, left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Compare left with right rows; each linked row with the least row it hangs together with."""
    words = prints.view(np.uint64)
    lefts, rights = np.flatnonzero(left), np.flatnonzero(right)
    label = np.arange(len(words))
    step = max(1, (1 << 20) // max(1, len(rights)))
    for at in range(0, len(lefts), step):
        rows_ = lefts[at : at + step]
        near = np.bitwise_count(words[rows_, None] ^ words[None, rights]) <= max_bits
        u, v = np.nonzero(near)
        u, v = rows_[u], rights[v]
        other = u != v
        _unite(label, u[other], v[other])
    hangs = np.flatnonzero(label != np.arange(len(words)))
    return prints[hangs], prints[label[hangs]]


def _unite(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Lower labels until both ends of every link have the same; a label names a row of its own group."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(label, np.maximum(a, b), low)
        while (label[label] != label).any():
            label[:] = label[label]


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the least document id reachable.

    Texts are lower-cased (A-Z), words are runs without blank, tab or line ends, shingles have ``width`` words
    and count as often as they occur. Fingerprints of at most ``max_bits`` differing bits are linked.

    Defined cases: a null, empty or blank text has fingerprint zero, linked like any other; with fewer words than
    ``width`` the whole sequence is one shingle; rows of equal or null id are all returned, and a component
    whose ids are all null has a null id; other columns are ignored; an empty table gives no rows.
    """
    printed = keep(fingerprints(docs, width), "prints")
    unique = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(keep(copies(unique, max_bits), "copies"), max_bits))
    placed = unique.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.select("fp", "root").join(least, "root").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return printed.join(named, "fp", "left").select("doc_id", hexed, "component_id")


def without_near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """Keep of every group of near-duplicates the document of the least id, with its columns.

    Rows of equal id and fingerprint count as one document, so one of them stays, that of the least text; rows of equal id
    and different fingerprints are judged each by its own; rows without an id all stay.
    """
    found = keep(near_duplicates(docs, width, max_bits).withColumnRenamed("fingerprint", "fp"), "groups")
    return one_of_each(docs, found, lambda text: f"{fingerprint(text, width) & (1 << 64) - 1:016x}")


def one_of_each(docs: DataFrame, found: DataFrame, name: Callable[[str], str]) -> DataFrame:
    """Of ``docs`` a row for each id that is the least of its group, and all rows without an id.

    ``found`` has ``doc_id``, ``fp`` (what ``name`` gives for a text) and ``component_id``. Only rows of repeated ids are named again.
    """
    found = found.where("doc_id is not null")
    kept = found.where("doc_id = component_id").select("doc_id", "fp").distinct()
    repeated = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    stays = docs.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").select(docs.columns)
    again = stays.join(repeated, "doc_id", "left_semi").select(F.struct(docs.columns).alias("row"), "doc_id", text_or_empty().alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array([name(text) for _, text in rows(batch, "doc_id", "text")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, names], ["row", "doc_id", "text", "fp"])

    named = again.mapInArrow(work, StructType([*again.schema.fields, StructField("fp", StringType())]))
    named = named.join(kept, ["doc_id", "fp"], "left_semi")
    order = F.struct("text", F.xxhash64("row"))
    chosen = named.groupBy("doc_id", "fp").agg(F.min_by("row", order).alias("row")).select("row.*")
    once = stays.join(repeated, "doc_id", "left_anti").select(docs.columns)
    return once.unionByName(chosen).unionByName(docs.where("doc_id is null"))
