"""Spelling variants grouped by PartEnum signatures.

Words at edit distance one differ little in their letters: the multiset of a word's letters, taken as a binary vector with a
dimension for the first, second, ... occurrence of each letter, changes in at most two dimensions. PartEnum finds all pairs of vectors
within that Hamming distance: the dimensions are parted into ``PARTS`` parts, and a word has a signature for each choice of two parts,
made of the vector without these two (one first-level part, as many second-level ones as there are parts). Vectors
that differ in two dimensions differ in at most two parts, so they share the signature without these. Words with equal
signatures are brought together, and a pair is verified where it meets for the first time, in the signature without the first two parts that cover its
differences: by the Hamming distance of the vectors, then by the true edit distance. Only verified pairs leave the task. (As a join of
Spark's with these conditions the same took 0.5 µs for a pair that meets, several times the check's limit.)

Parts are balanced by how often words hold a dimension, since even parts leave the fewest words with equal signatures.

Words are counted in the tasks that read the texts, then added up. Chains of forms end quickly, since each next word is several times as
frequent, and are followed by doubling: a round joins words with a form only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import discard, keep, rows, text_or_empty, written

# Parts of the dimensions, and the choices of two that signatures leave out.
PARTS = 6
LEFT_OUT = list(combinations(range(PARTS), 2))
MIX, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
# Occurrences of a letter that are dimensions of their own choice of part; further ones are dealt in turn.
COUNTED = 8
SAME = tuple(f"same_{i}" for i in range(PARTS - 2))
LEFT = ("first_out", "second_out")
# Words of equal signature that one task compares, rows a task looks at at a time and pairs of them.
BLOCK = 4096
GATHERED = 1 << 16
PAIRS = 1 << 18
# Longer words are compared one by one.
WIDTH = 64
# Different words a task counts before it passes them on.
HELD = 200_000


def word_counts(docs: DataFrame, least_chars: int, least: int, one_in: int | None) -> DataFrame:
    """``word`` and its occurrences ``n``.

    With ``one_in`` a run loses a letter if that number divides the CRC-32 of ``<doc_id>:<run>``, the letter at that
    CRC-32 modulo the run's length.
    """

    # Nothing gets longer, so shorter runs never become words.
    run_of = re.compile(f"[A-Za-zÀ-ÿ]{{{least_chars},}}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in rows(batch, "doc_id", "text"):
                # Bytes are lower-cased in ASCII only.
                runs = Counter(run_of.findall(text.lower().decode(errors="replace")))
                if one_in is None:
                    held.update(runs)
                else:
                    start = zlib.crc32(f"{doc_id}:".encode())
                    for run, n in runs.items():
                        h = zlib.crc32(run.encode(), start)
                        if h % one_in == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least_chars:
                                continue
                        held[run] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    columns = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    counted = columns.mapInArrow(work, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def dimensions(word: str) -> list[tuple[str, int]]:
    """Each letter with the number of its occurrence."""
    seen: Counter[str] = Counter()
    found = []
    for letter in word:
        found.append((letter, seen[letter]))
        seen[letter] += 1
    return found


def balanced_parts(words: DataFrame) -> dict[tuple[str, int], int]:
    """Dimensions dealt to parts, each to the part that has the least so far; at most ``COUNTED`` for each letter of the alphabet."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                held.update(d for d in dimensions(word) if d[1] < COUNTED)
        letter, nth = zip(*held, strict=True) if held else ((), ())
        columns = [pa.array(letter, pa.string()), pa.array(nth, pa.int64()), pa.array(list(held.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["letter", "nth", "n"])

    counted = words.select("word").mapInArrow(work, "letter string, nth long, n long").groupBy("letter", "nth").agg(F.sum("n").alias("n"))
    load, parts = [0] * PARTS, {}
    for letter, nth, n in counted.orderBy(F.desc("n"), "letter", "nth").collect():
        parts[letter, nth] = load.index(min(load))
        load[parts[letter, nth]] += n
    return parts


def codes(words: DataFrame, parts: dict[tuple[str, int], int]) -> DataFrame:
    """Words with the ``codes`` of their parts and the whole vector, ``folded`` to 64 dimensions; equal contents have equal codes."""

    def coded(word: str) -> tuple[list[int], int]:
        code, folded = [0] * PARTS, 0
        for letter, nth in dimensions(word):
            part = parts.get((letter, nth), (ord(letter) + nth) % PARTS)
            # A sum does not depend on the order of the letters.
            mixed = zlib.crc32(f"{letter}{nth}".encode())
            code[part] += mixed
            folded ^= 1 << (mixed & 63)
        return [(c * MIX & MASK) >> 33 for c in code], folded - (folded >> 63 << 64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [coded(w) for w in batch.column("word").to_pylist()]
            code = pa.array([c for c, _ in found], pa.list_(pa.int32()))
            folded = pa.array([f for _, f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), code, folded], ["word", "n", "codes", "folded"])

    return words.select("word", "n").mapInArrow(work, "word string, n long, codes array<int>, folded long")


def signatures(coded: DataFrame) -> DataFrame:
    """A row for each word and choice of two parts: ``choice``, the codes of all other parts (hashed as ``signature``), those of the two."""
    choices = [
        F.struct(
            F.lit(choice).cast("byte").alias("choice"),
            *[F.get("codes", F.lit(p)).alias(name) for name, p in zip(SAME, (p for p in range(PARTS) if p not in out), strict=True)],
            *[F.get("codes", F.lit(p)).alias(name) for name, p in zip(LEFT, out, strict=True)],
        )
        for choice, out in enumerate(LEFT_OUT)
    ]
    signed = coded.select("word", "n", "folded", F.inline(F.array(*choices)))
    return signed.withColumn("signature", F.xxhash64("choice", *SAME))


def near_words(coded: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: every pair of words at edit distance one, once from either side.

    Words of equal signature meet in one task. More than ``block`` of them are dealt by hash into parts of about that size, and each two parts
    meet in a task of their own.
    """
    signed = signatures(coded)
    large = signed.groupBy("signature").agg(F.count("*").alias("rows")).where(F.col("rows") > block)
    large = keep(large.select("signature", F.ceil(F.col("rows") / block).alias("parts")), "large-groups")
    parts = signed.withColumn("parts", F.lit(1).cast("long")) if large.isEmpty() else signed.join(large, "signature", "left")
    parts = parts.withColumn("own", F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))))
    meeting = parts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)))
    meeting = meeting.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    key = ("signature", "low", "high")
    columns = (*key, "word", "n", "folded", "choice", "own", *SAME, *LEFT)
    ordered = meeting.select(*columns).repartition(*key).sortWithinPartitions(*key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, bound in _whole_groups(batches, key):
            words = _Words(rows_.column("word").to_pylist())
            n = rows_.column("n").to_numpy()
            for i, j in _pairs(np.diff(bound)):
                i, j = _verified(rows_, words, i, j)
                if len(i):
                    i, j = np.concatenate((i, j)), np.concatenate((j, i))
                    word, near = (rows_.column("word").take(pa.array(x)).combine_chunks() for x in (i, j))
                    yield pa.RecordBatch.from_arrays([word, pa.array(n[i]), near, pa.array(n[j])], ["word", "n", "near", "near_n"])

    return ordered.mapInArrow(work, "word string, n long, near string, near_n long")


def _whole_groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Many groups of sorted rows at a time, and the bounds of the groups."""
    held: list[pa.RecordBatch] = []

    def cut(last: bool) -> tuple[pa.Table, np.ndarray, list[pa.RecordBatch]]:
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(max(0, len(table) - 1), dtype=bool)
        for k in key:
            new |= np.diff(table.column(k).to_numpy()) != 0
        bound = np.concatenate(([0], np.flatnonzero(new) + 1, [len(table)]))
        if last:
            return table, bound, []
        # The last group may go on.
        return table.slice(0, bound[-2]), bound[:-1], table.slice(bound[-2]).to_batches()

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= GATHERED:
            table, bound, rest = cut(last=False)
            if len(table):
                yield table, bound
            held = rest
    if held:
        yield cut(last=True)[:2]


def _pairs(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within groups that lie one after another, a bounded number at a time."""
    # Each row meets the rows behind it in its group.
    start = np.cumsum(sizes) - sizes
    behind = np.repeat(start + sizes, sizes) - np.arange(sizes.sum()) - 1
    total = np.concatenate(([0], np.cumsum(behind)))
    at = 0
    while at < len(behind):
        end = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, side="right")) - 1)
        count = behind[at:end]
        i = np.repeat(np.arange(at, end), count)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        at = end


def _verified(rows_: pa.Table, words: _Words, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of rows those at edit distance one whose first common choice this is.

    Of the choices that leave out all parts in which a pair differs, the first one has as its second part one that differs, and so is its
    first part unless that is part 0; pairs that differ in part 0 only or in none have choice 0.
    """
    def column(name: str) -> np.ndarray:
        return rows_.column(name).to_numpy()

    def only(good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return i[good], j[good]

    folded = column("folded").view(np.uint64)
    i, j = only(np.bitwise_count(folded[i] ^ folded[j]) <= 2)
    choice, first_out, second_out = column("choice"), column(LEFT[0]), column(LEFT[1])
    with_part_0 = sum(out[0] == 0 for out in LEFT_OUT)
    i, j = only(((choice[i] < with_part_0) | (first_out[i] != first_out[j])) & ((choice[i] == 0) | (second_out[i] != second_out[j])))
    # Hashes of different signatures may be equal, and two parts of a large group meet each other only.
    for name in ("choice", *SAME):
        i, j = only(column(name)[i] == column(name)[j])
    own = column("own")
    i, j = only((column("low")[i] == column("high")[i]) | (own[i] != own[j]))
    return only(words.one_apart(i, j))


class _Words:
    """Words of one byte a letter, aligned at both ends, to compare many pairs at once."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.array([len(w) for w in words])
        short = [w.encode("latin-1") if len(w) <= WIDTH else b"" for w in words]
        width = max(1, max(map(len, short), default=1))
        self.left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in short), dtype=np.uint8).reshape(len(words), width)
        self.right = np.frombuffer(b"".join(w.rjust(width, b"\0") for w in short), dtype=np.uint8).reshape(len(words), width)

    def one_apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the words are at edit distance one."""
        gap = np.abs(self.length[i] - self.length[j])
        long = np.maximum(self.length[i], self.length[j]) > WIDTH
        found = np.zeros(len(i), dtype=bool)
        replaced = np.flatnonzero((gap == 0) & ~long)
        found[replaced] = (self.left[i[replaced]] != self.left[j[replaced]]).sum(axis=1) == 1
        deleted = np.flatnonzero((gap == 1) & ~long)
        a, b = i[deleted], j[deleted]
        before = (self.left[a] != self.left[b]).argmax(axis=1)
        behind = (self.right[a] != self.right[b])[:, ::-1].argmax(axis=1)
        found[deleted] = before + behind >= np.minimum(self.length[a], self.length[b])
        for k in np.flatnonzero(long & (gap <= 1)):
            found[k] = _one_apart(self.words[i[k]], self.words[j[k]])
        return found


def _one_apart(a: str, b: str) -> bool:
    short, long = sorted((a, b), key=len)
    before = len(commonprefix([a, b]))
    return a != b and (short[before + 1 :] if len(a) == len(b) else short[before:]) == long[before + 1 :]


def forms(words: DataFrame, pairs: DataFrame, ratio: int) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` for every word."""
    near = pairs.select("word", "n", F.expr("struct(-near_n as less, near as form) as best"))
    alone = words.select("word", "n", F.lit(None).cast(near.schema["best"].dataType).alias("best"))
    found = alone.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.count("best").alias("n_near"), F.min("best").alias("best"))
    accepted = -F.col("best.less") >= ratio * F.col("n")
    return found.select(
        "word",
        "n",
        "n_near",
        F.when(accepted, F.col("best.form")).alias("form"),
        F.when(accepted, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word``, ``root``: the end of the chain of forms, for words that have a form."""
    spark = formed.sparkSession
    steps, path = written(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = steps.join(further, steps["root"] == further["_word"], "left")
        moved = joined.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved"))
        after, after_path = written(moved, "roots")
        any_moved = bool(after.where("moved").limit(1).count())
        discard(spark, path)
        steps, path = after.select("word", "root"), after_path
        if not any_moved:
            return steps


def group_variants(
    docs: DataFrame, least_chars: int = 6, least: int = 5, ratio: int = 5, one_in: int | None = None
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of the texts.

    Words are lower-cased (A-Z) runs of Latin letters with ``least_chars`` code points or more that occur ``least`` times. A word's form
    is the most frequent word at edit distance one (of equal ones the least), if it is ``ratio`` times as frequent.

    Defined cases: a null, empty or blank text has no words; rows of equal or null id count each, a null id as an empty text; equal texts
    count each; a text or word of any length is taken whole; other columns are ignored; an empty table gives no rows. ``ratio``
    is above one, so that chains end.
    """
    if ratio <= 1:
        raise ValueError("a form has to be more frequent than its word")
    words = keep(word_counts(docs, least_chars, least, one_in), "words")
    coded = keep(codes(words, balanced_parts(words)), "codes")
    formed = keep(forms(words, near_words(coded), ratio), "forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
