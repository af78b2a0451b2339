"""Language identification with language-bitmask n-gram filters.

Every letter of a text is the middle of a trigram; signs that are no letters count as one sign. Trigrams of the training
documents are counted for each language, and those that make up at least a given share of a language's trigrams are its own.
One Bloom filter for each language, all of one size and with the same hash functions, lie side by side: bit b of a row belongs to
language b (bit-sliced). A trigram's rows and-ed together give the mask of all languages that contain it. A language's
popcount over the trigrams of a text is a share of them, of which its filter's false positives make some; the corrected share is
the score, and the highest decides.

A share of 1 / 20,000 leaves each language at most 20,000 trigrams whatever the data, so the filter, which is broadcast, takes at
most four mebibytes for every 64 languages. Counts cover all training documents, added up in the tasks before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import discard, rows, text_or_empty, written

# A trigram belongs to a language of whose trigrams it makes at least one in so many.
RAREST = 20_000
# Rows of the filter for each trigram of the largest language, and rows a trigram is written to.
ROWS_EACH = 16
HASHES = 4
# Code points handled at once, and trigram counts a task holds before it adds them up.
PIECE = 1 << 19
HELD = 1 << 20
UNDETERMINED = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Of each code point its letter in lower case, 0 if it is no letter. One for each worker process."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        sign = chr(point)
        if sign.isalpha():
            low = sign.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def pieces(texts: Iterator[str], size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Trigrams of texts, some texts or a part of one at a time: trigrams as numbers, and the text of each."""
    held: list[str] = []
    owner: list[int] = []
    total = 0
    for row, text in enumerate(texts):
        for at in range(0, len(text), size):
            # A part has the signs before and after it at its ends.
            before = text[at - 1] if at else " "
            after = text[at + size] if at + size < len(text) else " "
            held.append(before + text[at : at + size] + after)
            owner.append(row)
            total += len(held[-1])
            if total >= size:
                yield _trigrams(held, owner)
                held, owner, total = [], [], 0
    if held:
        yield _trigrams(held, owner)


def _trigrams(held: list[str], owner: list[int]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sign = letters()[points].astype(np.uint64)
    length = np.array([len(p) for p in held])
    ends = np.cumsum(length)
    middle = sign > 0
    middle[ends - 1] = middle[ends - length] = False
    at = np.flatnonzero(middle)
    gram = sign[at - 1] << np.uint64(42) | sign[at] << np.uint64(21) | sign[at + 1]
    return gram, np.repeat(np.array(owner), length)[at]


def trigram_counts(labelled: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n`` over all rows of ``lang`` and ``text``."""

    def add_up(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lang, gram, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((gram, lang))
        lang, gram, n = lang[order], gram[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], (np.diff(lang) != 0) | (np.diff(gram) != 0))))
        return lang[first], gram[first], np.add.reduceat(n, first)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            lang, gram, n = add_up(parts)
            known = pa.array(list(names), pa.string())
            return pa.RecordBatch.from_arrays([known.take(pa.array(lang)), pa.array(gram.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            lang_of = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for gram, row in pieces(t for (t,) in rows(batch, "text")):
                if not len(gram):
                    continue
                parts.append(add_up([(lang_of[row], gram, np.ones(len(gram), dtype=np.int64))]))
                if sum(len(p[0]) for p in parts) > HELD:
                    parts = [add_up(parts)]
                if len(parts) == 1 and len(parts[0][0]) > HELD // 2:
                    yield out()
                    parts = []
        if parts:
            yield out()

    counted = labelled.select("lang", text_or_empty().alias("text")).mapInArrow(work, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Filters:
    """Bit-sliced Bloom filters: ``table[word, row]`` holds bits of 64 languages; ``error`` is each one's rate of false positives."""

    langs: list[str]
    table: np.ndarray
    error: np.ndarray

    def masks(self, gram: np.ndarray) -> np.ndarray:
        """For each word and trigram the languages that contain it."""
        found = None
        for place in places(gram, self.table.shape[1]):
            found = self.table[:, place] if found is None else found & self.table[:, place]
        return found

    def popcounts(self, gram: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams of each row, and for each language and row those it contains. Rows come in order."""
        bound = np.searchsorted(row, np.arange(n_rows + 1))
        masks = self.masks(gram)
        hits = np.empty((len(self.langs), n_rows), dtype=np.int64)
        for b in range(len(self.langs)):
            bit = (masks[b >> 6] >> np.uint64(b & 63)) & np.uint64(1)
            total = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
            hits[b] = total[bound[1:]] - total[bound[:-1]]
        return np.diff(bound), hits

    def shares(self, total: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Shares of trigrams that languages contain, without the false positives to be expected among the others."""
        share = hits / np.maximum(1, total)
        return (share - self.error[:, None]) / (1 - self.error[:, None])


def places(gram: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Rows of trigrams in a filter of ``size`` rows, a power of two."""
    mixed = (gram ^ (gram >> np.uint64(29))) * MIX
    mixed ^= mixed >> np.uint64(32)
    step = (mixed * MIX >> np.uint64(20)) | np.uint64(1)
    for i in range(HASHES):
        yield ((mixed + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64)


def train(labelled: DataFrame, rarest: int = RAREST) -> Filters:
    """Filters of the languages of ``lang``, those of more trigrams first, from rows of ``lang`` (not null) and ``text``."""
    spark = labelled.sparkSession
    counts, counts_at = written(trigram_counts(labelled), "trigrams")
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    own = counts.join(total, "lang").where(F.col("n") * rarest >= F.col("total")).select("lang", "gram", "total")
    own, own_at = written(own, "own-trigrams")
    known = own.groupBy("lang").agg(F.first("total").alias("total"), F.count("*").alias("n")).orderBy(F.desc("total"), "lang").collect()
    langs = [r.lang for r in known]
    size = 1 << max(10, (ROWS_EACH * max((r.n for r in known), default=1) - 1).bit_length())
    bit = {lang: b for b, lang in enumerate(langs)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = np.array([bit[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            gram = batch.column("gram").to_numpy(zero_copy_only=False).view(np.uint64)
            for place in places(gram, size):
                mask = (np.uint64(1) << (b & 63).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(b >> 6), pa.array(place), pa.array(mask)], ["word", "place", "mask"])

    table = np.zeros((max(1, -(-len(langs) // 64)), size), dtype=np.uint64)
    sliced = own.mapInArrow(work, "word long, place long, mask long").groupBy("word", "place").agg(F.bit_or("mask").alias("mask")).toPandas()
    table[sliced["word"].to_numpy(), sliced["place"].to_numpy()] = sliced["mask"].to_numpy().view(np.uint64)
    filled = np.array([float(((table[b >> 6] >> np.uint64(b & 63)) & np.uint64(1)).mean()) for b in range(len(langs))])
    discard(spark, counts_at)
    discard(spark, own_at)
    return Filters(langs, table, np.minimum(filled**HASHES, 0.99))


def predict(docs: DataFrame, filters: Filters, more: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``more``, ``lang_pred`` and ``score`` for every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(filters)
    columns = docs.select("doc_id", *more, text_or_empty().alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            n = batch.num_rows
            total, hits = np.zeros(n, dtype=np.int64), np.zeros((len(held.langs), n), dtype=np.int64)
            for gram, row in pieces(t for (t,) in rows(batch, "text")):
                more_total, more_hits = held.popcounts(gram, row, n)
                total += more_total
                hits += more_hits
            known = (total > 0) & bool(held.langs)
            score, lang = np.zeros(n), [UNDETERMINED] * n
            if held.langs:
                shares = held.shares(total, hits)
                chosen = shares.argmax(axis=0)
                score = np.where(known, np.clip(shares[chosen, np.arange(n)], 0.0, 1.0), 0.0)
                lang = [held.langs[c] if k else UNDETERMINED for c, k in zip(chosen.tolist(), known.tolist(), strict=True)]
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score)], ["doc_id", *more, "lang_pred", "score"])

    kinds = [f"`{c}` {columns.schema[c].dataType.simpleString()}" for c in ("doc_id", *more)]
    return columns.mapInArrow(work, ", ".join([*kinds, "lang_pred string", "score double"]))


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2, rarest: int = RAREST) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: languages learned from all documents that are not held out.

    Held out are documents whose CRC-32 of the id, written as text, leaves ``held_out`` when divided by ``folds``.

    Defined cases: a null text, one without letters, and any text if nothing could be learned, is ``und`` with score 0; rows of
    null language are not learned from; a null id counts as an empty one; where shares are equal the language with more
    trigrams is taken, then the lesser name; a text of letters no language has gets the first language with score 0; repeated rows
    count and are returned each; a text of any length is read whole; other columns are ignored; an empty table gives no rows.
    """
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))
    marked = docs.select("doc_id", "text", "lang", (fold == held_out).alias("held_out"))
    filters = train(marked.where("not held_out and lang is not null and text is not null"), rarest)
    return predict(marked, filters, ("held_out",))
