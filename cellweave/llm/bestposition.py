"""Ranked lexical search with the Best Position Algorithm.

Every document is dealt to a block, and a block has an impact list for each term that is asked for: its documents by falling gain.
An item reads the lists of its terms from the top. Each document met is looked up in all of these lists at once (direct
access), which gives its score and its places there. A list's best position is the last one up to which all its places have been
seen, by reading or by looking up; the gains at the best positions add up to what an unseen document can score at most.
The item ends in a block once that is strictly below its k-th score, so that equal scores are all seen and the least ids win.

The items are the stated queries: they go to the tasks in blocks of bounded size, and for each block the documents are read once.
Documents become short rows of (term, occurrences) in the tasks that read them; no text and no posting is shuffled, only the
best of each task. Places of the lists, scores and thresholds are 64-bit integers.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cellweave.llm.common import keep, rows, text_or_empty

# Terms of the items one task holds at a time, repeats of other items included; an item with more is a block of its own.
ITEM_TERMS = 200_000
# Postings of a block of documents; a longer document is a block of its own.
BLOCK_POSTINGS = 500_000
# Places each list is first read; doubles each time.
FIRST_READ = 32

# Letters and digits stay, A-Z in lower case; all other signs of one byte separate. Signs of more bytes stay.
FOLD = bytes(
    b if b >= 128 or chr(b) in string.digits + string.ascii_lowercase else b + 32 if chr(b) in string.ascii_uppercase else 32
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of digits, letters and signs beyond ASCII in a UTF-8 text, A-Z in lower case."""
    return text.translate(FOLD).split()


@dataclass
class Items:
    """A block of items: their ids, the terms of all and each item's terms with their repeats."""

    ids: list[Any] = field(default_factory=list)
    number: dict[bytes, int] = field(default_factory=dict)
    wanted: list[dict[int, int]] = field(default_factory=list)
    size: int = 0

    def add(self, item_id: Any, held: dict[bytes, int]) -> None:
        self.ids.append(item_id)
        self.wanted.append({self.number.setdefault(t, len(self.number)): n for t, n in held.items()})
        self.size += len(held)


def item_blocks(items: DataFrame, kind: str, most: int = ITEM_TERMS) -> Iterator[Items]:
    """The items' terms in blocks; rows of one ``item_id`` are one item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(row, t, n) for row, text in enumerate(batch.column("text").to_pylist()) for t, n in Counter(terms(text)).items()]
            row, term, n = (list(c) for c in zip(*found, strict=True)) if found else ([], [], [])
            ids = batch.column("item_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(term, pa.binary()), pa.array(n, pa.int64())], ["item_id", "term", "n"])

    each = items.select("item_id", text_or_empty().cast("binary").alias("text")).mapInArrow(work, f"item_id {kind}, term binary, n long")
    summed = each.groupBy("item_id", "term").agg(F.sum("n").alias("n"))
    block, last, held = Items(), None, {}
    for item_id, term, n in keep(summed, "item-terms").orderBy("item_id", "term").toLocalIterator():
        if held and item_id != last:
            block.add(last, held)
            held = {}
            if block.size >= most:
                yield block
                block = Items()
        last = item_id
        held[bytes(term)] = n
    if held:
        block.add(last, held)
    if block.ids:
        yield block


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats) and the wanted terms with their occurrences, for documents with a term."""
    number = items.number
    kind = dict(docs.dtypes)["doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, ends, found, times = [], [], [0], [], []
            for doc_id, text in rows(batch, "doc_id", "text"):
                words = terms(text)
                if not words:
                    continue
                held = Counter(map(number.get, words))
                held.pop(None, None)
                ids.append(doc_id)
                sizes.append(len(words))
                found.extend(held)
                times.extend(held.values())
                ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c, pa.int64())) for c in (found, times)]
            columns = [pa.array(ids, batch.column("doc_id").type), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"])

    read = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    return read.mapInArrow(work, f"doc_id {kind}, n long, terms array<long>, times array<long>")


class Lists:
    """The impact lists of a block of documents, and its postings by document for direct access."""

    def __init__(self, start: np.ndarray, term: np.ndarray, gain: np.ndarray, n_terms: int):
        self.start, self.term, self.gain = start, term, gain
        doc = np.repeat(np.arange(len(start) - 1, dtype=np.int32), np.diff(start))
        order = np.lexsort((doc, -gain, term))
        self.list_doc, self.list_gain = doc[order], gain[order]
        self.place = np.empty(len(order), dtype=np.int32)
        self.place[order] = np.arange(len(order), dtype=np.int32)
        self.bound = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))
        self.seen_place = np.zeros(len(order), dtype=bool)
        self.seen_doc = np.zeros(len(start) - 1, dtype=bool)
        self.repeats = np.zeros(n_terms, dtype=np.int64)

    def look_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of documents, and their places in the lists of the item."""
        size = self.start[found + 1] - self.start[found]
        first = np.cumsum(size) - size
        at = np.repeat(self.start[found] - first, size) + np.arange(size.sum())
        repeats = self.repeats[self.term[at]]
        return np.add.reduceat(repeats * self.gain[at], first), self.place[at[repeats > 0]]

    def search(self, wanted: dict[int, int], k: int, best: Best, first: int) -> int:
        """Add to ``best`` what the block holds for an item; the number of documents looked up."""
        lists = [t for t in wanted if self.bound[t] < self.bound[t + 1]]
        if not lists:
            return 0
        repeats = np.array([wanted[t] for t in lists])
        low, high = self.bound[lists], self.bound[np.array(lists) + 1]
        self.repeats[lists] = repeats
        position = low.copy()
        places, met, read = [], [], FIRST_READ
        while True:
            fresh = np.concatenate([self.list_doc[a : min(a + read, b)] for a, b in zip(position.tolist(), high.tolist(), strict=True)])
            fresh = np.unique(fresh[~self.seen_doc[fresh]])
            if len(fresh):
                scores, at = self.look_up(fresh)
                self.seen_doc[fresh] = self.seen_place[at] = True
                met.append(fresh)
                places.append(at)
                best.add(scores, fresh + first, k)
            for j, (a, b) in enumerate(zip(position.tolist(), high.tolist(), strict=True)):
                if a < b:
                    gap = int(self.seen_place[a:b].argmin())
                    position[j] = b if self.seen_place[a + gap] else a + gap
            open_ = position < high
            most = int((repeats[open_] * self.list_gain[position[open_] - 1]).sum())
            if not open_.any() or most < best.least(k):
                break
            read *= 2
        self.repeats[lists] = 0
        for at in places:
            self.seen_place[at] = False
        for fresh in met:
            self.seen_doc[fresh] = False
        return sum(map(len, met))


class Best:
    """The k best documents of an item so far: scores and numbers, by ``order`` of the documents where scores are equal."""

    def __init__(self, order: OrderOfIds):
        self.scores, self.docs, self.order = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), order

    def add(self, scores: np.ndarray, docs: np.ndarray, k: int) -> None:
        good = (scores > 0) & (scores >= self.least(k))
        scores, docs = np.concatenate((self.scores, scores[good])), np.concatenate((self.docs, docs[good]))
        if len(scores) > k:
            # Only the k-th score and what is above can stay.
            enough = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, docs = scores[enough], docs[enough]
        ranked = np.lexsort((self.order.of(docs), -scores))[:k]
        self.scores, self.docs = scores[ranked], docs[ranked]

    def least(self, k: int) -> int:
        """The k-th score, 0 while there are fewer."""
        return int(self.scores[-1]) if len(self.scores) == k else 0


class OrderOfIds:
    """Ids of the documents of a task, which may be null; these come last."""

    def __init__(self) -> None:
        self.ids: list[Any] = []

    def of(self, docs: np.ndarray) -> np.ndarray:
        """Ranks of documents by id."""
        held = [self.ids[d] for d in docs.tolist()]
        return np.argsort(sorted(range(len(held)), key=lambda i: (held[i] is None, held[i] if held[i] is not None else 0)), kind="stable")


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of a task in blocks: ids, sizes, bounds of their postings, terms, occurrences."""
    held: list[tuple] = []
    size = 0

    def cut() -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids = [i for part in held for i in part[0]]
        n, length, term, times = (np.concatenate([part[j] for part in held]) for j in range(1, 5))
        return ids, n, np.concatenate(([0], np.cumsum(length))), term, times

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            lists = [part.column(c) for c in ("terms", "times")]
            length = np.diff(lists[0].offsets.to_numpy())
            term, times = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
            if held and size + len(term) > most:
                yield cut()
                held, size = [], 0
            held.append((part.column("doc_id").to_pylist(), part.column("n").to_numpy(), length, term, times))
            size += len(term)
    if held:
        yield cut()


def _found(kept: DataFrame, items: Items, kind: str, weight: np.ndarray, n_docs: int, n_all: int, k: int, most: int) -> DataFrame:
    """The k best of each task for each item: ``item_id``, ``doc_id``, ``score``, and the documents looked up in the task."""
    doc_kind = kept.schema["doc_id"].dataType
    item_type, doc_type = pa.string() if kind == "string" else pa.int64(), to_arrow_type(doc_kind)
    ids, wanted, n_terms = items.ids, items.wanted, len(items.number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = OrderOfIds()
        best = [Best(order) for _ in ids]
        looked = [0] * len(ids)
        for doc_ids, size, start, term, times in _blocks(batches, most):
            length = 25 + 75 * size * n_docs // n_all
            gain = weight[term] * (1_000_000_000 * times // (1000 * times + 8 * np.repeat(length, np.diff(start))))
            lists, first = Lists(start, term, gain, n_terms), len(order.ids)
            order.ids.extend(doc_ids)
            for i, held in enumerate(wanted):
                looked[i] += lists.search(held, k, best[i], first)
            # Only ids that are still among the best are needed from here on.
            used = sorted({d for b in best for d in b.docs.tolist()})
            place = np.zeros(len(order.ids), dtype=np.int64)
            place[used] = np.arange(len(used))
            for b in best:
                b.docs = place[b.docs]
            order.ids = [order.ids[d] for d in used]
        rows_ = [(i, d, s) for i, b in enumerate(best) for d, s in zip(b.docs.tolist(), b.scores.tolist(), strict=True)]
        columns = [
            pa.array([ids[i] for i, _, _ in rows_], item_type),
            pa.array([order.ids[d] for _, d, _ in rows_], doc_type),
            pa.array([s for _, _, s in rows_], pa.int64()),
            pa.array([looked[i] for i, _, _ in rows_], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score", "looked_up"])

    return kept.mapInArrow(work, f"item_id {kind}, doc_id {doc_kind.simpleString()}, score long, looked_up long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, item_terms: int = ITEM_TERMS, block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` of the ``k`` documents that score highest for each item.

    Defined cases: a null text has no terms; an item without terms, or none of whose terms any document holds, gives no rows;
    items of one id are one item, those without id as well; rows of one or no document id are documents each, and of equal
    scores those without id come last; equal documents are ranked each; a text of any length is counted whole; other columns
    are ignored; an empty table on either side gives no rows.
    """
    # Ids of items travel as texts if they are texts, else as longs.
    kind = "string" if dict(items.dtypes)["item_id"] == "string" else "long"
    best = None
    for block in item_blocks(items.select(F.col("item_id").cast(kind).alias("item_id"), "text"), kind, item_terms):
        kept = keep(postings(docs, block), "postings")
        n_docs, n_all = kept.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = np.zeros(len(block.number), dtype=np.int64)
        counted = kept.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toPandas()
        held[counted["term"].to_numpy()] = counted["df"].to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], dtype=np.int64)
        found = _found(kept, block, kind, weight, n_docs, max(1, n_all), k, block_postings)
        best = found if best is None else best.unionByName(found)
    if best is None:
        kinds = f"item_id {kind}, doc_id {dict(docs.dtypes)['doc_id']}, score long, looked_up long"
        best = docs.sparkSession.createDataFrame([], kinds)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
