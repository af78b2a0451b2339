"""Packing documents into sequences of a fixed number of tokens.

Every document is cut at multiples of the capacity. Full pieces are sequences by themselves; the
remainders of a group are spread over as few windows as their sum allows, by multiway
differencing: of all partial partitions the two of the largest spread are merged, the fullest
window of one with the emptiest of the other, until one is left. If its fullest window exceeds the
capacity, the number of windows rises by one and the group is spread anew.

Groups are dealt by a hash of a number each piece has, so no document, source or text makes a
group large, and their number follows from the number of tokens.

Defined cases: a null text is empty, so its document is the end id alone; documents of equal or
null id are packed each for itself; a text of any length is packed whole, in pieces;
other columns are ignored; an empty table packs to nothing.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import keep, rows, text_or_empty
from cellweave.llm.encoder import text_encoder

CAPACITY = 4096
# Windows a group has on average; its padding is about one window.
GROUP_WINDOWS = 192
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, number long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each size, sums being as equal as multiway differencing makes them."""
    if windows == 1:
        return np.zeros(len(sizes), dtype=np.int64)
    # Node i < n is an item, others join the items of two nodes; -1 is an empty window.
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    made = len(sizes)
    heap = []
    for item, size in enumerate(sizes.tolist()):
        heap.append((-size, item, np.array([size]), np.array([item])))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, sums_a, nodes_a = heapq.heappop(heap)
        _, _, sums_b, nodes_b = heapq.heappop(heap)
        if len(sums_a) + len(sums_b) <= windows:
            sums = np.concatenate((sums_a, sums_b))
            nodes = np.concatenate((nodes_a, nodes_b))
        else:
            # The fullest of one meets the emptiest of the other; what has no partner stays.
            sums, more = _wide(sums_a, windows), _wide(sums_b, windows)[::-1]
            nodes, other = _wide(nodes_a, windows, -1), _wide(nodes_b, windows, -1)[::-1]
            sums = sums + more
            both = (nodes >= 0) & (other >= 0)
            n = int(both.sum())
            joined = np.where(nodes >= 0, nodes, other)
            if n:
                left.append(nodes[both])
                right.append(other[both])
                joined[both] = np.arange(made, made + n)
                made += n
            nodes = joined
        by_sum = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by_sum], nodes[by_sum]
        lowest = int(sums[-1]) if len(sums) == windows else 0
        heapq.heappush(heap, (lowest - int(sums[0]), order, sums, nodes))
        order += 1
    window = np.full(made, -1, dtype=np.int64)
    nodes = heap[0][3]
    window[nodes[nodes >= 0]] = np.arange(windows)[: len(nodes)][nodes >= 0]
    if left:
        below = np.concatenate(left), np.concatenate(right)
        for node in range(made - 1, len(sizes) - 1, -1):
            window[below[0][node - len(sizes)]] = window[below[1][node - len(sizes)]] = window[node]
    return window[: len(sizes)]


def _wide(values: np.ndarray, width: int, fill: int = 0) -> np.ndarray:
    return np.concatenate((values, np.full(width - len(values), fill, dtype=values.dtype)))


def windows_of(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Windows that hold the sizes, none above the capacity, and how many there are."""
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, count)
        if np.bincount(window, weights=sizes, minlength=count).max(initial=0) <= capacity:
            return window, count
        count += 1


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Encode documents and cut them at multiples of the capacity: a row for each piece, without its ids."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer, False)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            found = []
            for doc_id, text in rows(batch, "doc_id", "text"):
                ids = memoryview(encoder.encode(text) + end)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    check = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    found.append((doc_id, start, length, check, total, number))
                    number += 1
            columns = zip(*found, strict=True) if found else [[]] * 6
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(cut, PIECES)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Put stored pieces into sequences: every piece with its sequence and its place there."""
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(tokens / (capacity * group_windows)))
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "number"], ascending=[False, True], ignore_index=True)
        full = int((part["length"] == capacity).sum())
        sizes = part["length"].to_numpy()
        window, _ = windows_of(sizes[full:], capacity)
        window = np.concatenate((np.arange(full), window + full))
        order = np.argsort(window, kind="stable")
        placed, window = part.iloc[order].copy(), window[order]
        ends = placed["length"].cumsum().to_numpy()
        first = np.flatnonzero(np.diff(window, prepend=-1))
        begins = ends - placed["length"].to_numpy()
        placed["offset"] = begins - np.repeat(begins[first], np.diff(first, append=len(window)))
        placed["sequence_id"] = (int(part["group"].iloc[0]) << 24) + window
        return placed[[c.split()[0] for c in PACKED.split(", ")]]

    return grouped.groupBy("group").applyInPandas(pack, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Encode, cut and pack; the pieces are stored between, so their numbers stay the same."""
    return pack_pieces(keep(pieces_of(docs, tokenizer, end_id, capacity), "pieces"), capacity)
