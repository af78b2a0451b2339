"""Byte pair encoding and decoding with a segment tree over the ranks of neighbouring pairs.

For every word a tree keeps, at its leaves, the merge rank of each symbol with its right neighbour.
Its root names the leftmost lowest rank. A merge changes at most three leaves, so each costs
logarithmic work, and a word of any length is done when the root is infinite. Ids of recurring words
are kept in a bounded cache.

The vocabulary file gives normalisation (NFC, white space to a blank, lower case letter by
letter), the cutting into words, the byte alphabet, the merges, the word-end mark and special tokens,
which are found in the text before anything else.

Defined cases: a null or empty text has no ids and decodes to an empty text; equal documents give
equal rows; a text of any length is encoded whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cellweave.llm.common import rows, text_or_empty
from cellweave.llm.encoder import byte_alphabet, normalised, parts_without_blanks, words_of

NEVER = 1 << 60
CACHE_PARTS = 300_000
CACHE_WORDS = 700_000
CACHE_CHARS = 48


class MergeTree:
    """Segment tree of pair ranks; ``root`` is the lowest and of equal ones the leftmost."""

    def __init__(self, ranks: list[int]):
        self.size = 1 << max(0, (len(ranks) - 1).bit_length())
        self.lowest = [NEVER] * self.size + ranks + [NEVER] * (self.size - len(ranks))
        for node in range(self.size - 1, 0, -1):
            self.lowest[node] = min(self.lowest[2 * node], self.lowest[2 * node + 1])

    def root(self) -> int:
        return self.lowest[1]

    def leftmost(self) -> int:
        node, lowest = 1, self.lowest
        while node < self.size:
            node *= 2
            if lowest[node] > lowest[node + 1]:
                node += 1
        return node - self.size

    def put(self, leaf: int, rank: int) -> None:
        node, lowest = leaf + self.size, self.lowest
        lowest[node] = rank
        while node > 1:
            node //= 2
            low = min(lowest[2 * node], lowest[2 * node + 1])
            if lowest[node] == low:
                return
            lowest[node] = low


class Vocabulary:
    """A public vocabulary: its pieces, the rank and result of every merge, its special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        model = parsed["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.word_end: str = model["end_of_word_suffix"] or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.special = special
        self.pieces = {i: p for p, i in self.ids.items()} | {i: p for p, i in special.items()}
        self.find_special = regex.compile("|".join(regex.escape(s) for s in special)) if special else None
        cutters = parsed["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(cutters[0]["pattern"]["Regex"])
        alphabet = byte_alphabet()
        self.inner = [self.ids[c] for c in alphabet]
        self.last = [self.ids[c + self.word_end] for c in alphabet]


class PairEncoder:
    """Encodes and decodes whole texts."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        finder = self.vocabulary.find_special
        if finder is None or "<|" not in text:
            return self._plain(text)
        ids, at = [], 0
        for match in finder.finditer(text):
            ids.append(self._plain(text[at : match.start()]))
            ids.append(np.array([self.vocabulary.special[match[0]]], dtype="<u4").tobytes())
            at = match.end()
        ids.append(self._plain(text[at:]))
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """Pieces joined by blanks, as a vocabulary without a decoder is read."""
        pieces = self.vocabulary.pieces
        return " ".join(map(pieces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def _plain(self, text: str) -> bytes:
        known, found = self.known, []
        parts = parts_without_blanks(text)
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            pass
        for part in parts:
            ids = known.get(part)
            if ids is None:
                ids = self._part(part)
                if len(part) <= CACHE_CHARS:
                    if len(known) > CACHE_PARTS:
                        known.clear()
                    known[part] = ids
            found.append(ids)
        return b"".join(found)

    def _part(self, part: str) -> bytes:
        found, known = [], self.known_words
        for word in words_of(normalised(part), self.vocabulary.words):
            ids = known.get(word)
            if ids is None:
                ids = np.array(self.word(word), dtype="<u4").tobytes()
                if len(word) <= CACHE_CHARS:
                    if len(known) > CACHE_WORDS:
                        known.clear()
                    known[word] = ids
            found.append(ids)
        return b"".join(found)

    def word(self, word: str) -> list[int]:
        """Merge the bytes of one word until no neighbours can be merged."""
        vocabulary = self.vocabulary
        data = word.encode()
        symbols = [vocabulary.inner[b] for b in data[:-1]] + [vocabulary.last[data[-1]]]
        n, merges = len(symbols), vocabulary.merges
        if n == 1:
            return symbols
        none = (NEVER, -1)
        tree = MergeTree([merges.get(pair, none)[0] for pair in zip(symbols, symbols[1:], strict=False)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree.root() < NEVER:
            at = tree.leftmost()
            gone = after[at]
            symbols[at] = merges[symbols[at], symbols[gone]][1]
            symbols[gone] = -1
            after[at] = then = after[gone]
            if gone < n - 1:
                tree.put(gone, NEVER)
            if then < n:
                before[then] = at
                tree.put(at, merges.get((symbols[at], symbols[then]), none)[0])
            else:
                tree.put(at, NEVER)
            if before[at] >= 0:
                tree.put(before[at], merges.get((symbols[before[at]], symbols[at]), none)[0])
        return [s for s in symbols if s >= 0]


@lru_cache(maxsize=1)
def pair_encoder(path: str) -> PairEncoder:
    """One encoder for each worker process."""
    return PairEncoder(path)


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the text decoded from them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_encoder(path)
        for batch in batches:
            found = {"doc_id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for doc_id, text in rows(batch, "doc_id", "text"):
                ids = encoder.encode(text)
                found["doc_id"].append(doc_id)
                found["n_tokens"].append(len(ids) // 4)
                found["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                found["decoded_sha256"].append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
            whole = {"doc_id": pa.int64(), "n_tokens": pa.int64()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, whole.get(k, pa.string())) for k, v in found.items()})

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(work, schema)
