"""Quality rules from tokeniser fertility.

Public vocabularies measure a text: characters per token and token entropy with one vocabulary, and with a
second one that falls back to bytes for what it has no piece for, the share of such tokens. Prose of a language
lies within a band of each measure; lists of codes, keyboard noise, markup and garbled encodings fall outside.

Each text is judged by itself in one pass over the table, so nothing is shuffled or broadcast.

Defined cases: a null text has no words and fails the base rule; an unknown or null language has the band of its
script, found from the letters of the text; equal rows give equal results; a text of any length is
measured whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import math
import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
MIN_WORDS = 50
MAX_REPEATED = 50
CACHE_PARTS = 300_000
CACHE_CHARS = 48
# What no vocabulary here has a piece for begins with this sign and a byte in hexadecimal.
BYTE_PIECE = re.compile(r"<0x[0-9A-F]{2}>\Z")


@dataclass(frozen=True)
class Band:
    """Bounds within which a text is kept; entropy in bits, over texts of 50 words and more."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


@dataclass(frozen=True)
class Vocabularies:
    """Where the two vocabularies are, and the pattern of the first."""

    ranks: str
    pattern: str
    pieces: str


class Measurer:
    """Tokens of whole texts by both vocabularies, part by part between blanks, through a bounded cache."""

    def __init__(self, files: Vocabularies):
        import sentencepiece
        import tiktoken

        with open(files.ranks, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.ranks = tiktoken.Encoding(
            os.path.basename(files.ranks), pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        size = self.pieces.vocab_size()
        # A line feed is written as a byte in every text, so it says nothing.
        line_feed = self.pieces.piece_to_id("<0x0A>")
        self.is_byte = [bool(BYTE_PIECE.match(self.pieces.id_to_piece(i))) and i != line_feed for i in range(size)]
        self.known: dict[str, tuple[bytes, int, int]] = {}

    def _part(self, part: str) -> tuple[bytes, int, int]:
        found = self.known.get(part)
        if found is None:
            ids = np.array(self.ranks.encode_ordinary(" " + part), dtype=np.uint32).tobytes()
            pieces = self.pieces.encode(part)
            found = (ids, len(pieces), sum(map(self.is_byte.__getitem__, pieces)))
            if len(part) <= CACHE_CHARS:
                if len(self.known) > CACHE_PARTS:
                    self.known.clear()
                self.known[part] = found
        return found

    def measure(self, text: str) -> tuple[float, float, float]:
        """Characters per token, share of byte tokens, entropy of the tokens in bits."""
        parts = [self._part(p) for p in text.replace("\n", " ").split(" ") if p]
        if not parts:
            return 0.0, 0.0, 0.0
        ids = np.frombuffer(b"".join([p[0] for p in parts]), dtype=np.uint32)
        counts = np.unique(ids, return_counts=True)[1]
        share = counts / len(ids)
        pieces = sum(p[1] for p in parts)
        return len(text) / len(ids), sum(p[2] for p in parts) / pieces, float(-(share * np.log2(share)).sum())


@lru_cache(maxsize=1)
def measurer(files: Vocabularies) -> Measurer:
    """One for each worker process."""
    return Measurer(files)


def script_of(text: str) -> str:
    """Latin if most letters of the text are, else other."""
    letters = [c for c in text if c.isalpha()]
    return "latin" if 2 * sum(ord(c) < 0x250 for c in letters) >= len(letters) else "other"


def base_counts(text: str) -> dict[str, int]:
    """Words, characters in words, symbols, repeated lines, words in repeated windows of three."""
    words = WORD.findall(text)
    lines = Counter(line for line in text.split("\n") if WORD.search(line))
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(SYMBOLS.findall(text)),
        "n_dup_lines": sum(lines.values()) - len(lines),
        "n_repeat_words": repeated_words(words),
    }


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered = bytearray(len(words))
    for at, window in enumerate(windows):
        if found[window] > 1:
            covered[at : at + 3] = b"\1\1\1"
    return sum(covered)


def judge(docs: DataFrame, files: Vocabularies, bands: dict[str, Band]) -> DataFrame:
    """Per document: the base counts, the three measures, ``base_failed`` and ``kept``.

    ``bands`` are by language; ``latin`` and ``other`` hold for languages without one.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = (
        "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean, "
        "chars_per_token double, byte_share double, token_entropy double"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = measurer(files)
        for batch in batches:
            found = [_judged(tokens, bands, *row) for row in rows(batch, "doc_id", "text", "lang")]
            columns = list(zip(*found, strict=True)) if found else [()] * 11
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 3
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    return docs.select("doc_id", "text", lang).mapInArrow(work, schema)


def _judged(tokens: Measurer, bands: dict[str, Band], doc_id: int | None, text: str | None, lang: str | None) -> tuple:
    text = text or ""
    counts = base_counts(text)
    failed = counts["n_words"] < MIN_WORDS or 100 * counts["n_repeat_words"] > MAX_REPEATED * counts["n_words"]
    chars, share, entropy = tokens.measure(text)
    band = bands.get(lang or "") or bands[script_of(text)]
    fits = (
        band.least_chars <= chars <= band.most_chars
        and share <= band.most_bytes
        and entropy >= min(band.least_entropy, math.log2(max(2, counts["n_words"])) - 1)
    )
    return doc_id, *counts.values(), failed, not failed and fits, chars, share, entropy


def without_rejected(docs: DataFrame, files: Vocabularies, bands: dict[str, Band]) -> DataFrame:
    """Documents that are kept, with all their columns, judged in one pass.

    The text goes through as it is; the verdict is worked out beside it, so no join is needed.
    """

    has_lang = "lang" in docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = measurer(files)
        for batch in batches:
            judged = rows(batch, "text", "lang") if has_lang else ((t, None) for (t,) in rows(batch, "text"))
            kept = [_judged(tokens, bands, None, text, lang)[7] for text, lang in judged]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
