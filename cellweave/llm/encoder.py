"""Encoding whole texts with a public tokenizer, word by word.

A text is cut at places where the tokenizer itself always cuts, so the ids of the parts put
together are the ids of the whole text. Parts recur, so their ids are looked up in a bounded
cache; the tokenizers library encodes every part that is not in it.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise
from string import ascii_letters
from struct import pack
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

CACHE_PARTS = 300_000
CACHE_WORDS = 700_000
# Longer parts are encoded but not kept.
CACHE_CHARS = 48
# Bytes that a lot of texts encoded together takes in memory, and new parts in a text given to the library.
TOGETHER_BYTES = 12_000_000
TOGETHER_PARTS = 2000
# Recurring parts that are kept from one lot of texts to the next.
RECENT_PARTS = 700_000
BLANKS = frozenset(" \n")
ASCII_LETTERS = frozenset(ascii_letters)
MARK = "\0"
# The patterns by which the two public tokenizers cut text into words.
BYTE_LEVEL_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LOWER_CASE_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# A place between two words with exactly one blank or line feed, which belongs to the word after it.
_ONE_BLANK = re.compile(r"(?<=\S)(?=[ \n]\S)")


def parts_with_blanks(text: str) -> list[str]:
    """Cut before every single blank or line feed that stands between two visible characters.

    A byte-level pattern takes one leading blank into a word and a lone line feed by itself, and in
    both cases starts anew there. Longer runs of white space are left whole.
    """
    return marked_blanks(text).split(MARK) if single_blanks(text) else _ONE_BLANK.split(text)


def single_blanks(text: str) -> bool:
    """Whether all white space of a text is single blanks and line feeds between visible characters."""
    # White space other than a blank is not printable.
    plain = text.replace("\n", " ")
    return plain.isprintable() and "  " not in plain and plain[:1] != " " and plain[-1:] != " "


def marked_blanks(text: str) -> str:
    """A mark before every blank and line feed."""
    return text.replace(" ", f"{MARK} ").replace("\n", f"{MARK}\n")


def parts_without_blanks(text: str) -> list[str]:
    """Cut at blanks and line feeds, for tokenizers that drop white space."""
    return [part for part in text.replace("\n", " ").split(" ") if part]


def words_of(part: str, pattern: regex.Pattern) -> list[str]:
    """Words of a part by the pattern; letters alone, and letters before one sign, need no search."""
    if part.isalpha():
        return [part]
    if part[:-1].isalpha() and part[-1:] in ".,;:!?":
        return [part[:-1], part[-1]]
    if part[:1] == "\n" and not part[1:2].isspace():
        return ["\n", *words_of(part[1:], pattern)]
    if part[:1] == " ":
        if part[1:].isalpha():
            return [part]
        if part[1:-1].isalpha() and part[-1] in ".,;:!?":
            return [part[:-1], part[-1]]
    return pattern.findall(part)


def normalised(part: str) -> str:
    """NFC and lower case of each letter by itself, whatever stands around it."""
    if part.isascii():
        return part.lower()
    part = unicodedata.normalize("NFC", part)
    return "".join([c.lower() for c in part]) if "Σ" in part else part.lower()


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte value: itself if printable in Latin-1, else one from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class TextEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    A part without special tokens is cut by the tokenizer's own pattern and written in its byte alphabet here, which
    is much quicker than the library's general way; the library's model gives the ids of the words. All else goes to
    the library as it is.
    """

    def __init__(self, path: str, keeps_blanks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = parts_with_blanks if keeps_blanks else parts_without_blanks
        self.words = BYTE_LEVEL_WORDS if keeps_blanks else LOWER_CASE_WORDS
        self.normal = (lambda part: part) if keeps_blanks else normalised
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}
        self.alphabet = dict(enumerate(byte_alphabet()))

    def encode(self, text: str) -> bytes:
        for content in self.special:
            if content in text:
                return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self.cut(text)
        known = self.known
        found = list(map(known.get, parts))
        if None in found:
            if len(known) > CACHE_PARTS:
                known.clear()
            for at in [i for i, ids in enumerate(found) if ids is None]:
                part = parts[at]
                ids = known.get(part)
                if ids is None:
                    ids = self._part(part)
                    if len(part) <= CACHE_CHARS:
                        known[part] = ids
                found[at] = ids
        return b"".join(found)

    def _part(self, part: str) -> bytes:
        if len(self.known_words) > CACHE_WORDS:
            self.known_words.clear()
        known = self.known_words.get
        return b"".join([known(w) or self._word(w) for w in words_of(self.normal(part), self.words)])

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.encode().decode("latin-1")
        ids = self._packed([t.id for t in self.model.tokenize(spelled.translate(self.alphabet))])
        if len(word) <= CACHE_CHARS:
            self.known_words[word] = ids
        return ids

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return pack(f"<{len(ids)}I", *ids)


class BatchEncoder(TextEncoder):
    """Ids of many texts at a time by a byte-level tokenizer, which keeps every byte of a text.

    Arrow cuts the texts and makes their parts distinct, so a part is looked up once for a lot of texts. Those not
    known go to the library together: each begins with a blank or line feed before a visible character and ends
    with one, so the library cuts between them as it does in their texts; and as a token stands for a known number
    of bytes, the sizes of the parts tell which ids are whose. Parts that recur in a lot are kept for the next ones.
    """

    def __init__(self, path: str):
        super().__init__(path, True)
        pieces = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(max(pieces.values()) + 1, dtype=np.int64)
        self.token_bytes[list(pieces.values())] = list(map(len, pieces))
        self.recent: dict[str, bytes] = {}
        self.signs = {sign: self._part(sign) for sign in ".,;:!?"}

    def encode_all(self, rows: Iterable[tuple[int | None, str]]) -> Iterator[tuple[int | None, bytes]]:
        """The key of each row and the ids of its text, in the order given."""
        keys, texts, size = [], [], 0
        for key, text in rows:
            keys.append(key)
            texts.append(text)
            size += getsizeof(text)
            if size >= TOGETHER_BYTES:
                yield from zip(keys, self._together(texts), strict=True)
                keys, texts, size = [], [], 0
        yield from zip(keys, self._together(texts), strict=True)

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        marked = [self._marked(text) for text in texts]
        alone = [mark is None for mark in marked]
        cut = pc.split_pattern(pa.array([mark for mark in marked if mark is not None], pa.string()), MARK)
        del marked
        parts = cut.values.dictionary_encode()
        bounds = cut.offsets.to_numpy()
        del cut
        recurs = np.bincount(parts.indices.to_numpy(), minlength=len(parts.dictionary)) > 1
        known = self._ids(parts.dictionary.to_numpy(zero_copy_only=False).tolist(), recurs)
        found = pa.array(known, pa.binary()).take(parts.indices)
        del known, parts
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy(), dtype=np.int64)])
        bounds = iter(ends[bounds].tolist())
        del ends
        packed = memoryview(found.buffers()[2] or b"")
        end = next(bounds, 0)
        for text, by_itself in zip(texts, alone, strict=True):
            if by_itself:
                yield self.encode(text)
            else:
                start, end = end, next(bounds)
                yield bytes(packed[start:end])

    def _marked(self, text: str) -> str | None:
        """The text with a mark at every cut; none for one that is encoded by itself."""
        if getsizeof(text) >= TOGETHER_BYTES or MARK in text or any(content in text for content in self.special):
            return None
        return marked_blanks(text) if single_blanks(text) else _ONE_BLANK.sub(MARK, text)

    def _ids(self, parts: list[str], recurs: np.ndarray) -> list[bytes]:
        """Ids of distinct parts. A sign after a letter is a word of its own, so only what stands before it need be known."""
        known, signs = self.recent, self.signs
        found = list(map(known.get, parts))
        missing, whole, signed = [], [], []
        for i, (part, ids) in enumerate(zip(parts, found, strict=True)):
            if ids is None:
                missing.append(i)
                if part[-1:] in signs and part[-2:-1] in ASCII_LETTERS:
                    signed.append(i)
                else:
                    whole.append(i)
        new = [parts[i] for i in whole]
        fresh = dict(zip(new, self._encoded(new), strict=True))
        for i, ids in zip(whole, fresh.values(), strict=True):
            found[i] = ids
        new = list(dict.fromkeys(w for w in [parts[i][:-1] for i in signed] if w not in fresh and w not in known))
        fresh.update(zip(new, self._encoded(new), strict=True))
        for i in signed:
            word = parts[i][:-1]
            found[i] = (fresh.get(word) or known[word]) + signs[parts[i][-1]]
        if len(known) > RECENT_PARTS:
            known.clear()
            missing = range(len(parts))
        for i in np.array(missing, dtype=np.int64)[recurs[missing]].tolist():
            if len(parts[i]) <= CACHE_CHARS:
                known[parts[i]] = found[i]
        return found

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, from the library."""
        joined = [part for part in parts if part[:1] in BLANKS and len(part.strip()) == len(part) - 1]
        ids = [np.array([], dtype="<u4")]
        for at in range(0, len(joined), TOGETHER_PARTS):
            text = "".join(joined[at : at + TOGETHER_PARTS])
            given = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids.append(np.array(given[0].ids, dtype="<u4"))
        ids = np.concatenate(ids)
        sizes = np.cumsum([len(part) if part.isascii() else len(part.encode()) for part in joined])
        ends = 4 * np.searchsorted(np.cumsum(self.token_bytes[ids]), sizes, side="right")
        packed, starts = ids.tobytes(), [0, *ends.tolist()]
        found = [packed[start:end] for start, end in pairwise(starts)]
        if len(joined) == len(parts):
            return found
        # The first and last parts of texts may begin or end otherwise; those are encoded each by itself.
        known = dict(zip(joined, found, strict=True))
        alone = [part for part in parts if part not in known]
        given = self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)
        known.update(zip(alone, (self._packed(g.ids) for g in given), strict=True))
        return [known[part] for part in parts]


@lru_cache(maxsize=2)
def text_encoder(path: str, keeps_blanks: bool) -> TextEncoder:
    """One encoder for each worker process and tokenizer."""
    return TextEncoder(path, keeps_blanks)


@lru_cache(maxsize=1)
def batch_encoder(path: str) -> BatchEncoder:
    """One encoder of many texts for each worker process."""
    return BatchEncoder(path)
