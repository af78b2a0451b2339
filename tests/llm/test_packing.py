import random
import zlib
from itertools import groupby

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from cellweave.llm import packing
from cellweave.llm.common import keep
from helpers_llm import documents, odd_documents

WORDS = P.path("word_bpe_49k.json")


def checked(result, rows, capacity=4096):
    """Every id in exactly one piece, pieces where they say they are, no sequence above the capacity."""
    library = Tokenizer.from_file(WORDS)
    wanted = []
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for start in range(0, len(ids), capacity):
            part = ids[start : start + capacity]
            wanted.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
    got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in result]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    sequences = []
    for _, pieces in groupby(sorted(result, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        filled = 0
        for piece in pieces:
            assert piece.offset == filled
            filled += piece.length
        assert filled <= capacity
        sequences.append(filled)
    return sequences


def test_odd_rows(spark):
    rows = odd_documents()
    result = packing.pack_documents(documents(spark, rows), WORDS, 2).collect()
    assert result[0].asDict().keys() == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    checked(result, rows)
    checked(packing.pack_documents(documents(spark, rows), WORDS, 2, capacity=64).collect(), rows, 64)


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), WORDS, 2).count() == 0


def test_groups_share_the_work_and_pad_little(spark):
    choose = random.Random(3)
    rows = [(i, " ".join(choose.choices(["red", "green", "blue", "dark"], k=choose.randint(1, 150)))) for i in range(1500)]
    pieces = keep(packing.pieces_of(documents(spark, rows), WORDS, 2, 512), "pieces")
    result = packing.pack_pieces(pieces, 512, group_windows=32).collect()
    sequences = checked(result, rows, 512)
    assert len({r.sequence_id >> 24 for r in result}) > 3
    assert sum(sequences) / (512 * len(sequences)) > 0.95


@pytest.mark.parametrize("n, windows", [(1, 1), (3, 5), (40, 7), (500, 64)])
def test_differencing_uses_the_windows_evenly(n, windows):
    sizes = np.sort(np.random.default_rng(n).integers(1, 100, n))[::-1]
    window = packing.differencing(sizes, windows)
    assert len(window) == n and 0 <= window.min() and window.max() < windows
    if n >= 4 * windows:
        sums = np.bincount(window, weights=sizes, minlength=windows)
        assert sums.max() - sums.min() <= sizes.max() / 2


def test_windows_rise_when_one_is_too_full():
    sizes = np.array([60, 60, 60])
    window, count = packing.windows_of(sizes, 100)
    assert count == 3 and sorted(window) == [0, 1, 2]
