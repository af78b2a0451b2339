import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from cellweave.llm.bpe import MergeTree, NEVER, PairEncoder, encode_and_decode
from cellweave.llm.encoder import BatchEncoder, TextEncoder
from helpers_llm import documents, odd_documents

BYTE, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
SIGNS = [*"ab cd  \n\t\r\x0b\x1c\x85\xa0'sStm.,!éΣσςİßàÀ㎡中文👍🏽0123<|>Ǆ½²٣_\0", "́", "‍", "<|endoftext|>", "<|startoftext|>", "'re", " \n"]


def texts():
    choose = random.Random(5)
    made = ["".join(choose.choices(SIGNS, k=choose.randint(0, 40))) for _ in range(4000)]
    return made + [t for _, t in odd_documents() if t is not None]


def ids(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


@pytest.mark.parametrize("path, keeps_blanks", [(BYTE, True), (WORDS, False)])
def test_parts_encode_like_the_whole_text(path, keeps_blanks):
    encoder, library = TextEncoder(path, keeps_blanks), Tokenizer.from_file(path)
    for text in texts():
        assert ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text[:100])


@pytest.mark.parametrize("together, recent, chars", [(12_000_000, 700_000, 48), (3000, 5, 4), (150, 0, 0)])
def test_texts_encode_together_like_each_alone(monkeypatch, together, recent, chars):
    monkeypatch.setattr("cellweave.llm.encoder.TOGETHER_BYTES", together)
    monkeypatch.setattr("cellweave.llm.encoder.RECENT_PARTS", recent)
    monkeypatch.setattr("cellweave.llm.encoder.CACHE_CHARS", chars)
    encoder, library = BatchEncoder(BYTE), Tokenizer.from_file(BYTE)
    rows = [*enumerate(texts()), (None, "first time. second time."), (None, "second first time. <|endoftext|>")]
    for _ in range(2):
        found = list(encoder.encode_all(iter(rows)))
        assert [key for key, _ in found] == [key for key, _ in rows]
        for (_, text), (_, packed) in zip(rows, found, strict=True):
            assert ids(packed) == library.encode(text, add_special_tokens=False).ids, repr(text[:100])
    assert list(encoder.encode_all([])) == []


def test_library_is_given_the_new_parts_of_many_texts_at_once():
    class Counted:
        def __init__(self, library):
            self.library, self.given = library, []

        def encode_batch_fast(self, texts, add_special_tokens):
            self.given += texts
            return self.library.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    encoder = BatchEncoder(BYTE)
    counted = encoder.tokenizer = Counted(encoder.tokenizer)
    rows = [(i, f"The house of number, the house {'abcdefgh'[i % 8]}.\nA garden") for i in range(800)]
    found = dict(encoder.encode_all(rows))
    library = Tokenizer.from_file(BYTE)
    assert all(ids(found[i]) == library.encode(text).ids for i, text in rows)
    words = " ".join(counted.given).split()
    assert sorted(words) == sorted(["The", "house", "of", "the", "A", "garden", "number", *"abcdefgh"])
    assert len(counted.given) == 3
    list(encoder.encode_all(rows))
    assert len(counted.given) == 3


def test_segment_tree_encodes_and_decodes_like_the_library():
    encoder, library = PairEncoder(WORDS), Tokenizer.from_file(WORDS)
    for text in texts():
        expected = library.encode(text, add_special_tokens=False).ids
        packed = encoder.encode(text)
        assert ids(packed) == expected, repr(text[:100])
        assert encoder.decode(packed) == library.decode(expected, skip_special_tokens=False)


def test_tree_names_the_leftmost_lowest():
    tree = MergeTree([5, 3, 9, 3, 7])
    assert (tree.root(), tree.leftmost()) == (3, 1)
    tree.put(1, NEVER)
    assert (tree.root(), tree.leftmost()) == (3, 3)
    tree.put(3, NEVER)
    assert (tree.root(), tree.leftmost()) == (5, 0)


def test_full_caches_change_nothing(monkeypatch):
    monkeypatch.setattr("cellweave.llm.encoder.CACHE_PARTS", 3)
    encoder, library = TextEncoder(BYTE, True), Tokenizer.from_file(BYTE)
    for text in ("one two three four five six", "one two seven eight", "six five four"):
        assert ids(encoder.encode(text)) == library.encode(text).ids


def test_query_on_odd_rows(spark):
    rows = odd_documents()
    library = Tokenizer.from_file(WORDS)
    expected = []
    for doc_id, text in rows:
        found = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(found, skip_special_tokens=False)
        packed = np.array(found, dtype="<u4").tobytes()
        expected.append((doc_id, len(found), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    result = encode_and_decode(documents(spark, rows), WORDS)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(expected, key=repr)
    assert encode_and_decode(documents(spark, []), WORDS).count() == 0


def test_empty_table(spark):
    assert encode_and_decode(documents(spark, []), WORDS).count() == 0
