import math
import random
from collections import Counter

import pytest
import sentencepiece
import tiktoken

from cellweave.llm import fertility
from cellweave.llm.queries import BANDS, FERTILITY
from helpers_llm import WORD, documents, odd_documents

PROSE = "The river runs past the old mill and the children play by the water until the evening bells call them home. "


def base_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    held = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if held[w] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def test_base_counts_on_odd_rows(spark):
    varied = "\n".join(f"line {i} of {i * i} things said about {i + 7} others" for i in range(30))
    rows = odd_documents() + [(50, PROSE), (51, PROSE * 20), (52, varied), (53, f"{varied}\n{varied}"), (54, "a b c a b c x\n\n \nq\nq")]
    result = fertility.judge(documents(spark, rows), FERTILITY, BANDS).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = [tuple(r[n] for n in names) for r in result]
    assert sorted(got, key=repr) == sorted([(i, *base_by_hand(t)) for i, t in rows], key=repr)
    assert not any(r.kept for r in result if r.base_failed)


def test_measures_are_those_of_the_whole_text():
    measurer = fertility.Measurer(FERTILITY)
    pieces = sentencepiece.SentencePieceProcessor(model_file=FERTILITY.pieces)
    for text in (PROSE, PROSE * 30, "Ωμέγα και 中文 mixed 𐍈𐍈 with ᚠᚢᚦ runes", "x" * 5000):
        text = text.strip()
        chars, share, entropy = measurer.measure(text)
        ids = measurer.ranks.encode_ordinary(" " + text)
        assert isinstance(measurer.ranks, tiktoken.Encoding) and chars == pytest.approx(len(text) / len(ids))
        counts = Counter(ids)
        assert entropy == pytest.approx(-sum(n / len(ids) * math.log2(n / len(ids)) for n in counts.values()))
        as_bytes = [pieces.is_byte(i) for i in pieces.encode(text)]
        assert share == pytest.approx(sum(as_bytes) / len(as_bytes))
    assert measurer.measure(" \n ") == (0.0, 0.0, 0.0)


def test_prose_is_kept_and_noise_is_not(spark):
    words = "stone river market winter letter garden silver window story ocean paper mountain bridge forest candle".split()
    prose = " ".join(random.Random(1).choices([*words, "the", "of", "and"], k=250))
    noise = " ".join(f"{w}$$$ {w[::-1]}%%% &&&{w}###" for w in words for _ in range(1)) + " " + " ".join(f"%%%{i}$$$" for i in range(40))
    runes = " ".join("ᚠᚢᚦᚨ"[i % 4] * (1 + i % 5) + chr(0x16A0 + i % 60) for i in range(80))
    kept = {r.doc_id: (r.base_failed, r.kept) for r in fertility.judge(documents(spark, [(1, prose), (2, noise), (3, runes)]), FERTILITY, BANDS).collect()}
    assert kept == {1: (False, True), 2: (False, False), 3: (False, False)}


def test_filter_agrees_with_verdict_and_keeps_columns(spark):
    rows = odd_documents() + [(60 + i, f"{PROSE} number {i} " + " ".join(random.Random(i).choices(PROSE.split(), k=150))) for i in range(9)]
    table = documents(spark, rows)
    kept = fertility.without_rejected(table, FERTILITY, BANDS)
    assert kept.schema == table.schema
    verdicts = [r.doc_id for r in fertility.judge(table, FERTILITY, BANDS).where("kept").collect()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(verdicts) != []
    no_lang = table.drop("lang")
    assert fertility.without_rejected(no_lang, FERTILITY, BANDS).count() == len(verdicts)
    assert fertility.judge(documents(spark, []), FERTILITY, BANDS).count() == 0


def test_empty_table(spark):
    assert fertility.judge(documents(spark, []), FERTILITY, BANDS).count() == 0
    assert fertility.without_rejected(documents(spark, []), FERTILITY, BANDS).count() == 0
