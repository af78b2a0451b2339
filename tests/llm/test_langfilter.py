import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from cellweave.llm import langfilter
from cellweave.llm.langfilter import Filters
from helpers_llm import odd_documents

SF = Path("/root/testdata/sf0.01")
TEXTS = {
    "en": "the river ran through the winter market with silver and thought of the other things",
    "de": "der Fluß lief durch den Wintermarkt und dachte mit Silber über die anderen Dinge nach",
    "es": "el río corría por el mercado de invierno con plata y pensaba en las otras cosas",
}


def letter(sign):
    return (sign.lower() if len(sign.lower()) == 1 else sign) if sign.isalpha() else " "


def trigrams(text):
    signs = [" ", *map(letter, text or ""), " "]
    return [tuple(signs[i - 1 : i + 2]) for i in range(1, len(signs) - 1) if signs[i] != " "]


def out(doc_id, folds=4, fold=2):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def by_hand(rows, rarest=langfilter.RAREST):
    """Shares of the trigrams that languages have, with plain sets."""
    counts = {}
    for doc_id, text, lang in rows:
        if not out(doc_id) and lang is not None and trigrams(text):
            counts.setdefault(lang, Counter()).update(trigrams(text))
    own = {lang: {g for g, n in c.items() if n * rarest >= c.total()} for lang, c in counts.items()}
    order = sorted(own, key=lambda lang: (-counts[lang].total(), lang))
    result = []
    for doc_id, text, _ in rows:
        grams = trigrams(text)
        shares = [sum(g in own[lang] for g in grams) / len(grams) for lang in order] if grams else []
        result.append((doc_id, out(doc_id), text, dict(zip(order, shares, strict=False)) or {"und": 0.0}))
    return result


def table(spark, rows):
    more = [(i, t, lang, "s", 0, 1, 2, 3) for i, t, lang in rows]
    return spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars int, gram int, n int, score int").repartition(3)


def compared(spark, rows, **more):
    found = langfilter.identify(table(spark, rows), **more)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    by_id = lambda r: (r[0] is not None, r[0] or 0)
    found, expected = sorted(map(tuple, found.collect()), key=by_id), sorted(by_hand(rows, more.get("rarest", langfilter.RAREST)), key=by_id)
    for (doc_id, held_out, lang, score), (own_id, own_out, _, shares) in zip(found, expected, strict=True):
        assert (doc_id, held_out) == (own_id, own_out)
        # Few trigrams no language has are false positives, and the correction takes their expected number off.
        assert abs(score - shares[lang]) < 0.05 and shares[lang] > max(shares.values()) - 0.02
    return found


def labelled():
    rows = []
    for i in range(60):
        lang = ("en", "de", "es")[i % 3]
        words = TEXTS[lang].split()
        rows.append((i, " ".join(words[i % 5 :] + words[: i % 7]), lang if i % 11 else None))
    return rows


def test_against_plain_sets(spark):
    found = compared(spark, labelled())
    true = {i: ("en", "de", "es")[i % 3] for i in range(60)}
    assert sum(r[1] for r in found) > 5
    assert all(r[2] == true[r[0]] for r in found if r[1])


def test_rare_trigrams_are_left_out(spark):
    compared(spark, labelled(), rarest=300)


def test_odd_rows(spark):
    rows = [(1000 + n, t, ("en", None, "de", "")[n % 4]) for n, (_, t) in enumerate(odd_documents())] + [(None, "the other river", "en")]
    found = compared(spark, rows + labelled() + [(500, "1234 !!", "es"), (501, "Ж", "es"), (502, "ΣΣ İİ ǅ", None)])
    assert next(r for r in found if r[0] == 500)[2:] == ("und", 0.0)


def test_repeated_rows_and_ids(spark):
    rows = labelled()
    again = sorted(map(tuple, langfilter.identify(table(spark, rows + rows)).collect()))
    assert again == sorted(2 * [tuple(r) for r in langfilter.identify(table(spark, rows)).collect()])
    same = [(2, t, lang) for _, t, lang in rows] + [(None, TEXTS["de"], "en")] * 2
    assert len(langfilter.identify(table(spark, same)).collect()) == 62


def test_nothing_to_learn_from(spark):
    assert langfilter.identify(table(spark, [])).count() == 0
    found = langfilter.identify(table(spark, [(1, "some text", None), (2, None, "en")])).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2


def test_language_labels_and_ids_are_no_inputs_of_a_prediction(spark):
    rows = labelled()
    held = [(i, t, lang) for i, t, lang in rows if out(i)]
    others = [(i, t, lang) for i, t, lang in rows if not out(i)]
    plain = {r.doc_id: tuple(r) for r in langfilter.identify(table(spark, rows)).collect()}
    wrong = {r.doc_id: tuple(r) for r in langfilter.identify(table(spark, others + [(i, t, "xx") for i, t, _ in held])).collect()}
    assert plain == wrong


def test_long_texts_are_read_in_parts_that_fit_together():
    text = "Äb c1d" * 500
    whole = [langfilter.pieces(iter([text, "", "xy"]), size) for size in (7, 100, 1 << 20)]
    joined = [tuple(np.concatenate(c).tolist() for c in zip(*w, strict=True)) for w in whole]
    assert joined[0] == joined[1] == joined[2]
    assert len(joined[0][0]) == len(trigrams(text)) + 2


def test_filters_forget_nothing_and_err_as_they_say():
    rng = np.random.default_rng(4)
    langs = [f"l{i:03}" for i in range(70)]
    table = np.zeros((2, 1 << 13), dtype=np.uint64)
    own = rng.integers(1, 1 << 62, (70, 700)).astype(np.uint64)
    for b, gram in enumerate(own):
        for place in langfilter.places(gram, table.shape[1]):
            table[b >> 6, place] |= np.uint64(1) << np.uint64(b & 63)
    filled = np.array([float(((table[b >> 6] >> np.uint64(b & 63)) & np.uint64(1)).mean()) for b in range(70)])
    filters = Filters(langs, table, filled**langfilter.HASHES)
    for b in (0, 63, 64, 69):
        total, hits = filters.popcounts(own[b], np.zeros(700, dtype=np.int64), 1)
        assert total[0] == hits[b, 0] == 700
    strange = rng.integers(1, 1 << 62, 200_000).astype(np.uint64)
    total, hits = filters.popcounts(strange, np.zeros(len(strange), dtype=np.int64), 1)
    rate = hits[:, 0] / total[0]
    assert (rate > 0.3 * filters.error).all() and (rate < 3 * filters.error).all()
    assert np.abs(filters.shares(total, hits)).max() < 0.03


@pytest.mark.skipif(not SF.exists(), reason="test tables not present")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langfilter.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert len(found) > 200
    assert sum(r.lang == r.lang_pred for r in found) >= 0.99 * len(found)
