import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cellweave.llm import bestposition
from cellweave.llm.bestposition import Best, Lists, OrderOfIds
from helpers_llm import LOWER, documents, odd_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_by_hand(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked_by_hand(docs, items, k=10):
    held = [(i, Counter(terms_by_hand(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_all = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    joined = {}
    for item_id, text in items:
        joined.setdefault(item_id, Counter()).update(terms_by_hand(text))
    result = []
    for item_id, wanted in joined.items():
        scores = []
        for doc_id, c, n in held:
            m = 25 + 75 * n * n_docs // n_all
            score = 0
            for t, q in wanted.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += q * w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:k], 1):
            result.append((item_id, rank, None if none else doc_id, -score))
    return result


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "item_id long, text string, doc_id int, score int")


def compared(spark, docs, items, **sizes):
    found = bestposition.search(documents(spark, docs), items_of(spark, items), **sizes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(ranked_by_hand(docs, items, sizes.get("k", 10)), key=key)


def corpus(seed=3, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i % 140, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 60])))) for i in range(n)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 2, 8, 30])))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"k": 3}, {"block_postings": 60, "item_terms": 9}])
def test_against_plain_scores(spark, sizes):
    compared(spark, *corpus(), **sizes)


def test_odd_documents_and_items(spark):
    items = [(1, None), (2, ""), (3, "A a !"), (4, "This LINE stands"), (4, "line"), (None, "word1 and word2"), (None, "and"), (6, "nowhere")]
    items += [(7, "Ünïcode ÜNÏCODE 中文 👍🏽"), (8, " ".join(f"word{i}" for i in range(3000)))]
    compared(spark, odd_documents(), items)


def test_equal_scores_go_to_the_least_ids(spark):
    docs = [(i, "the same words in all of them") for i in range(40, 0, -1)] + [(None, "the same words in all of them")] * 2
    docs += [(100 + i, "others") for i in range(60)]
    found = bestposition.search(documents(spark, docs), items_of(spark, [(1, "same words")])).collect()
    assert [r.doc_id for r in found] == list(range(1, 11))
    compared(spark, docs[20:], [(1, "same words"), (2, "others the")], k=25)


def test_empty_tables(spark):
    docs, items = corpus()
    assert bestposition.search(documents(spark, []), items_of(spark, items)).count() == 0
    assert bestposition.search(documents(spark, docs), items_of(spark, [])).count() == 0
    assert bestposition.search(documents(spark, [(1, None)]), items_of(spark, items)).count() == 0


def lists_of(columns):
    """Lists of one gain for each document; as many terms as columns."""
    gain = np.array(columns, dtype=np.int64).T
    n_docs, n_terms = gain.shape
    start = np.arange(0, n_docs * n_terms + 1, n_terms)
    return Lists(start, np.tile(np.arange(n_terms), n_docs), gain.reshape(-1), n_terms)


def test_search_ends_before_the_lists_do():
    rng = np.random.default_rng(5)
    n = 20_000
    common = (1e6 / (1 + rng.permutation(n))).astype(np.int64)
    lists = lists_of([common, np.maximum(1, common + rng.integers(-3, 4, n))])
    order = OrderOfIds()
    order.ids = list(range(n))
    for _ in range(2):  # nothing of a search stays for the next one
        best = Best(order)
        assert lists.search({0: 1, 1: 2}, 5, best, 0) < n / 50
        total = lists.gain[0::2] + 2 * lists.gain[1::2]
        assert best.scores.tolist() == sorted(total.tolist(), reverse=True)[:5]
        assert not lists.seen_doc.any() and not lists.seen_place.any() and not lists.repeats.any()


def test_looked_up_places_move_the_best_position_on():
    # The second list is the first one: all that is read there has been seen already.
    gain = np.arange(1000, 0, -1)
    lists = lists_of([gain, gain])
    order = OrderOfIds()
    order.ids = list(range(1000))
    best = Best(order)
    assert lists.search({0: 1, 1: 1}, 3, best, 0) == bestposition.FIRST_READ
    assert order.ids[best.docs[0]] == 0
