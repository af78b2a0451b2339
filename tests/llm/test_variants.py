import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from cellweave.llm import variants
from helpers_llm import LOWER, documents, odd_documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_by_hand(rows, one_in, least_chars=6, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if one_in and h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least_chars:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def groups_by_hand(words, ratio=5):
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if is_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    result = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        result.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(result)


def grouped(spark, rows, **more):
    found = variants.group_variants(documents(spark, rows), **more)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, found.collect()))


def spelled(seed=1):
    """Words with their variants, of letters that make many anagrams."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeé", k=rng.choice([6, 7, 8]))) for _ in range(25)]
    words = []
    for word in base:
        words += [word] * rng.choice([6, 40, 300])
        for _ in range(rng.randrange(6)):
            at, letter = rng.randrange(len(word)), rng.choice("abcdeéÿ")
            variant = rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])
            words += [variant] * rng.choice([4, 5, 7, 30])
            words += [variant[::-1], variant[1:] + variant[:1]] * 5
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    return [(i, t if i % 2 else t.replace(" ", "1, ").upper()) for i, t in rows]


@pytest.mark.parametrize("one_in", [None, 3, 199])
def test_against_plain_comparison(spark, one_in):
    rows = spelled()
    expected = groups_by_hand(words_by_hand(rows, one_in))
    assert sum(r[4] > 0 for r in expected) > 20 and any(r[1] for r in expected)
    assert grouped(spark, rows, one_in=one_in) == expected


def test_chains_of_forms_end_at_the_root(spark):
    words = {"kitten": 5, "kittens": 30, "kittenso": 160, "kittensor": 900, "sitten": 5, "another": 6}
    rows = [(1, " ".join(w for w, n in words.items() for _ in range(n)))]
    found = {r[0]: r for r in grouped(spark, rows)}
    assert found["kitten"][1:3] == ("kittens", "kittensor")
    assert found["sitten"][1:3] == (None, "sitten")  # kittens is two steps away, kitten no more frequent
    assert found["another"] == ("another", None, "another", 6, 0, None)
    assert found["kittenso"][1:] == ("kittensor", "kittensor", 160, 2, 900)


def test_equally_frequent_forms_go_by_code_points(spark):
    words = {"zzzzzz": 5, "zzzzzé": 40, "zzzzza": 40, "zzzzzzz": 40}
    found = {r[0]: r for r in grouped(spark, [(1, " ".join(w for w, n in words.items() for _ in range(n)))])}
    assert found["zzzzzz"][1:] == ("zzzzza", "zzzzza", 5, 3, 40)


def test_odd_documents(spark):
    rows = odd_documents() + [(None, "Straße straßE strasse Größen")] * 7 + [(20, "ab" * 20_000)] * 5
    assert grouped(spark, rows, one_in=7) == groups_by_hand(words_by_hand(rows, 7))


def test_empty_tables(spark):
    assert grouped(spark, []) == []
    assert grouped(spark, [(1, None), (2, "few of 12 them")]) == []


def test_words_near_each_other_share_a_signature(spark):
    rng = random.Random(2)
    parts = {}
    words = ["".join(rng.choices("abcdefgé", k=8)) for _ in range(60)]
    pairs = [(w, w[:3] + "q" + w[rng.choice([3, 4]) :]) for w in words]
    flat = sorted({w for p in pairs for w in p})
    coded = variants.codes(spark.createDataFrame([(w, 5) for w in flat], "word string, n long"), parts)
    held = {}
    for r in variants.signatures(coded).collect():
        held.setdefault(r.word, set()).add((r.choice, r.same_0, r.same_1, r.same_2, r.same_3))
    assert all(len(s) == 15 for s in held.values())
    assert all(held[a] & held[b] for a, b in pairs)


def coded_words(spark, words):
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    return variants.codes(frame, variants.balanced_parts(frame))


def test_a_pair_comes_once_from_either_side_and_only_verified(spark):
    coded = coded_words(spark, ["abcdef", "fedcba", "abcdeff", "abcdeg", "bcdefa"])
    found = sorted((r.word, r.near) for r in variants.near_words(coded).collect())
    assert found == [("abcdef", "abcdeff"), ("abcdef", "abcdeg"), ("abcdeff", "abcdef"), ("abcdeg", "abcdef")]


@pytest.mark.parametrize("block", [3, 10, 4096])
def test_large_groups_are_dealt_and_stay_whole(spark, block):
    rng = random.Random(9)
    # Anagrams and near anagrams: many words have a signature in common.
    words = sorted({"".join(rng.sample("abcdefgh", 8)) for _ in range(80)})
    words = sorted({*words, *(w[:i] + "x" + w[i + 1 :] for w in words[:30] for i in (2, 5)), *(w + w[-1] for w in words[30:60])})
    expected = sorted((a, b) for a in words for b in words if is_near(a, b))
    found = sorted((r.word, r.near) for r in variants.near_words(coded_words(spark, words), block).collect())
    assert found == expected and len(found) > 150


def test_pairs_of_groups_in_bounded_steps(monkeypatch):
    monkeypatch.setattr(variants, "PAIRS", 4)
    sizes = np.array([1, 5, 2, 1, 7])
    steps = list(variants._pairs(sizes))
    found = [p for i, j in steps for p in zip(i.tolist(), j.tolist(), strict=True)]
    start = np.cumsum(sizes) - sizes
    assert sorted(found) == sorted((a, b) for s, n in zip(start, sizes, strict=True) for a, b in combinations(range(s, s + n), 2))
    assert all(len(i) <= 6 for i, _ in steps)


def test_words_of_any_length_are_compared():
    rng = random.Random(6)
    words = ["".join(rng.choices("abé", k=rng.choice([6, 7, 63, 64, 65, 66]))) for _ in range(40)]
    words += [w[:i] + w[i + 1 :] for w in words for i in (0, 3, 5)] + [w[:4] + "b" + w[5:] for w in words]
    i, j = np.array(list(combinations(range(len(words)), 2))).T
    assert variants._Words(words).one_apart(i, j).tolist() == [is_near(words[a], words[b]) for a, b in zip(i, j, strict=True)]


def test_a_ratio_that_would_allow_circles_is_refused(spark):
    with pytest.raises(ValueError):
        variants.group_variants(documents(spark, []), ratio=1)
