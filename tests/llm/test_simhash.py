import random
import re

import numpy as np
import pytest
import xxhash

from cellweave.llm import simhash
from cellweave.llm.components import components
from helpers_llm import LOWER, WORD, documents, odd_documents


def fingerprint_by_hand(text, width=4):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows, prints, max_bits=4):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    result = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        result.append((doc_id, f"{prints[i]:016x}", min(ids, default=None)))
    return result


def near_copies(n, seed=1):
    choose = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for doc_id in range(n):
        if rows and doc_id % 3:
            text = rows[choose.randrange(len(rows))][1].split(" ")
            for _ in range(choose.randint(0, 3)):
                text[choose.randrange(len(text))] = choose.choice(words)
            rows.append((doc_id, " ".join(text)))
        else:
            rows.append((doc_id, " ".join(choose.choices(words, k=choose.randint(1, 400)))))
    return rows


@pytest.mark.parametrize("rows", [odd_documents(), near_copies(400)], ids=["odd", "copies"])
def test_against_all_pairs(spark, rows):
    prints = [fingerprint_by_hand(t) for _, t in rows]
    result = simhash.near_duplicates(documents(spark, rows))
    assert result.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(groups_by_hand(rows, prints), key=repr)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 5, 6])
@pytest.mark.parametrize("block", [8, 4096])
def test_no_link_is_lost(spark, max_bits, block):
    """Fingerprints around a few centres, some a third of all: as many groups as comparing all pairs gives."""
    rng = np.random.default_rng(max_bits)
    prints = set()
    for centre in rng.integers(0, 1 << 62, 12).tolist():
        for _ in range(120 if not prints else 15):
            flips = rng.choice(64, int(rng.integers(0, max_bits + 4)), replace=False)
            prints.add(centre ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)
    copied = simhash.copies(table, max_bits).cache()
    assert copied.where("home").groupBy("fp").count().where("count <> 3").count() == 0
    found = components(simhash.links(copied, max_bits, block)).collect()
    by_hand = groups_by_hand([(s, None) for s in signed], prints, max_bits)
    roots = {r.node: r.root for r in found}
    assert len(roots) == len(found)
    assert {s: roots.get(s, s) for s in signed} == {s: least for s, _, least in by_hand}


def test_golay_code_is_perfect():
    code = simhash.golay_anchors(1)
    words = np.random.default_rng(0).integers(0, 1 << 23, 3000).astype(np.uint32)
    position, anchors, home = code.near(words)
    assert np.bincount(position[home], minlength=3000).tolist() == [1] * 3000
    code_words = (anchors[home].astype(np.uint32) << 11) | code.rest[anchors[home]] & 0x7FF
    assert np.bitwise_count(words ^ code_words).max() <= 3
    every = (np.arange(4096, dtype=np.uint32) << 11) | code.rest & 0x7FF
    for k in range(20):
        near = np.flatnonzero(np.bitwise_count(words[k] ^ every) <= 4)
        assert sorted(anchors[position == k]) == near.tolist()


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (2000, 2001), (2001, 2000), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(101)} | {1000 + i: 1000 for i in range(300)} | {2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays_with_its_columns(spark):
    rows = near_copies(90, 4) + [(500, None), (501, ""), (None, "w1 w2"), (3, near_copies(4, 4)[3][1])]
    table = documents(spark, rows)
    kept = simhash.without_near_duplicates(table)
    assert kept.columns == table.columns
    groups = groups_by_hand(rows, [fingerprint_by_hand(t) for _, t in rows])
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({g for i, _, g in groups if g is not None})
    assert kept.where("doc_id is null").count() == 1
    assert re.fullmatch("[0-9a-f]{16}", groups[0][1])
