import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import mtree

TABLE = "vec_id long, embedding array<float>, label int, vector string, pivot int, number int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], TABLE).repartition(3)


def best_by_hand(rows, k=5):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    result = []
    for q, a in whole:
        if q % 50 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b)]
            result += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return result


def cloud(n, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, (centres[rng.integers(6)] * rng.uniform(0.2, 2) + rng.normal(size=dim) / 5).tolist()) for i in range(n)]


ODD = [
    (0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0, float("inf")]),
    (7, [0.1, 0.2, 0.3]), (50, [-0.001, 3.0]), (100, [0.7, 0.2, 0.1]), (150, None), (None, [0.5, 0.5]), (8, [0.0, 0.0]), (9, []), (200, []),
    (1, [0.5, 0.25]), (10, [-0.5, -0.25]),
]


@pytest.mark.parametrize("rows", [ODD, cloud(700), [(i, [0.5] * 4) for i in range(300)]], ids=["odd", "cloud", "all alike"])
@pytest.mark.parametrize("tree_rows", [40, 8192])
def test_against_all_pairs(spark, rows, tree_rows, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", tree_rows)
    result = mtree.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, result.collect())) == sorted(best_by_hand(rows))


def test_empty_table(spark):
    assert mtree.top_k(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_tree_skips_distances():
    rows = cloud(4000, dim=4, seed=3)
    whole = np.floor(256 * np.array([v for _, v in rows]))
    largest = float((whole**2).sum(axis=1).max())
    tree = mtree.MTree(np.arange(4000), whole, largest)
    total = 0
    for q in range(0, 4000, 100):
        best, computed = tree.search(whole[q], q, 5, -np.inf)
        scores = whole @ whole[q]
        wanted = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        assert [(s, i) for s, i in best] == [(-s, i) for s, i in wanted]
        total += computed
    assert total < 0.6 * 40 * 4000


def test_covering_radii_hold():
    rows = cloud(3000, dim=6, seed=4)
    whole = np.floor(256 * np.array([v for _, v in rows]))
    tree = mtree.MTree(np.arange(3000), whole, float((whole**2).sum(axis=1).max()))
    assert sorted(tree.ids) == list(range(3000))

    def walk(node, depth=0):
        away = tree._distances(node.center, np.arange(node.low, node.high))
        assert away.max() <= node.radius + 1e-6
        if not node.children:
            assert node.high - node.low <= tree.page
            assert np.allclose(away, tree.to_center[node.low : node.high])
        assert [c.low for c in node.children] == [node.low, *[c.high for c in node.children]][: len(node.children)]
        for child in node.children:
            assert child.parent_distance == pytest.approx(float(tree._distances(node.center, np.array([child.center]))[0]))
            walk(child, depth + 1)

    walk(tree.root)


def wide():
    """Small and wide vectors, and wide ones whose products differ only beyond the digits of a double."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=2) * 10.0 ** rng.integers(-2, 7)).clip(-3e6, 3e6).tolist()) for i in range(400)]
    near = [(1000 + i, [3e6, int(k) / 256]) for i, k in enumerate(rng.permutation(120))]
    return [*rows, *near, (2000, [3e6, 1 / 256]), (2050, [3e6, -1 / 256]), (2100, [4096.0, 0.0]), (2150, [0.0, 3e6])]


@pytest.mark.parametrize("tree_rows", [40, 8192])
def test_wide_components_take_part(spark, tree_rows, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", tree_rows)
    result = mtree.top_k(vectors(spark, wide()), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, result.collect())) == sorted(best_by_hand(wide()))


def test_components_beyond_a_long_take_part(spark):
    rows = [(0, [0.0, 1.0]), (1, [1e30, 1.0]), (2, [-3e38, 2.0]), (3, [1.0, 0.5]), (4, [5.0, None]), (5, [float("inf"), 1.0])]
    assert sorted(map(tuple, mtree.top_k(vectors(spark, rows), F.col("vec_id") == 0).collect())) == [
        r for r in best_by_hand(rows) if r[0] == 0
    ]
