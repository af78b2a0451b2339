"""Exact top-k search by inner product with M-trees.

Inner products are turned into distances: a vector v gets one more coordinate, sqrt(M² - |v|²), M being the largest norm,
and a query gets 0 there. Then |q - v|² = |q|² + M² - 2 q·v, so the nearest have the largest products.

Vectors are dealt to cells by their nearest pivot (pivots are rows of a bounded sample), large cells further by a hash of the row,
and every cell gets an M-tree: pages of bounded size, each with a routing vector, a covering radius and the distance to its
parent. A query visits pages best first. What the triangle inequality excludes through stored parent distances is skipped
without computing a distance, and the search ends when no page can hold anything as near as the k-th best.

Queries first search the cell of their nearest pivot. With the score found there they go only to cells whose covering radius
leaves a chance. Scores are integers, computed exactly from the integer vectors, in whole numbers of any length where doubles do not suffice;
distances only exclude, with a margin above their rounding error that grows with the vectors.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import keep

# Rows looked at to choose pivots, pivots at most, rows of a tree and entries of a page.
SAMPLE = 4096
PIVOTS = 256
TREE_ROWS = 8192
PAGE = 256
# Queries one task searches a tree for.
QUERY_BLOCK = 2048
# Doubles add up exactly what stays below, as the product of two vectors' lengths does for all their sums.
EXACT = 2.0**52
MARGIN = 1e-6
# Rounding error of a product, as a share of the two lengths.
ROUNDING = 1e-9
# Stands for all scores below those a long holds.
LOWEST = -(1 << 63)


@dataclass
class Node:
    """A page: rows low..high of the tree's order, and children unless it is a leaf."""

    center: int
    radius: float
    parent_distance: float
    low: int
    high: int
    children: list[Node]


class MTree:
    """Tree over integer vectors, bulk-loaded by dealing rows to chosen routing rows, level by level."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, page: int = PAGE):
        self.vectors = vectors.astype(np.float64)
        self.norms = (self.vectors**2).sum(axis=1)
        self.longest = float(np.sqrt(self.norms.max(initial=0.0)))
        self.extra = np.sqrt(np.maximum(0.0, largest - self.norms))
        self.largest = largest
        self.order = np.arange(len(ids))
        self.to_center = np.zeros(len(ids))
        self.page = page
        first = int(np.argmin(ids))
        away = self._distances(first, self.order)
        self.root = self._build(0, len(ids), first, 0.0, away)
        self.ids = ids[self.order]
        self.vectors, self.norms, self.extra = self.vectors[self.order], self.norms[self.order], self.extra[self.order]
        place = np.empty_like(self.order)
        place[self.order] = np.arange(len(ids))
        self._renumber(self.root, place)

    def _distances(self, row: int, others: np.ndarray) -> np.ndarray:
        square = self.norms[row] + self.norms[others] - 2 * (self.vectors[others] @ self.vectors[row])
        return np.sqrt(np.maximum(0.0, square + (self.extra[row] - self.extra[others]) ** 2))

    def _build(self, low: int, high: int, center: int, parent_distance: float, away: np.ndarray) -> Node:
        """``away`` are the distances of rows low..high to the center."""
        node = Node(center, float(away.max(initial=0.0)), parent_distance, low, high, [])
        if high - low <= self.page:
            self.to_center[low:high] = away
            return node
        rows = self.order[low:high]
        spread = np.argsort(away, kind="stable")
        ways = min(self.page, -(-len(rows) // self.page) + 1)
        routing = rows[spread[np.linspace(0, len(rows) - 1, ways).astype(int)]]
        every = np.stack([self._distances(int(r), rows) for r in routing])
        nearest = every.argmin(axis=0)
        if np.bincount(nearest, minlength=ways).max() == len(rows):
            # All rows look alike from here; cut them into even runs.
            nearest = np.arange(len(rows)) * ways // len(rows)
        sort = np.argsort(nearest, kind="stable")
        self.order[low:high] = rows[sort]
        bounds = np.searchsorted(nearest[sort], np.arange(ways + 1))
        for way in range(ways):
            start, end = bounds[way], bounds[way + 1]
            if start < end:
                router = int(routing[way])
                to_parent = float(self._distances(center, np.array([router]))[0])
                part = every[way][sort[start:end]]
                node.children.append(self._build(low + start, low + end, router, to_parent, part))
        return node

    def _renumber(self, node: Node, place: np.ndarray) -> None:
        node.center = int(place[node.center])
        for child in node.children:
            self._renumber(child, place)

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, id) of at least ``floor``, the row ``own`` left out, and how many distances it took."""
        query = query.astype(np.float64)
        length = float(np.sqrt(query @ query))
        size = length**2 + self.largest
        wide = length * self.longest >= EXACT
        digits = [int(x) for x in query] if wide else []
        if abs(floor) >= EXACT:
            # It may have been rounded up.
            floor -= abs(floor) * 2.0**-50
        slack = MARGIN * (1.0 + size)
        best: list[tuple[int, int]] = []
        bound, computed = floor, 1

        def reach() -> float:
            """Largest distance that can still matter."""
            return np.sqrt(max(0.0, size - 2 * bound + slack)) if bound > -np.inf else np.inf

        away = float(np.sqrt(max(0.0, size - 2 * float(self.vectors[self.root.center] @ query))))
        todo = [(max(0.0, away - self.root.radius), 0, self.root, away)]
        serial, limit = 1, reach()
        margin = np.sqrt(slack)
        while todo:
            least, _, node, away = heapq.heappop(todo)
            if least > limit + margin:
                break
            if node.children:
                hopeful = [c for c in node.children if abs(away - c.parent_distance) - c.radius <= limit + margin]
                if not hopeful:
                    continue
                scores = self.vectors[[c.center for c in hopeful]] @ query
                computed += len(hopeful)
                for child, distance in zip(hopeful, np.sqrt(np.maximum(0.0, size - 2 * scores)).tolist(), strict=True):
                    bottom = max(0.0, distance - child.radius)
                    if bottom <= limit + margin:
                        heapq.heappush(todo, (bottom, serial, child, distance))
                        serial += 1
                continue
            near = np.flatnonzero(np.abs(away - self.to_center[node.low : node.high]) <= limit + margin) + node.low
            if not len(near):
                continue
            # A page of which nothing is left out is read as it lies, without a copy.
            held = slice(node.low, node.high) if len(near) == node.high - node.low else near
            scores = self.vectors[held] @ query
            computed += len(near)
            # The widest rows are only counted out where their rounding error leaves no doubt.
            unsure = ROUNDING * length * np.sqrt(self.norms[held]) if wide else 0.0
            good = np.flatnonzero(scores + unsure >= bound)
            good = good[self.ids[near[good]] != own]
            if len(good):
                if wide:
                    exact = [sum(a * int(b) for a, b in zip(digits, self.vectors[i], strict=True)) for i in near[good]]
                else:
                    exact = scores[good].astype(np.int64).tolist()
                found = zip(exact, (-self.ids[near[good]]).tolist(), strict=True)
                best = heapq.nlargest(k, [*best, *found])
                if len(best) == k:
                    bound = max(bound, best[-1][0])
                    limit = reach()
        return [(score, -negative) for score, negative in best], computed


def whole_vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``vector``: floor(scale * x) of every component, of rows that take part."""

    def whole(x):
        """Whole as it is where doubles have no fractions, and perhaps too large for a long."""
        return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)

    vector = F.transform("embedding", lambda x: whole(F.lit(scale) * x.cast("double")))
    # Not-a-number components compare above infinite ones.
    fit = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fit, F.lit(False))).select("vec_id", vector.alias("vector"))


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    return np.array(list(column), dtype=np.float64) if len(column) else np.zeros((0, 0))


class Pivots:
    """Routing vectors of the forest, from a bounded sample, for vectors of one length."""

    def __init__(self, sample: list[list[int]], wanted: int):
        lengths = [len(v) for v in sample]
        self.length = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 0
        alike = [v for v in sample if len(v) == self.length]
        rows = np.array(alike, dtype=np.float64).reshape(len(alike), self.length)
        self.vectors = self._spread(np.unique(rows, axis=0), wanted)
        self.norms = (self.vectors**2).sum(axis=1)

    @staticmethod
    def _spread(rows: np.ndarray, wanted: int) -> np.ndarray:
        """Rows each as far as possible from those before."""
        if not len(rows):
            return rows
        chosen = [0]
        away = ((rows - rows[0]) ** 2).sum(axis=1)
        while len(chosen) < min(wanted, len(rows)):
            chosen.append(int(away.argmax()))
            away = np.minimum(away, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
        return rows[chosen]

    def distances(self, vectors: np.ndarray, largest: float, query: bool = False) -> np.ndarray:
        """Distances of rows to the pivots, in the space with the added coordinate."""
        norms = (vectors**2).sum(axis=1)
        square = norms[:, None] + self.norms[None, :] - 2 * vectors @ self.vectors.T
        own = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0.0, largest - norms))
        pivot = np.sqrt(np.maximum(0.0, largest - self.norms))
        return np.sqrt(np.maximum(0.0, square + (own[:, None] - pivot[None, :]) ** 2))


def assign(vectors: DataFrame, pivots: Pivots, largest: dict[int, float]) -> DataFrame:
    """Vectors with the pivot of their cell and the distance to it; lengths the pivots do not have are cells of their own."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector").to_pylist()
            cell = np.array([-1 - len(v) for v in values], dtype=np.int64)
            away = np.zeros(len(values))
            fit = np.flatnonzero(cell == -1 - pivots.length)
            if len(fit) and len(pivots.vectors):
                found = pivots.distances(_matrix([values[i] for i in fit]), largest[pivots.length])
                cell[fit] = found.argmin(axis=1)
                away[fit] = found.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(cell), pa.array(away)],
                ["vec_id", "vector", "pivot", "away"],
            )

    return vectors.mapInArrow(work, "vec_id long, vector array<double>, pivot long, away double")


def build_trees(assigned: DataFrame, parts: dict[int, int], largest: dict[int, float]) -> DataFrame:
    """A row for each tree: its pivot, its part of the cell, and the pickled tree."""
    spark = assigned.sparkSession
    counts = spark.createDataFrame(sorted(parts.items()), "pivot long, parts long")
    dealt = assigned.join(F.broadcast(counts), "pivot")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), "parts"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id", kind="stable")
        vectors = _matrix(group["vector"]).reshape(len(group), -1)
        tree = MTree(group["vec_id"].to_numpy(), vectors, largest[vectors.shape[1]])
        return pd.DataFrame(
            {"pivot": [group["pivot"].iloc[0]], "part": [group["part"].iloc[0]], "tree": [pickle.dumps(tree)]}
        )

    columns = dealt.select("pivot", "part", "vec_id", "vector")
    return columns.groupBy("pivot", "part").applyInPandas(build, "pivot long, part long, tree binary")


FOUND = "number long, query_id long, vec_id long, score long, computed long"


def search_trees(trees: DataFrame, asked: DataFrame, blocks: int, k: int) -> DataFrame:
    """Search each tree for the queries that ask for it, a bounded block of queries and one tree at a time."""
    block = F.pmod(F.xxhash64("number"), F.lit(blocks)).alias("block")
    asked = asked.select("pivot", "part", block, "number", "query_id", "vector", "floor")
    key = ("pivot", "part", "block")
    # Only what is asked for: a tree goes to the blocks that have a query for it.
    trees = trees.join(keep(asked.select(*key).distinct(), "asked"), ["pivot", "part"])

    def work(held: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(held) and len(queries):
            tree: MTree = pickle.loads(held["tree"].iloc[0])
            for number, own, vector, floor in queries[["number", "query_id", "vector", "floor"]].itertuples(index=False):
                best, computed = tree.search(np.asarray(vector, dtype=np.float64), own, k, floor)
                found += [(number, own, vec_id, max(score, LOWEST), computed) for score, vec_id in best]
        return pd.DataFrame(found, columns=[c.split()[0] for c in FOUND.split(", ")])

    return trees.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(work, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _asked(queries: DataFrame, pivots: Pivots, largest: dict[int, float], parts: dict[int, int], radius: dict[int, float], home: bool) -> DataFrame:
    """Queries with the trees they ask for: one of the nearest pivot, or all that may hold something above their floor."""
    cells = np.array(sorted(p for p in parts if p >= 0), dtype=np.int64)
    reach = np.array([radius[p] for p in cells.tolist()])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, floors = batch.column("vector").to_pylist(), batch.column("floor").to_pylist()
            found: list[tuple[int, int, int]] = []
            for row, (value, floor) in enumerate(zip(values, floors, strict=True)):
                if len(value) != pivots.length or not len(cells):
                    wanted = [-1 - len(value)] if -1 - len(value) in parts else []
                else:
                    vector = np.array([value], dtype=np.float64)
                    away = pivots.distances(vector, largest[len(value)], query=True)[0][cells]
                    if home:
                        wanted = [int(cells[away.argmin()])]
                    else:
                        size = float(vector[0] @ vector[0]) + largest[len(value)]
                        limit = np.sqrt(max(0.0, size - 2 * floor) + MARGIN * (1 + size)) if floor > -np.inf else np.inf
                        wanted = cells[away - reach <= limit + MARGIN * (1 + limit)].tolist() if limit < np.inf else cells.tolist()
                found += [(row, p, part) for p in wanted for part in range(1 if home else parts[p])]
            rows_, cell, part = (np.array(c, dtype=np.int64) for c in (zip(*found, strict=True) if found else [[]] * 3))
            taken = batch.take(pa.array(rows_))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cell), pa.array(part)], [*taken.schema.names, "pivot", "part"]
            )

    schema = "number long, query_id long, vector array<double>, floor double, pivot long, part long"
    return queries.select("number", "query_id", "vector", "floor").mapInArrow(work, schema)


def top_k(table: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for rows that fulfil ``is_query`` the k rows of the largest inner
    product with them, all if there are fewer, ties to the smaller id.

    Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do rows without id; a score
    among the best that a long does not hold is an error, as in SQL, and so are components whose squares a double does not hold
    (no float's); vectors of other lengths are no candidates; a row is no candidate of a query of its id;
    repeated rows are candidates each, and repeated queries are answered each; an empty table gives no rows. Other columns are
    ignored.
    """
    spark = table.sparkSession
    vectors = keep(whole_vectors(table, scale), "vectors")
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    sizes = vectors.groupBy(F.size("vector").alias("length")).agg(F.max(norm), F.count("*")).collect()
    largest = {row[0]: float(row[1]) for row in sizes}
    if not np.isfinite(list(largest.values())).all():
        raise ValueError("squares of components are beyond double precision")
    rows_ = sum(row[2] for row in sizes)
    # The rows whose hashed id is least: a sample that does not depend on how the table is cut.
    sample = [r[0] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()]
    pivots = Pivots(sample, max(1, min(PIVOTS, rows_ // TREE_ROWS)))
    assigned = keep(assign(vectors, pivots, largest), "assigned")
    cells = assigned.groupBy("pivot").agg(F.count("*"), F.max("away")).collect()
    parts = {row[0]: -(-row[1] // TREE_ROWS) for row in cells}
    radius = {row[0]: row[2] for row in cells}
    trees = keep(build_trees(assigned, parts, largest), "trees")
    queries = vectors.where(is_query).select(
        F.monotonically_increasing_id().alias("number"),
        F.col("vec_id").alias("query_id"),
        "vector",
        F.lit(float("-inf")).alias("floor"),
    )
    queries = keep(queries, "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    first = search_trees(trees, _asked(queries, pivots, largest, parts, radius, True), blocks, k)
    floors = _best(first, k).where((F.col("rank") == k) & (F.col("score") > LOWEST)).select("number", F.col("score").cast("double").alias("floor"))
    bounded = queries.drop("floor").join(floors, "number", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    bounded = keep(bounded, "bounded")
    found = search_trees(trees, _asked(bounded, pivots, largest, parts, radius, False), blocks, k)
    low = F.raise_error(F.lit("a score is below those a long holds")).cast("long")
    score = F.when(F.col("score") > LOWEST, F.col("score")).otherwise(low).alias("score")
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score)
