"""Connected components of a graph given as rows of links, by alternating star contraction.

Each round links the larger neighbours of every node to its smallest one, then the smaller ones,
until every node hangs on the smallest of its component. A round aggregates with partial sums and
joins on the node; adaptive execution splits a node that holds many links. Each round's links are a
written table, so lineage stays one round long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import discard, scratch


def components(links: DataFrame) -> DataFrame:
    """``a``, ``b`` (two nodes, longs) to ``node``, ``root``: the root is the least node of the component.

    Nodes without a link to another one do not appear. Links to itself, doubled and null ones change nothing.
    """
    spark = links.sparkSession
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    path, before = None, None
    while True:
        links = links.distinct() if path is None else _small_star(_large_star(links))
        old, path = path, scratch(spark, "links")
        links.write.parquet(path)
        links = spark.read.schema("a long, b long").parquet(path)
        if old:
            discard(spark, old)
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
