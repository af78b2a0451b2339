"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has virtual nodes at hashed places of a ring, and a document belongs to the first node clockwise
of its hashed id. A shard takes documents up to its load; those beyond go on clockwise to the next node of a
shard with room. Loads are the row count divided evenly, so counts differ by one at most, while most
documents stay where the plain ring puts them.

The ring has a fixed number of slots. Only the row count of each slot goes to the driver, a table of fixed
size whatever the data. There whole ranges of slots are dealt out, and the ranges go back as a broadcast
of at most slots plus shards times slots-with-overflow rows.

Rows are numbered within their slot, each slot in one task; a slot that holds many of them, as that of a null or often repeated id may,
is numbered part by part as it was read, and the parts' counts are added up, so no task has more than it read.

Defined cases: a null text has size 1; a text of any length is measured whole; null ids share one place of the ring, equal rows
another, and are still dealt evenly; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import keep
from cellweave.operators.dedupe import number_within

SLOTS = 1 << 14
# A slot with more rows than this and than a thousandth of all is numbered in parts.
LARGE_SLOT = 10_000
NODES = 128
DEALT = "slot long, low long, high long, shard int, base long"


def ring(shards: int, nodes: int = NODES, slots: int = SLOTS) -> list[tuple[int, int]]:
    """Places of all virtual nodes with their shards, in clockwise order."""
    placed = [
        (xxhash.xxh64_intdigest(f"shard {shard} node {node}") * slots >> 64, shard)
        for shard in range(shards)
        for node in range(nodes)
    ]
    return sorted(placed)


def deal(counts: dict[int, int], shards: int, nodes: int = NODES, slots: int = SLOTS) -> list[tuple[int, int, int, int, int]]:
    """Ranges of rows of each slot with their shard and the rows it has before: (slot, low, high, shard, base).

    Shards first take the rows of their own arcs in ring order; what exceeds their load then goes
    clockwise, arc by arc.
    """
    total = sum(counts.values())
    room = [total // shards + (shard < total % shards) for shard in range(shards)]
    placed = ring(shards, nodes, slots)
    places = [place for place, _ in placed]
    taken: list[tuple[int, int, int, int]] = []
    beyond: list[tuple[int, int, int, int]] = []
    for slot in sorted(counts):
        node = bisect_left(places, slot) % len(placed)
        shard = placed[node][1]
        own = min(room[shard], counts[slot])
        room[shard] -= own
        if own:
            taken.append((slot, 0, own, shard))
        if own < counts[slot]:
            beyond.append((node, slot, own, counts[slot]))
    for node, slot, low, high in sorted(beyond):
        while low < high:
            shard = placed[node][1]
            more = min(room[shard], high - low)
            if more:
                taken.append((slot, low, low + more, shard))
                room[shard] -= more
                low += more
            node = (node + 1) % len(placed)
    used = [0] * shards
    dealt = []
    for slot, low, high, shard in taken:
        dealt.append((slot, low, high, shard, used[shard]))
        used[shard] += high - low
    return dealt


def _numbered(sized: DataFrame, counts: dict[int, int], large_slot: int) -> DataFrame:
    """Rows with ``_rank``, their number within their slot from 0."""
    least = max(large_slot, sum(counts.values()) // 1000)
    large = [slot for slot, n in counts.items() if n > least]  # fewer than a thousand
    order = [F.col(c) for c in ("_place", "doc_id", "text_crc32", "size")]
    in_slot = Window.partitionBy("_slot").orderBy(*order)
    small = sized.where(~F.col("_slot").isin(large)) if large else sized
    ranked = small.withColumn("_rank", F.row_number().over(in_slot).cast("long") - 1)
    if not large:
        return ranked
    parts = number_within(sized.where(F.col("_slot").isin(large)), ["_slot"], F.col("_part"), order, "_rank")
    return ranked.unionByName(parts.withColumn("_rank", F.col("_rank").cast("long") - 1))


def shard_documents(docs: DataFrame, shards: int, nodes: int = NODES, slots: int = SLOTS, large_slot: int = LARGE_SLOT) -> DataFrame:
    """Per document: ``size`` in bytes plus one, ``text_crc32``, its ``shard`` and its gapless place ``slot`` there."""
    spark = docs.sparkSession
    place = F.xxhash64("doc_id")
    slot = F.shiftrightunsigned(place, 64 - (slots - 1).bit_length()).alias("_slot")
    sized = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        slot,
        place.alias("_place"),
        F.spark_partition_id().alias("_part"),
    )
    sized = keep(sized, "sizes")
    counts = {row[0]: row[1] for row in sized.groupBy("_slot").count().collect()}
    dealt = deal(counts, shards, nodes, slots)
    ranges = spark.createDataFrame(dealt, DEALT).withColumnsRenamed({"slot": "_slot", "shard": "_shard"})
    ranked = _numbered(sized, counts, large_slot)
    at = (ranked["_slot"] == ranges["_slot"]) & ranked["_rank"].between(F.col("low"), F.col("high") - 1)
    return ranked.join(F.broadcast(ranges), at).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        (F.col("base") + F.col("_rank") - F.col("low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
