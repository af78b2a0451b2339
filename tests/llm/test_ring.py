import zlib
from collections import Counter

from pyspark.sql import functions as F

from cellweave.llm import ring
from helpers_llm import documents, odd_documents


def test_odd_rows_are_dealt_evenly(spark):
    rows = odd_documents()
    result = ring.shard_documents(documents(spark, rows), 8).collect()
    wanted = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in result], key=repr) == sorted(wanted, key=repr)
    counts = Counter(r.shard for r in result)
    assert len(counts) == 8 and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in result if r.shard == shard) == list(range(counts[shard]))
    assert {r.law for r in result} == {"rows"} and {r.grown_shard for r in result} == {None}


def test_a_slot_of_many_rows_is_numbered_in_parts(spark):
    """Half of the rows have no id, a third are equal."""
    rows = [(None, f"text {i % 50}") for i in range(600)] + [(7, "same")] * 400 + [(i, f"t{i}") for i in range(100, 300)]
    docs = documents(spark, rows).repartition(6)
    result = ring.shard_documents(docs, 8, large_slot=50)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan
    kept = result.collect()
    wanted = [(i, len(t) + 1, zlib.crc32(t.encode())) for i, t in rows]
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in kept], key=repr) == sorted(wanted, key=repr)
    assert sorted((r.shard, r.slot) for r in kept) == [(s, k) for s in range(8) for k in range(150)]


def test_no_task_numbers_more_than_it_read(spark):
    docs = documents(spark, [(None, f"text {i}") for i in range(800)]).repartition(8)
    sized = docs.select(F.lit(0).alias("_slot"), F.lit(0).alias("_place"), "doc_id", F.lit(1).alias("text_crc32"), F.lit(1).alias("size"), F.spark_partition_id().alias("_part"))
    sized = spark.createDataFrame(sized.collect(), sized.schema)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered = ring._numbered(sized, {0: 800}, 50).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r._rank for r in numbered) == list(range(800))
    assert len({r.task for r in numbered}) > 1


def test_empty_table_and_fewer_rows_than_shards(spark):
    assert ring.shard_documents(documents(spark, []), 8).count() == 0
    few = ring.shard_documents(documents(spark, [(1, "a"), (2, "b")]), 8).collect()
    assert len({r.shard for r in few}) == 2


def test_deal_by_hand():
    """Row by row: each to its own shard while it has room, those beyond clockwise from their own node."""
    counts = {s: (s * 7) % 5 + (200 if s == 3 else 0) for s in range(0, 64)}
    shards, nodes, slots = 5, 3, 64
    placed = ring.ring(shards, nodes, slots)
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    place, late = {}, []
    for slot in range(slots):
        node = next((k for k, (at, _) in enumerate(placed) if at >= slot), 0)
        for rank in range(counts[slot]):
            shard = placed[node][1]
            if room[shard]:
                room[shard] -= 1
                place[slot, rank] = shard
            else:
                late.append((node, slot, rank))
    for node, slot, rank in sorted(late):
        while not room[placed[node % len(placed)][1]]:
            node += 1
        shard = placed[node % len(placed)][1]
        room[shard] -= 1
        place[slot, rank] = shard
    dealt = ring.deal({k: v for k, v in counts.items() if v}, shards, nodes, slots)
    assert {(s, r): shard for s, low, high, shard, _ in dealt for r in range(low, high)} == place
    for shard in range(shards):
        ranges = sorted((base, base + high - low) for _, low, high, at, base in dealt if at == shard)
        assert [r[0] for r in ranges] == [0, *[r[1] for r in ranges]][:-1]


def test_a_shard_more_moves_few_rows():
    counts = {s: 10 for s in range(ring.SLOTS)}

    def where(shards):
        return {(s, r): at for s, low, high, at, _ in ring.deal(counts, shards) for r in range(low, high)}

    before, after = where(8), where(9)
    moved = sum(before[k] != after[k] for k in before) / len(before)
    assert 1 / 9 <= moved < 0.35
