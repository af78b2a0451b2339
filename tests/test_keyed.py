"""A table with one row for each key, merged over loads."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from cellweave.sinks.keyed import KeyedTable

KINDS = "libelle string, categorie string, no int"


def table_of(tmp_path, **options):
    return KeyedTable(f"t_{uuid.uuid4().hex}", str(tmp_path), ("libelle",), ("no",), **{"buckets": 4, **options})


def contents(spark, table):
    return sorted((tuple(r) for r in table.read(spark).collect()), key=repr)


def loads(seed, n=3):
    pick = random.Random(seed)
    keys = [None, "", "null", "a", "A", " a", *[f"k{i}" for i in range(30)]]
    return [[(pick.choice(keys), pick.choice([None, "", "c", "d"]), pick.choice([None, *range(5)])) for _ in range(60)] for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_loads_leave_what_one_load_of_all_leaves(spark, tmp_path, seed):
    parts, one, many = loads(seed), table_of(tmp_path), table_of(tmp_path)
    one.upsert(spark.createDataFrame(sum(parts, []), KINDS))
    for part in parts:
        many.upsert(spark.createDataFrame(part, KINDS))
    assert contents(spark, one) == contents(spark, many)
    first = {}
    low = lambda v: (v is not None, v if v is not None else 0)
    for key, kind, no in sum(parts, []):
        rank = (low(no), (kind is not None, kind or ""))
        first[key] = min(first.get(key, (rank, kind, no)), (rank, kind, no), key=lambda t: t[0])
    assert contents(spark, many) == sorted(((k, kind, no) for k, (_, kind, no) in first.items()), key=repr)


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    table = table_of(tmp_path, buckets=16)
    table.upsert(spark.range(1000).select(F.concat(F.lit("k"), "id").alias("libelle"), F.lit("c").alias("categorie"), F.col("id").cast("int").alias("no")))
    more = spark.createDataFrame(loads(1)[0], KINDS)
    plan = table.merged(more)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    (scan,) = [i for i, x in enumerate(lines) if "FileScan parquet" in x and "Bucketed: true" in x]
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    assert join < scan and not any("Exchange" in x for x in lines[join:scan])


def test_a_repeated_load_adds_nothing_and_empty_loads_do(spark, tmp_path):
    table = table_of(tmp_path)
    assert table.upsert(spark.createDataFrame([], KINDS), 1) == 1 and contents(spark, table) == []
    assert table.upsert(spark.createDataFrame([("a", "c", 2)], KINDS), 2) == 2
    assert table.upsert(spark.createDataFrame([("z", "c", 1)], KINDS), 2) == 2
    assert table.upsert(spark.createDataFrame([("a", "d", 1), ("b", None, None)], KINDS), 3) == 3
    assert table.upsert(spark.createDataFrame([], KINDS)) == 4
    assert contents(spark, table) == [("a", "d", 1), ("b", None, None)]
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([], KINDS), 9)
    with pytest.raises(ValueError):
        table.upsert(spark.range(1).select(F.col("id").alias("libelle"), F.lit(1).alias("no")))
    assert not spark.catalog.tableExists(f"{table.name}_v1") and spark.catalog.tableExists(f"{table.name}_v3")
