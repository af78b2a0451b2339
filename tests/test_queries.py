"""A query of each kind against its SQL on the smallest tables; tools/check.py runs them all."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import kind, rows_of
from workloads import registry

SF = Path("/root/testdata/sf0.001")
SAMPLE = [
    "f01_fold_text", "f03c_number_euro", "f09_parse_date_both_orders", "a06_date_parse_counts", "t03_decide_rpa", "c01_typed_table",
    "n05b_header_by_density_last", "n12_stack_sheets", "d01_dedupe_prefers_category", "s01_workbook_sheets", "g07_decide_in_order",
    "g12_archive_names", "p04_spa_sheets", "p07_client_categories", "p10_latest_versions",
]


@pytest.mark.skipif(not SF.exists(), reason="test tables not present")
@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, name):
    db = duckdb.connect()
    for p in SF.glob("*.parquet"):
        db.execute(f"create view {p.stem} as select * from '{p}'")
    df = entry.queries()[name](spark, str(SF))
    cur = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert {f.name: kind(f.dataType.simpleString()).replace("bigint", "long") for f in df.schema} == {d[0]: kind(d[1]) for d in cur.description}
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


def test_every_query_has_sql():
    queries, oracles = registry()
    assert set(oracles) == set(queries)
    assert set(queries) <= set(entry.queries())


def test_lines_meet_their_sheets_without_a_shuffle(spark, tmp_path):
    """Lines of one status are a large share of all, so a shuffle by it leaves a few tasks with all rows."""
    from workloads import jobs

    rows = "cast(id as bigint) AS l_orderkey, id AS l_partkey, id AS l_suppkey, 1 AS l_linenumber, 1.5d AS l_quantity, 10.25d AS l_extendedprice"
    more = "substr('ANR', cast(id % 3 + 1 as int), 1) AS l_returnflag, 'O' AS l_linestatus, timestamp_ntz'2024-05-06' AS l_shipdate"
    spark.sql(f"SELECT {rows}, {more} FROM range(30)").write.parquet(str(tmp_path / "lineitem.parquet"))
    sheets = jobs.sheets(spark, str(tmp_path))
    assert sheets.count() == 39
    plan = sheets._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(l_returnflag" not in plan
