import sys
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cellweave.llm import queries
from helpers_llm import documents, lines_by_hand, odd_documents, write_table
from test_fertility import base_by_hand
from test_packing import checked
from test_simhash import fingerprint_by_hand, groups_by_hand
from tools.check import kind, rows_of

SF = Path("/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(folder, rows):
    columns = list(zip(*[(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], strict=True)) if rows else [[]] * 5
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
    write_table(folder, "documents", pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=COLUMNS))


def prose(i):
    words = "stone river market winter letter garden silver window story ocean paper mountain bridge forest candle".split()
    lines = [" ".join(f"the {words[(i * 5 + j * k) % 15]} {words[(i + 3 * j + k) % 15]} {i * 31 + j * k}" for k in range(1, 8)) for j in range(6)]
    return "\n".join([*lines, "All rights to this text are held by the owner of the page."])


def stages_by_hand(rows):
    import cellweave.llm.fertility as fertility

    measurer = fertility.Measurer(queries.FERTILITY)
    rows = [r for r in rows if not base_by_hand(r[1])[5] and fertility._judged(measurer, queries.BANDS, r[0], r[1], "en")[7]]
    rows = [(i, t) for i, _, _, t in lines_by_hand(rows)]
    groups = groups_by_hand(rows, [fingerprint_by_hand(t) for _, t in rows])
    return [r for r, (doc_id, _, least) in zip(rows, groups, strict=True) if doc_id == least]


def test_whole_pipeline_against_plain_stages(spark, tmp_path):
    near = prose(3).replace("the river", "the brook", 1)
    rows = [r for r in odd_documents() if r[0] is not None] + [(200 + i, prose(i)) for i in range(12)]
    rows += [(300, prose(3)), (301, near), (302, prose(4) + " and one more word"), (303, "%%% $$$ " * 60)]
    corpus(tmp_path, rows)
    kept = stages_by_hand(rows)
    assert 5 < len(kept) < 14
    checked(corpus_pipeline.run(spark, str(tmp_path)).collect(), kept)


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    corpus(tmp_path, [(i, prose(i)) for i in range(5)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 4
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS


def test_empty_table(spark, tmp_path):
    corpus(tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not SF.exists(), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for p in SF.glob("*.parquet"):
        db.execute(f"create view {p.stem} as select * from '{p}'")
    df = entry.queries()[name](spark, str(SF))
    cur = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    found = {f.name: kind(f.dataType.simpleString()).replace("bigint", "long") for f in df.schema}
    assert found == {d[0]: kind(d[1]) for d in cur.description}
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_entry_works_without_the_package(monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("cellweave.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "cellweave.llm.queries", None)
    assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
