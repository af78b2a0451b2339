import hashlib
import random

import pytest

from cellweave.llm import lines
from helpers_llm import documents, lines_by_hand, odd_documents


def shared_lines(n, seed=2):
    choose = random.Random(seed)
    common = [f"A passage number {i} that some documents have" for i in range(30)] + ["short line", "", "  "]
    return [
        (i, "\n".join(choose.choice(common) + choose.choice(["", "", " ", "\t", "!"]) for _ in range(choose.randint(0, 12))))
        for i in range(n)
    ]


@pytest.mark.parametrize("rows", [odd_documents(), shared_lines(60)], ids=["odd", "shared"])
@pytest.mark.parametrize("batches", [1, 3, 6])
def test_against_plain_version(spark, rows, batches):
    result = lines.describe(documents(spark, rows), batches=batches)
    assert result.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    wanted = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in lines_by_hand(rows)]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(wanted, key=repr)


def test_cleaned_documents_keep_their_columns(spark):
    rows = shared_lines(50, 5) + [(100, None)]
    table = documents(spark, rows)
    cleaned = lines.cleaned(table)
    assert cleaned.columns == table.columns and cleaned.dtypes == table.dtypes
    by_id = {i: t for i, _, _, t in lines_by_hand(rows)}
    for row in cleaned.collect():
        assert (row.text or "") == by_id[row.doc_id]
        assert row.n_chars == (None if row.text is None else len(row.text))


def test_empty_table_and_no_leftover_tables(spark):
    assert lines.describe(documents(spark, [])).count() == 0
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")] == []


def test_settled_hashes_are_not_added_again(spark):
    rows = [(i, "The very same line in all the documents") for i in range(12)]
    runs = lines.Runs(spark, 3)
    sizes = []
    for batch in lines.batches_of(documents(spark, rows).select("doc_id", "text"), 4):
        runs.add(lines.sightings(batch, 20))
        sizes.append([spark.table(r.name).count() for r in runs.runs])
    assert sizes == [[1], [1], [1, 0], [1]]
    assert [(r.keeper) for r in runs.repeated().collect()] == [11]


def test_no_python_in_the_plan(spark):
    plan = lines.describe(documents(spark, shared_lines(20)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
