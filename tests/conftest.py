import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cellweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    return local_session(
        4,
        **{
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.sql.shuffle.partitions": "4",
        },
    )


@pytest.fixture
def column(spark):
    """Values of one expression over a list of texts."""

    def run(values, expression, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, c {kind}").coalesce(1)
        return [r.x for r in df.select("i", expression(F.col("c")).alias("x")).orderBy("i").collect()]

    return run


@pytest.fixture
def grid(spark):
    """Grid rows from {sheet: rows}."""

    def run(sheets, path="/depot/classeur.xlsx"):
        rows = [
            (path, name, i, r, list(values))
            for i, (name, body) in enumerate(sheets.items())
            for r, values in enumerate(body)
        ]
        from cellweave.operators.shape import ROWS

        return spark.createDataFrame(rows, ROWS).repartition(3)

    return run
