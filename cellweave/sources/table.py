"""Any Spark table as a grid of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.text import na_to_null


def _texts(df: DataFrame, columns: list[str]) -> list[Column]:
    return [na_to_null(F.col(f"`{c}`").cast("string")).alias(c) for c in columns]


def table_rows(
    df: DataFrame, columns: list[str], path: Column, sheet: Column, sheet_idx: Column, row_idx: Column
) -> DataFrame:
    """Grid rows of a table."""
    return df.select(
        path.alias("path"),
        sheet.alias("sheet"),
        sheet_idx.cast("int").alias("sheet_idx"),
        row_idx.cast("long").alias("row_idx"),
        F.array(*_texts(df, columns)).alias("values"),
    )


def table_cells(df: DataFrame, columns: list[str], row_idx: Column) -> DataFrame:
    """Cells of a table: (row_idx, name, value)."""
    texts = df.select(row_idx.cast("long").alias("row_idx"), *_texts(df, columns))
    return texts.unpivot(["row_idx"], columns, "name", "value")
