"""Delimited files as headerless grid rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cellweave.functions.text import na_to_null
from cellweave.sources.quoted import read_quoted


def read_delimited(
    spark: SparkSession, paths: list[str] | str, separator: str = ",", line_breaks: bool = False
) -> DataFrame:
    """Grid rows of delimited files; every column is text.

    The number of columns is bounded by a first pass which counts separators per line, since titles
    above the header would make Spark guess too few columns and drop the rest.

    ``row_idx`` is the start of the file's block plus the record's position: a record takes at least
    one byte, so it grows along the file. It is not dense.

    With ``line_breaks`` quoted values may hold line breaks (``quoted``); every quote in the file then has to be one of a pair.
    """
    if line_breaks:
        return read_quoted(spark, paths, separator)
    lines = spark.read.text(paths)
    widest = lines.agg(F.max(F.length("value") - F.length(F.replace("value", F.lit(separator), F.lit("")))))
    n_cols = (widest.first()[0] or 0) + 1
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(n_cols)])
    table = spark.read.csv(paths, schema=schema, sep=separator, header=False, escape='"')
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    path = F.col("_metadata.file_path")
    return table.select(
        path.alias("path"),
        F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1).alias("sheet"),
        F.lit(0).alias("sheet_idx"),
        (F.col("_metadata.file_block_start") + in_partition).alias("row_idx"),
        F.array(*[na_to_null(F.col(f"c{i}")) for i in range(n_cols)]).alias("values"),
    )
