"""Deduplication, samples and numbering that stay whole and balanced under hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key; null keys are one key.

    The rank filter runs per task before the shuffle, so a hot key sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def dedupe_labels(df: DataFrame, position: list[str]) -> DataFrame:
    """One row per ``libelle``, rows with a category first, then by position."""
    order = [F.col(c).asc() for c in position]
    if "categorie" in df.columns:
        order.insert(0, F.coalesce(F.length("categorie") > 0, F.lit(False)).desc())
    return first_per_key(df, ["libelle"], order)


def sample_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first rows, for a report."""
    return df.orderBy(*order).limit(n)


def number_within(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Row number within ``keys``, spread over buckets.

    ``bucket`` must not decrease along ``order``. Rows are numbered inside (keys, bucket) and
    shifted by the rows of earlier buckets, so a hot key is split over as many tasks as buckets.
    """
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_bucket", bucket)
    shifts = (
        df.groupBy(*keys, "_bucket")
        .count()
        .withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_bucket").alias("_b"), "_before")
    )
    same = F.col("_bucket").eqNullSafe(F.col("_b"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    numbered = df.withColumn("_inside", F.row_number().over(inside))
    return (
        numbered.join(shifts, same)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_b", "_before", "_inside", *[f"_{k}" for k in keys])
    )
