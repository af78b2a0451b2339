"""Column profiles that add up over loads, so that appended rows never make old ones be read again.

All statistics of a profile are sums over cells but one, whether all numbers are whole, which is a conjunction. A store keeps the profile
of every load, a row for each column; the profile of all loads is their sum, and types are decided from that. A column whose type
is no longer that of the stored values has to widen, to the narrowest type that holds both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.sources.listing import child_folders

# Of two different types the one that holds the values of both; of all other pairs that is text.
WIDER = {("INT", "FLOAT"): "FLOAT", ("DATE", "DATETIME"): "DATETIME"}


def add_profiles(profiles: DataFrame, by: list[str]) -> DataFrame:
    """The profile of several parts of the same columns, from the rows of all parts."""
    sums = [c for c in profiles.columns if c == "n" or c.startswith("n_")]
    others = [c for c in profiles.columns if c not in (*by, *sums, "all_integral")]
    # A part without numbers says nothing of whether they are whole.
    whole = F.coalesce(F.bool_and(F.when(F.col("n_number_like") > 0, F.col("all_integral"))), F.lit(False))
    return profiles.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in sums], whole.alias("all_integral"), *[F.min(c).alias(c) for c in others]
    )


def wider(stored: Column, decided: Column) -> Column:
    """The narrowest type for values of both types."""
    out = F.when(stored == decided, stored)
    for (narrow, wide), both in WIDER.items():
        out = out.when(((stored == narrow) & (decided == wide)) | ((stored == wide) & (decided == narrow)), F.lit(both))
    return out.otherwise(F.lit("STRING"))


def widening(stored: DataFrame, decided: DataFrame) -> DataFrame:
    """``name``, ``stored``, ``decided``, ``tag``, ``must_widen`` for the columns of either side (both have ``name`` and ``tag``).

    A column that is new has the decided type; one that is gone keeps its own.
    """
    old, new = stored.select("name", F.col("tag").alias("stored")), decided.select("name", F.col("tag").alias("decided"))
    both = wider(F.col("stored"), F.col("decided"))
    tag = F.when(F.col("stored").isNull(), F.col("decided")).when(F.col("decided").isNull(), F.col("stored")).otherwise(both)
    joined = old.join(new, "name", "full").withColumn("tag", tag)
    return joined.withColumn("must_widen", F.col("stored").isNotNull() & (F.col("stored") != F.col("tag")))


@dataclass(frozen=True)
class ProfileStore:
    """A folder with the profile of each load; a load that is added again replaces itself."""

    folder: str

    def add(self, profile: DataFrame, load_id: str) -> None:
        profile.write.mode("overwrite").parquet(f"{self.folder}/load_id={load_id}")

    def loads(self, spark: SparkSession) -> list[str]:
        return sorted(name.removeprefix("load_id=") for name in child_folders(spark, self.folder))

    def profile(self, spark: SparkSession, by: list[str]) -> DataFrame:
        """The profile of all loads."""
        return add_profiles(spark.read.parquet(self.folder).drop("load_id"), by)
