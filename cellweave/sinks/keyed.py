"""A catalog table with one row for each key, kept over loads.

Rows lie in buckets of their key, sorted by it, so a load is merged bucket by bucket: its own rows, few against those stored, are
dealt to the buckets, and the stored ones are read where they lie and not shuffled. Of several rows of a key the first by
``order`` stays, whichever load brought it; so loads one after another leave what one load of all their rows would.

A load writes the next version of the table and then replaces the view readers see, in one change of the catalog. The
version before stays for those who are reading it. A load that is repeated under the number of the version it made adds nothing.

Null keys are one key. Rows that tie in ``order`` are told apart by all their columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.dedupe import first_per_key
from cellweave.session import remove

# The key as one text that is never null, for buckets and joins.
KEY = "__key"


@dataclass(frozen=True)
class KeyedTable:
    """``order`` lists the columns rows of a key are compared by, smallest first. Too few buckets make large sorts, too many small files."""

    name: str
    root: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int = 64

    def version(self, spark: SparkSession) -> int:
        """Number of the version readers see, 0 if there is none."""
        if not spark.catalog.tableExists(self.name):
            return 0
        return int(next(r.value for r in spark.sql(f"SHOW TBLPROPERTIES `{self.name}`").collect() if r.key == "version"))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"`{self.name}`")

    def merged(self, rows: DataFrame) -> DataFrame:
        """What the table holds once the rows are loaded, by bucket."""
        spark, version = rows.sparkSession, self.version(rows.sparkSession)
        order = [*[F.col(c).asc_nulls_first() for c in self.order], *[F.col(c).asc_nulls_first() for c in rows.columns if c not in self.order]]
        fresh = first_per_key(rows.withColumn(KEY, self._key()), [KEY], order).repartition(self.buckets, KEY)
        if not version:
            return fresh
        stored = spark.table(f"`{self._table(version)}`")
        if sorted(stored.dtypes) != sorted(fresh.dtypes):
            raise ValueError(f"{self.name}: columns {fresh.dtypes} do not fit {stored.dtypes}")
        columns = rows.columns
        both = stored.select(KEY, F.struct(*columns).alias("_old")).join(fresh.select(KEY, F.struct(*columns).alias("_new")), KEY, "full")
        by = [*self.order, *[c for c in columns if c not in self.order]]
        rank = {side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in by]) for side in ("_old", "_new")}
        # Structs compare field by field, null first, like the order above.
        stays = F.col("_new").isNull() | (F.col("_old").isNotNull() & (rank["_old"] <= rank["_new"]))
        return both.select(KEY, F.when(stays, F.col("_old")).otherwise(F.col("_new")).alias("_row")).select(KEY, "_row.*")

    def upsert(self, rows: DataFrame, number: int | None = None) -> int:
        """Load the rows; the table's version afterwards. ``number`` names the load, counted from 1; one the table has is not repeated."""
        spark, before = rows.sparkSession, self.version(rows.sparkSession)
        if number is not None and number <= before:
            return before
        if number is not None and number != before + 1:
            raise ValueError(f"{self.name}: load {number} cannot follow load {before}")
        after = before + 1
        table = self._table(after)
        writer = self.merged(rows).write.format("parquet").mode("overwrite").bucketBy(self.buckets, KEY).sortBy(KEY)
        writer.option("path", f"{self.root.rstrip('/')}/{self.name}/{after}").saveAsTable(table)
        columns = ", ".join(f"`{c}`" for c in rows.columns)
        spark.sql(f"CREATE OR REPLACE VIEW `{self.name}` TBLPROPERTIES ('version' = '{after}') AS SELECT {columns} FROM `{table}`")
        if after > 2:
            old = self._table(after - 2)
            spark.sql(f"DROP TABLE IF EXISTS `{old}`")
            remove(spark, f"{self.root.rstrip('/')}/{self.name}/{after - 2}")
        return after

    def _table(self, version: int) -> str:
        return f"{self.name}_v{version}"

    def _key(self) -> Column:
        """JSON writes no field that is null, so a null differs from every text."""
        return F.to_json(F.struct(*self.keys))
