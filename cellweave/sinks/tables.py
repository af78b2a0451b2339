"""Write typed tables: to the Spark catalog or to a database.

A sink with ``adopt`` takes files that are written already, by moving them; ``hand_over`` writes for one that has none or cannot.
``load_id`` names a load. These sinks do not use it, so a load that is repeated is written again; ``published`` has one that does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cellweave.session import can_move, move

BATCH_SIZE = 1000


def can_adopt(sink, spark: SparkSession, folder: str) -> bool:
    """Whether a sink takes files of a folder, or of folders in it, as they are."""
    return bool(getattr(sink, "can_adopt", None) and sink.can_adopt(spark, folder))


def hand_over(
    sink, spark: SparkSession, folder: str, schema: StructType, table: str, sql_types: dict[str, str], load_id: str, adopts: bool
) -> int | None:
    """Give a sink the Parquet files of a table, as they are if it ``adopts`` them. The folder is not to be used afterwards. Returns what ``write`` does."""
    if adopts:
        return sink.adopt(spark, folder, schema, table, load_id)
    return sink.write(spark.read.schema(schema).parquet(folder), table, sql_types, load_id)


def column_list(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


@dataclass(frozen=True)
class TableSink:
    """Catalog tables. ``overwrite`` drops and recreates, so the schema may change between loads."""

    schema: str | None = None
    mode: str = "overwrite"
    format: str = "parquet"
    root: str | None = None  # keep the files under this folder instead of the warehouse

    def name(self, table: str) -> str:
        return f"`{self.schema}`.`{table}`" if self.schema else f"`{table}`"

    def can_adopt(self, spark: SparkSession, folder: str) -> bool:
        if (self.mode, self.format) != ("overwrite", "parquet"):
            return False
        home = self.root or spark.catalog.getDatabase(self.schema or spark.catalog.currentDatabase()).locationUri
        return can_move(spark, folder, home)

    def adopt(self, spark: SparkSession, folder: str, schema: StructType, table: str, load_id: str | None = None) -> None:
        name, place = self.name(table), f" LOCATION '{self.root}/{table}'" if self.root else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({column_list(schema)}) USING parquet{place}")
        home = next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location")
        move(spark, folder, home, replace=True)
        spark.catalog.refreshTable(name)

    def write(self, df: DataFrame, table: str, sql_types: dict[str, str] | None = None, load_id: str | None = None) -> None:
        name = self.name(table)
        writer = df.write.mode(self.mode).format(self.format)
        if self.root:
            writer = writer.option("path", f"{self.root}/{table}")
        writer.saveAsTable(name)


@dataclass(frozen=True)
class FolderSink:
    """One folder per table, for clusters without a catalog."""

    root: str
    mode: str = "overwrite"

    def write(self, df: DataFrame, table: str, sql_types: dict[str, str] | None = None, load_id: str | None = None) -> None:
        df.write.mode(self.mode).parquet(f"{self.root}/{table}")

    def can_adopt(self, spark: SparkSession, folder: str) -> bool:
        return self.mode in ("overwrite", "append") and can_move(spark, folder, self.root)

    def adopt(self, spark: SparkSession, folder: str, schema: StructType, table: str, load_id: str | None = None) -> None:
        move(spark, folder, f"{self.root}/{table}", replace=self.mode == "overwrite")


@dataclass(frozen=True)
class JdbcSink:
    """Database tables with explicit column types, written in batches by every task.

    ``options`` holds driver, user and password; ``write_partitions`` bounds the connections.
    """

    url: str
    schema: str = "public"
    mode: str = "overwrite"
    write_partitions: int = 8
    options: dict[str, str] = field(default_factory=dict)

    def writer_options(self, table: str, sql_types: dict[str, str]) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": f"{self.schema}.{table}",
            "batchsize": str(BATCH_SIZE),
            "numPartitions": str(self.write_partitions),
            **({"createTableColumnTypes": column_types(sql_types)} if column_types(sql_types) else {}),
            **self.options,
        }

    def definition(self, df: DataFrame, sql_types: dict[str, str] | None = None) -> str:
        """Columns of the table a load creates, as Spark's dialect of the database writes them. Opens no connection."""
        jvm = df.sparkSession._jvm
        dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        own = jvm.scala.Option.apply(column_types(sql_types or {}) or None)
        return jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.schemaString(dialect, df._jdf.schema(), False, own)

    def write(self, df: DataFrame, table: str, sql_types: dict[str, str] | None = None, load_id: str | None = None) -> None:
        options = self.writer_options(table, sql_types or {})
        df.write.format("jdbc").mode(self.mode).options(**options).save()


def column_types(sql_types: dict[str, str]) -> str:
    """Column definitions for ``createTableColumnTypes``: the integers that are narrower than a long.

    Spark parses these types itself and knows neither TEXT nor DOUBLE PRECISION nor a timestamp with zone; for all of them
    the dialect's own type for the column is the one wanted.
    """
    return ", ".join(f"`{name}` {kind}" for name, kind in sql_types.items() if kind == "INTEGER")
