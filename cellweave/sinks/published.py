"""Catalog tables whose loads become visible at once, and only once.

A load writes its rows into a folder named by its id and then makes them visible by one change of the catalog. A load that broke before
this change has left nothing a reader sees, and is simply repeated. A load that is repeated after it finds its id and adds nothing.

``append``: the table has a partition for each load, and the change adds one. Columns may be added between loads, and a
column may lack; one that has another type than before is refused before anything is written.
``overwrite``: the table is a view of the last load's folder, and the change replaces it, so the schema may change. The folder of the
load before stays for those who are reading it; older ones are removed.

What is visible is what the catalog says, so it has to outlive the session where loads of several sessions meet.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cellweave.session import can_move, move, remove
from cellweave.sinks.tables import column_list
from cellweave.sources.listing import child_folders

LOAD = "load_id"


@dataclass(frozen=True)
class PublishedSink:
    root: str
    schema: str | None = None
    mode: str = "append"

    def name(self, table: str) -> str:
        return f"`{self.schema}`.`{table}`" if self.schema else f"`{table}`"

    def folder(self, table: str, load_id: str) -> str:
        return f"{self.root.rstrip('/')}/{table}/{LOAD}={load_id}"

    def write(self, df: DataFrame, table: str, sql_types: dict[str, str] | None = None, load_id: str | None = None) -> int | None:
        """Publish a load. Returns the rows of one that was published before and is left as it is, else None."""
        return self._publish(df.sparkSession, df.schema, table, load_id, lambda folder: df.write.mode("overwrite").parquet(folder))

    def can_adopt(self, spark: SparkSession, folder: str) -> bool:
        return can_move(spark, folder, self.root)

    def adopt(self, spark: SparkSession, folder: str, schema: StructType, table: str, load_id: str | None = None) -> int | None:
        """Publish files that are written already."""
        return self._publish(spark, schema, table, load_id, lambda place: move(spark, folder, place, replace=True))

    def _publish(self, spark: SparkSession, schema: StructType, table: str, load_id: str | None, save: Callable[[str], None]) -> int | None:
        if not load_id or not load_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a load needs an id of letters, digits, - and _, not {load_id!r}")
        folder = self.folder(table, load_id)
        if self.is_published(spark, table, load_id):
            return spark.read.parquet(folder).count()
        if self.mode == "append":
            self._append(spark, schema, table, load_id, folder, save)
        else:
            self._replace(spark, table, load_id, folder, save)
        return None

    def is_published(self, spark: SparkSession, table: str, load_id: str) -> bool:
        name = self.name(table)
        if not spark.catalog.tableExists(name):
            return False
        if self.mode == "append":
            return not spark.sql(f"SHOW PARTITIONS {name} PARTITION ({LOAD} = '{load_id}')").isEmpty()
        return self._current(spark, name) == load_id

    def _append(self, spark: SparkSession, schema: StructType, table: str, load_id: str, folder: str, save: Callable[[str], None]) -> None:
        name = self.name(table)
        columns = {f.name: f.dataType.simpleString() for f in schema}
        if spark.catalog.tableExists(name):
            held = {f.name: f.dataType.simpleString() for f in spark.table(name).schema if f.name != LOAD}
            other = [f"{c} is {held[c]}, not {kind}" for c, kind in columns.items() if held.get(c, kind) != kind]
            if other:
                raise ValueError(f"{table}: {'; '.join(other)}")
            save(folder)
            more = ", ".join(f"`{c}` {kind}" for c, kind in columns.items() if c not in held)
            if more:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({more})")
        else:
            save(folder)
            place = f"{self.root.rstrip('/')}/{table}"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({column_list(schema)}, {LOAD} string) USING parquet PARTITIONED BY ({LOAD}) LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({LOAD} = '{load_id}') LOCATION '{folder}'")
        spark.catalog.refreshTable(name)

    def _replace(self, spark: SparkSession, table: str, load_id: str, folder: str, save: Callable[[str], None]) -> None:
        name = self.name(table)
        save(folder)
        before = self._current(spark, name) if spark.catalog.tableExists(name) else None
        spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{LOAD}' = '{load_id}') AS SELECT * FROM parquet.`{folder}`")
        place = f"{self.root.rstrip('/')}/{table}"
        for old in child_folders(spark, place):
            if old not in (f"{LOAD}={load_id}", f"{LOAD}={before}"):
                remove(spark, f"{place}/{old}")

    @staticmethod
    def _current(spark: SparkSession, name: str) -> str | None:
        held = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        return held.get(LOAD)
