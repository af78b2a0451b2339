"""Runs (P8) over files that are really written, listed, gated, loaded and recorded."""

from __future__ import annotations

import pandas as pd
from pyarrow import fs
from pyspark.sql import Window
from pyspark.sql import functions as F

from cellweave.functions import numbers
from cellweave.operators import audit, gate, shape
from cellweave.plans.runner import run_once
from cellweave.session import new_folder, settle, tune
from cellweave.sinks import outcomes
from cellweave.sinks.tables import FolderSink
from workloads.base import scan
from workloads.books import workbook

QUERIES, SQL = {}, {}
c = F.col

HEADER = ["Code projet", "Client", "Nom", "Trigramme", "Montant budget"]
# Customers of the first five nations are workbooks of a dataset, one for each range of keys; the other files go wrong in a way each.
BOOK_CUSTOMERS = 1000
LISTED = ("FQT", "FNP", "SPA", "RPA", "PAAE")
NAMES = {5: "conditions.xlsx", 6: "clients.csv", 7: "~$suivi.xlsx", 8: "vide.xlsx"}


def _write_file(folder: str):
    def write(part: pd.DataFrame) -> pd.DataFrame:
        nation, book = int(part["c_nationkey"].iloc[0]), int(part["book"].iloc[0])
        name = f"suivi_{nation}_{book}.xlsx" if nation < len(LISTED) else NAMES.get(nation, f"autre_{nation}.xlsx")
        part = part.sort_values("c_custkey")
        rows = [[f"P{r.c_custkey}", r.c_name, r.c_mktsegment, "abc", 100_000 + int(r.c_custkey)] for r in part.itertuples()]
        content = workbook({"Clients": [HEADER, *rows]})
        content = {5: b"pas un classeur", 8: b""}.get(nation, content)
        system, root = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        system.create_dir(root)
        with system.open_output_stream(f"{root}/{name}") as out:
            out.write(content)
        return pd.DataFrame({"nation": [nation], "book": [book], "name": [name], "length": [len(content)]})

    return write


def depot(spark, sf):
    """A folder of files made of the customers of each nation; a file holds a bounded range of their keys. And the files' names."""
    folder = new_folder(tune(spark), "depot")
    customers = scan(spark, sf, "customer")
    # Of the nations that are no workbook of a dataset a file has to be there, not its rows.
    book = F.when(c("c_nationkey") < len(LISTED), F.floor(c("c_custkey") / BOOK_CUSTOMERS))
    few = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    other = customers.filter(c("c_nationkey") >= len(LISTED)).withColumn("nth", F.row_number().over(few)).filter("nth <= 5").drop("nth")
    files = customers.filter(c("c_nationkey") < len(LISTED)).unionByName(other).withColumn("book", F.coalesce(book, F.lit(0)))
    kinds = "nation int, book int, name string, length long"
    return folder, files.groupBy("c_nationkey", "book").applyInPandas(_write_file(folder), kinds)


def outcomes_of(spark, sf):
    """Run over the folder and read the stored outcomes."""
    folder, written = depot(spark, sf)
    keys = F.create_map(*[F.lit(x) for i, k in enumerate((*LISTED, "CDP", "CATCLIENTS")) for x in (i, f"FILE_PATH_{k}")])
    settings = settle(written).select(F.try_element_at(keys, c("nation")).alias("env_key"), F.concat(F.lit(f"{folder}/"), "name").alias("path"))
    contract = gate.make_contract(settings.filter("env_key is not null"))
    sink, store = FolderSink(new_folder(spark, "tables")), new_folder(spark, "outcomes")
    run_once(spark, contract, sink, audit.Run(user="loader"), grace=0.0, store=store)
    return outcomes.read(spark, store).withColumn("name", F.regexp_extract("path", "[^/]*$", 0))


def p08(spark, sf):
    return outcomes_of(spark, sf).select("name", "dataset", "status", "reason", "rows")


def g14(spark, sf):
    records = outcomes_of(spark, sf).filter(c("status") == gate.LOADED)
    return records.select("name", (c("duration_s") > 0).alias("timed"))


_NAME = (
    "case when c_nationkey < 5 then 'suivi_' || c_nationkey || '_' || book || '.xlsx' "
    + " ".join(f"when c_nationkey = {k} then '{n}'" for k, n in NAMES.items())
    + " else 'autre_' || c_nationkey || '.xlsx' end"
)
_FILES = f"(SELECT c_nationkey, case when c_nationkey < 5 then c_custkey // {BOOK_CUSTOMERS} end AS book FROM customer)"
_SET = "case c_nationkey " + " ".join(f"when {i} then '{k.lower()}'" for i, k in enumerate((*LISTED, "CDP", "CATCLIENTS"))) + " end"
QUERIES["p08_run_outcomes"] = p08
SQL["p08_run_outcomes"] = (
    f"SELECT {_NAME} AS name, {_SET} AS dataset, case when c_nationkey < 5 then 'Loaded' else 'Rejects' end AS status, "
    "case when c_nationkey < 5 then null when c_nationkey = 5 then 'ETL failed: ValueError: BadZipFile: File is not a zip file' "
    f"when c_nationkey = 6 then '{gate.BAD_EXTENSION}.csv' when c_nationkey = 7 then '{gate.TEMP_OR_HIDDEN}' "
    f"when c_nationkey = 8 then '{gate.EMPTY}' else '{gate.UNLISTED}' end AS reason, "
    f"case when c_nationkey < 5 then count(*) end AS rows FROM {_FILES} GROUP BY c_nationkey, book"
)
QUERIES["g14_durations"] = g14
SQL["g14_durations"] = f"SELECT DISTINCT {_NAME} AS name, true AS timed FROM {_FILES} WHERE c_nationkey < 5"


def n13b(spark, sf):
    """Sheets of many files whose table names collide."""
    sheets = scan(spark, sf, "customer").select(
        F.concat(F.lit("/depot/"), c("c_nationkey").cast("string"), F.lit("/releve.xlsx")).alias("path"),
        c("c_custkey").alias("sheet_idx"),
        F.concat(F.lit("releve__feuille_"), (c("c_custkey") % 7).cast("string")).alias("table"),
    )
    return shape.unique_tables(sheets)


QUERIES["n13b_table_names_collide"] = n13b
SQL["n13b_table_names_collide"] = (
    "WITH s AS (SELECT '/depot/' || c_nationkey || '/releve.xlsx' AS path, c_custkey AS sheet_idx, 'releve__feuille_' || c_custkey % 7 AS t FROM customer), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY path, sheet_idx) AS i FROM s) "
    "SELECT path, sheet_idx, t || case when i > 1 then '__' || i else '' end AS \"table\" FROM n"
)


def c02(spark, sf):
    """Integers of 19 digits, beyond what a double holds."""
    digits = (F.lit(1234567890000000000) + c("o_orderkey")).cast("string")
    texts = F.when(c("o_orderkey") % 2 == 0, F.concat(F.lit("+"), digits)).otherwise(digits)
    return scan(spark, sf, "orders").select("o_orderkey", numbers.integer_like(texts, numbers.PLAIN_SPACES).alias("value"))


QUERIES["c02_long_integers"] = c02
SQL["c02_long_integers"] = "SELECT o_orderkey, 1234567890000000000 + o_orderkey AS value FROM orders"
