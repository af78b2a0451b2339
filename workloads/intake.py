"""Sources (S) and sinks (K)."""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cellweave.operators import decide
from cellweave.plans import rules as R
from cellweave.session import new_folder, settle, tune
from cellweave.sinks.published import PublishedSink
from cellweave.sinks.tables import JdbcSink, TableSink
from cellweave.sources.delimited import read_delimited
from cellweave.sources.listing import list_arrivals
from cellweave.sources.quoted import read_quoted
from cellweave.sources.workbook import decode_sheets, open_workbooks
from cellweave.sources.workbook_source import scan_workbooks
from workloads import columns
from workloads.base import derive, plain_sql, scan
from workloads.books import workbook

QUERIES, SQL = {}, {}
c = F.col

BOOK_ORDERS = 2000


def _write_book(pdf: pd.DataFrame) -> pd.DataFrame:
    """A workbook of one key range of orders, one sheet per status."""
    sheets = {
        status: [
            [int(o.o_orderkey), float(o.o_totalprice), o.o_orderdate.to_pydatetime(), None, o.o_orderpriority, o.o_totalprice > 250000]
            for o in group.sort_values("o_orderkey").itertuples()
        ]
        for status, group in pdf.groupby("o_orderstatus")
    }
    book = int(pdf["book"].iloc[0])
    return pd.DataFrame({"path": [f"/depot/commandes_{book}.xlsx"], "content": [workbook(sheets)]})


def books(spark, sf):
    """Workbooks made of ranges of order keys: a range holds at most BOOK_ORDERS orders."""
    orders = scan(spark, sf, "orders").withColumn("book", F.floor(c("o_orderkey") / BOOK_ORDERS))
    return orders.groupBy("book").applyInPandas(_write_book, "path string, content binary")


_NUMBER = "case when o_totalprice = floor(o_totalprice) then cast(cast(o_totalprice as bigint) as string) else cast(o_totalprice as string) end"
BOOKS_SQL = (
    "SELECT '/depot/commandes_' || cast(floor(o_orderkey / 2000) as bigint) || '.xlsx' AS path, o_orderstatus AS sheet, "
    "cast(dense_rank() OVER (PARTITION BY floor(o_orderkey / 2000) ORDER BY o_orderstatus) - 1 as int) AS sheet_idx, "
    "row_number() OVER (PARTITION BY floor(o_orderkey / 2000), o_orderstatus ORDER BY o_orderkey) - 1 AS row_idx, "
    f"cast(o_orderkey as string) AS c0, {_NUMBER} AS c1, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS c2, "
    "cast(null as string) AS c3, o_orderpriority AS c4, case when o_totalprice > 250000 then 'True' else 'False' end AS c5 FROM orders"
)


def _wide(rows):
    return rows.select("path", "sheet", "sheet_idx", "row_idx", *[c("values")[i].alias(f"c{i}") for i in range(6)])


def s01(spark, sf):
    return _wide(decode_sheets(open_workbooks(books(spark, sf))))


def s02(spark, sf):
    return _wide(decode_sheets(open_workbooks(books(spark, sf), first_only=True)))


QUERIES["s01_workbook_sheets"] = s01
SQL["s01_workbook_sheets"] = BOOKS_SQL
QUERIES["s02_first_sheet"] = s02
SQL["s02_first_sheet"] = f"SELECT * FROM ({BOOKS_SQL}) WHERE sheet_idx = 0"


def _saved(folder: str):
    def save(batches):
        system, root = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        system.create_dir(root)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with system.open_output_stream(f"{root}/{path.rpartition('/')[2]}") as out:
                    out.write(content)
            yield batch[["path"]]

    return save


def book_files(spark, sf):
    """A folder of the workbooks as files."""
    folder = new_folder(tune(spark), "books")
    settle(books(spark, sf).mapInPandas(_saved(folder), "path string"))
    return folder


def _placed(rows):
    """Rows of files under the path their workbook was made for."""
    return _wide(rows.withColumn("path", F.concat(F.lit("/depot/"), F.regexp_extract("path", "[^/]*$", 0))))


def s01b(spark, sf):
    return _placed(scan_workbooks(spark, book_files(spark, sf)))


def s02b(spark, sf):
    """The source is told of the sheet and of the last row, so neither other sheets nor later rows are unpacked."""
    return _placed(scan_workbooks(spark, book_files(spark, sf), sheets=[0], below=61))


def s02c(spark, sf):
    """What a header search looks at: the first rows of each sheet."""
    return _placed(scan_workbooks(spark, book_files(spark, sf), head=30))


QUERIES["s01b_workbook_source"] = s01b
SQL["s01b_workbook_source"] = BOOKS_SQL
QUERIES["s02b_one_sheet_to_a_row"] = s02b
SQL["s02b_one_sheet_to_a_row"] = f"SELECT * FROM ({BOOKS_SQL}) WHERE sheet_idx = 0 AND row_idx < 61"
QUERIES["s02c_sheet_heads"] = s02c
SQL["s02c_sheet_heads"] = f"SELECT * FROM ({BOOKS_SQL}) WHERE row_idx < 30"

# A title line, then records with separators and quotes inside.
PARTS = (
    "SELECT cast(p_partkey as string) AS c0, p_name || ', \"' || p_type || '\"' AS c1, cast(p_retailprice as string) AS c2, "
    "case when p_size % 5 = 0 then 'N/A' else cast(p_size as string) end AS c3 FROM {part}"
)


def s03(spark, sf):
    folder = new_folder(tune(spark), "delimited")
    derive(spark, sf, PARTS).write.option("escape", '"').option("sep", ";").csv(folder)
    rows = read_delimited(spark, folder, ";")
    return rows.select(*[c("values")[i].alias(f"c{i}") for i in range(4)])


QUERIES["s03_delimited_files"] = s03
SQL["s03_delimited_files"] = f"SELECT c0, c1, c2, nullif(c3, 'N/A') AS c3 FROM ({plain_sql(PARTS)})"


# Values with line breaks, quotes and separators.
NOTES = (
    "SELECT cast(c_custkey as string) AS c0, c_name || chr(10) || '\"' || c_mktsegment || '\";' || chr(13) || chr(10) AS c1, "
    "case when c_custkey % 3 = 0 then 'N/A' else cast(c_nationkey as string) || ';' || chr(10) end AS c2, cast(c_acctbal as string) AS c3 FROM {customer}"
)


def s03b(spark, sf):
    """Files of many small ranges, whose records hold line breaks."""
    folder = new_folder(tune(spark), "delimited")
    derive(spark, sf, NOTES).write.option("escape", '"').option("sep", ";").option("ignoreTrailingWhiteSpace", "false").csv(folder)
    rows = read_quoted(spark, folder, ";", range_bytes=16 << 10)
    return rows.select(*[c("values")[i].alias(f"c{i}") for i in range(4)])


QUERIES["s03b_line_breaks_in_values"] = s03b
SQL["s03b_line_breaks_in_values"] = f"SELECT c0, c1, nullif(c2, 'N/A') AS c2, c3 FROM ({plain_sql(NOTES)})"


def s06(spark, sf):
    """List one folder per document source; each holds one file."""
    folder = new_folder(tune(spark), "arrivals")
    docs = scan(spark, sf, "documents").groupBy("source").agg(F.count("doc_id").alias("n"))
    docs.repartition("source").write.partitionBy("source").parquet(folder)
    sources = [r.source for r in docs.select("source").distinct().toLocalIterator()]
    found = list_arrivals(spark, [f"{folder}/source={s}" for s in sources])
    files = found.filter((c("length") > 0) & (c("ext") == ".parquet"))
    return files.groupBy(F.regexp_extract("parent", "source=(.*)$", 1).alias("source")).agg(F.count(F.lit(1)).alias("n_files"))


QUERIES["s06_folder_listing"] = s06
SQL["s06_folder_listing"] = "SELECT source, cast(1 as bigint) AS n_files FROM documents GROUP BY source"


# --- sinks ------------------------------------------------------------------------------------------------

def _table(spark) -> tuple[str, str]:
    return new_folder(tune(spark), "tables"), f"cellweave_{uuid.uuid4().hex[:12]}"


def k01(spark, sf):
    """A second load replaces the first, with another schema."""
    root, name = _table(spark)
    orders = scan(spark, sf, "orders")
    sink = TableSink(mode="overwrite", root=root)
    sink.write(orders.select("o_orderkey", "o_orderdate"), name)
    sink.write(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), name)
    return spark.table(name)


def k02(spark, sf):
    root, name = _table(spark)
    orders = scan(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    sink = TableSink(mode="append", root=root)
    sink.write(orders.filter("o_totalprice < 200000"), name)
    sink.write(orders.filter("o_totalprice >= 200000"), name)
    return spark.table(name)


def k03(spark, sf):
    """Column definitions a database load would use. No database is opened here."""
    decided = columns.QUERIES["t03_decide_rpa"](spark, sf).collect()  # a row for each column of a table
    kinds = decide.sql_types(R.RPA)
    empty = spark.createDataFrame([], StructType([StructField(r.name, decide.SPARK_TYPES[r.tag]) for r in decided]))
    made = JdbcSink("jdbc:postgresql://unused/db").definition(empty, {r.name: kinds[r.tag] for r in decided})
    rows = [(re.match('"([^"]*)"', d.strip()).group(1), d.strip()) for d in made.split(" , ")]
    return spark.createDataFrame(rows, "name string, definition string")


def k01b(spark, sf):
    """Loads that replace each other, some of them repeated: the last new one is what is seen."""
    root, name = _table(spark)
    orders, sink = scan(spark, sf, "orders"), PublishedSink(root, mode="overwrite")
    first, second = orders.select("o_orderkey", "o_orderdate"), orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    for load_id, load in (("a", first), ("a", first), ("b", second), ("b", first)):
        sink.write(load, name, load_id=load_id)
    return spark.table(name)


def k02b(spark, sf):
    """Loads that add rows, each of them repeated, the second with another column: every row is there once."""
    root, name = _table(spark)
    orders, sink = scan(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), PublishedSink(root)
    low, high = orders.filter("o_totalprice < 200000").drop("o_orderstatus"), orders.filter("o_totalprice >= 200000")
    for load_id, load in (("low", low), ("low", low), ("high", high), ("low", low), ("high", high)):
        sink.write(load, name, load_id=load_id)
    return spark.table(name)


QUERIES["k01b_published_replace"] = k01b
SQL["k01b_published_replace"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
QUERIES["k02b_published_append"] = k02b
SQL["k02b_published_append"] = (
    "SELECT o_orderkey, o_totalprice, case when o_totalprice >= 200000 then o_orderstatus end AS o_orderstatus, "
    "case when o_totalprice >= 200000 then 'high' else 'low' end AS load_id FROM orders"
)
QUERIES["k01_replace_table"] = k01
SQL["k01_replace_table"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
QUERIES["k02_append_table"] = k02
SQL["k02_append_table"] = "SELECT o_orderkey, o_totalprice FROM orders"
QUERIES["k03_database_columns"] = k03
SQL["k03_database_columns"] = (
    "SELECT name, '\"' || name || '\" ' || case tag when 'DATE' then 'DATE' when 'DATETIME' then 'TIMESTAMP' "
    "when 'INT' then 'INTEGER' when 'FLOAT' then 'FLOAT8' when 'BOOL' then 'BOOLEAN' else 'TEXT' end AS definition "
    f"FROM ({columns.SQL['t03_decide_rpa']})"
)
