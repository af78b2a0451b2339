"""Grid shaping (N), samples and deduplication (D) on sheets made from the customer table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cellweave.functions import text
from cellweave.operators import dedupe, profile, shape
from cellweave.plans import ingest
from cellweave.plans import rules as R
from cellweave.session import new_folder
from cellweave.sinks.keyed import KeyedTable
from cellweave.sources.table import table_cells, table_rows
from workloads.columns import SQL_OUTCOME, sql_chain, sql_profile
from workloads.base import derive, french, plain_sql, q, scan, sql_fold, sql_has_any, sql_na, sql_snake, sql_trim

QUERIES, SQL = {}, {}
c = F.col

# One sheet per nation in one workbook per region: a title, an empty row, notes, a header with
# duplicate, accented, empty and numeric cells, then the customers. Column 4 is all null, column 5
# blanks and nulls, column 6 the text nan with blanks.
GRID = (
    "WITH sheets AS (SELECT n_nationkey, 'Suivi Région ' || cast(n_regionkey as string) || '.xlsx' AS path, "
    "'Feuille ' || n_name AS sheet FROM {nation}), "
    "grid AS ("
    "SELECT path, sheet, n_nationkey AS sheet_idx, cast(0 as bigint) AS row_idx, "
    "ARR('Portefeuille', sheet, null, null, null, null, null, null, null) AS vals FROM sheets UNION ALL "
    "SELECT path, sheet, n_nationkey, cast(1 as bigint), ARR(cast(null as string), null, null, null, null, null, null, null, null) FROM sheets UNION ALL "
    "SELECT path, sheet, n_nationkey, cast(2 as bigint), ARR('  ', '1', null, '2', null, null, null, '3', null) FROM sheets UNION ALL "
    "SELECT path, sheet, n_nationkey, cast(3 as bigint), ARR('Code Client', 'Libellé', 'Montant H.T.', 'Catégorie', null, '', ' nan', 'code-client', '2025') FROM sheets "
    "WHERE n_nationkey <> 7 UNION ALL "
    "SELECT path, sheet, n_nationkey, cast(3 as bigint), ARR('Alpha', 'Bêta', 'Gamma', 'Delta', null, '', ' nan', 'alpha', 'Oméga') FROM sheets "
    "WHERE n_nationkey = 7 UNION ALL "
    f"SELECT path, sheet, n_nationkey, 10 + c_custkey, ARR(cast(c_custkey as string), c_name, {french('c_acctbal', ' ')}, "
    "case when c_custkey % 4 = 0 then ' ' else c_mktsegment end, cast(null as string), case when c_custkey % 2 = 0 then '  ' end, "
    "case when c_custkey % 3 = 0 then ' nan' when c_custkey % 3 = 1 then ' ' end, "
    "case when c_custkey % 5 = 0 then 'N/A' else cast(c_custkey % 5 as string) end, 'x') "
    "FROM {customer} JOIN sheets ON c_nationkey = n_nationkey), "
)
CLEAN = "raw AS (SELECT path, sheet, sheet_idx, row_idx, vals FROM grid) "
ROWS_QUERY = GRID + CLEAN + "SELECT path, sheet, cast(sheet_idx as int) AS sheet_idx, row_idx, vals FROM raw"
N_COLS = 9


def grid(spark, sf):
    rows = derive(spark, sf, ROWS_QUERY).withColumnRenamed("vals", "values")
    return rows.withColumn("values", F.transform("values", text.na_to_null))


# The same rows for the check: missing-value texts removed, then one row per cell.
_NA = sql_na("x")
SRC = (
    plain_sql(GRID)
    + f"rws AS MATERIALIZED (SELECT path, sheet, cast(sheet_idx as int) AS sheet_idx, row_idx, list_transform(vals, lambda x: {_NA}) AS vals FROM grid), "
    + "cells AS MATERIALIZED (SELECT path, sheet, sheet_idx, row_idx, cast(i as int) AS col_idx, vals[i + 1] AS value FROM rws, range(0, 9) t(i)), "
    + "live AS (SELECT DISTINCT path, sheet_idx, row_idx FROM cells WHERE value IS NOT NULL), "
    + "ranked AS (SELECT *, row_number() OVER (PARTITION BY path, sheet_idx ORDER BY row_idx) AS pos FROM live)"
)


def sql_headers(r: R.Rules) -> str:
    folded = sql_fold("value")
    enough = f"hits >= {r.min_hits}"
    density = "2 * filled + letters" if r.density_fallback else "0"
    late = "pos" if r.last_density_wins else "-pos"
    return (
        f"{SRC}, scored AS (SELECT path, sheet, sheet_idx, row_idx, pos, "
        f"count(*) FILTER ({sql_has_any(folded, r.header_words)}) AS hits, "
        # a missing cell counts as filled and as letters, as it prints as nan
        f"count(*) FILTER (value IS NULL OR {sql_trim('value')} <> '') AS filled, "
        "count(*) FILTER (value IS NULL OR regexp_matches(value, '[A-Za-zÀ-ÿ]')) AS letters "
        f"FROM cells JOIN ranked USING (path, sheet_idx, row_idx) WHERE pos <= {r.scan} GROUP BY ALL), "
        f"heads AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY path, sheet_idx ORDER BY ({enough}) DESC, "
        f"case when {enough} then hits else {density} end DESC, case when {enough} then -pos else {late} end DESC) = 1), "
        "head_cells AS (SELECT c.path, c.sheet, c.sheet_idx, c.row_idx, c.col_idx, c.value FROM cells c JOIN heads h USING (path, sheet_idx, row_idx)), "
        "body AS (SELECT c.* FROM cells c JOIN live USING (path, sheet_idx, row_idx) JOIN heads h ON c.path = h.path AND c.sheet_idx = h.sheet_idx "
        "AND c.row_idx > h.row_idx)"
    )


def add(name, sql):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


@add("n01_drop_blank_rows", f"{SRC} SELECT path, sheet_idx, row_idx FROM live")
def n01(spark, sf):
    return shape.drop_blank_rows(grid(spark, sf)).select("path", "sheet_idx", "row_idx")


@add(
    "n02_drop_null_columns",
    f"{SRC} SELECT path, sheet_idx, col_idx, count(value) AS n_value FROM cells GROUP BY ALL HAVING count(value) > 0",
)
def n02(spark, sf):
    counts = shape.column_counts(shape.rows_to_cells(grid(spark, sf)))
    return counts.filter("n_value > 0").select("path", "sheet_idx", "col_idx", "n_value")


_KEPT = {
    "n03a_drop_blank_columns": (R.SPA, f"count(*) FILTER ({sql_trim('value')} <> '') > 0"),
    "n03b_drop_all_blank_columns": (
        R.FQT,
        f"count(value) > 0 AND NOT (count(value) = count(*) AND count(*) FILTER ({sql_trim('value')} <> '') = 0)",
    ),
    "n03c_drop_blank_or_nan_columns": (R.CATCLIENTS, f"count(*) FILTER ({sql_trim('value')} NOT IN ('', 'nan')) > 0"),
}
for _name, (_rules, _having) in _KEPT.items():

    def _kept(spark, sf, r=_rules):
        rows = grid(spark, sf)
        headers = shape.find_headers(rows, r)
        stats = profile.profile_body(shape.body_rows(rows, headers), headers, r)
        return stats.filter(shape.column_survives(r)).select("path", "sheet_idx", "col_idx")

    add(_name, f"{sql_headers(_rules)} SELECT path, sheet_idx, col_idx FROM body GROUP BY ALL HAVING {_having}")(_kept)


def _header(r):
    def run(spark, sf):
        found = shape.find_headers(grid(spark, sf), r)
        return found.select("path", "sheet_idx", "header_row", c("hits").cast("long").alias("hits"))

    return run


for _name, _rules in {
    "n04a_header_by_keywords": R.RPA, "n04b_header_by_one_keyword": R.CATCLIENTS, "n05a_header_by_density_first": R.FQT,
    "n05b_header_by_density_last": R.PAAE,
}.items():
    add(_name, f"{sql_headers(_rules)} SELECT path, sheet_idx, row_idx AS header_row, hits FROM heads")(_header(_rules))


@add(
    "n06_body_rows",
    f"{sql_headers(R.SPA)} SELECT path, sheet_idx, row_idx, count(value) AS n_value FROM body GROUP BY ALL",
)
def n06(spark, sf):
    rows = grid(spark, sf)
    body = shape.body_rows(rows, shape.find_headers(rows, R.SPA))
    n = F.size(F.filter("values", lambda v: v.isNotNull())).cast("long")
    return body.select("path", "sheet_idx", "row_idx", n.alias("n_value"))


@add(
    "n07_column_names",
    f"{sql_headers(R.FNP)} SELECT path, sheet_idx, col_idx, {sql_snake('value')} AS name FROM head_cells",
)
def n07(spark, sf):
    return shape.header_columns(shape.find_headers(grid(spark, sf), R.FNP)).select("path", "sheet_idx", "col_idx", "name")


@add(
    "n08_unique_names",
    f"{sql_headers(R.FNP)}, named AS (SELECT path, sheet_idx, col_idx, {sql_snake('value')} AS name FROM head_cells), "
    "numbered AS (SELECT *, row_number() OVER (PARTITION BY path, sheet_idx, name ORDER BY col_idx) AS nth FROM named) "
    "SELECT path, sheet_idx, col_idx, case when nth = 1 then name else name || '_' || nth end AS name FROM numbered",
)
def n08(spark, sf):
    names = shape.header_columns(shape.find_headers(grid(spark, sf), R.FNP))
    return shape.unique_names(names, shape.SHEET_KEY).select("path", "sheet_idx", "col_idx", "name")


HEADINGS = (
    "SELECT p_partkey, case p_partkey % 6 when 0 then 'Top Custo-HFM' when 1 then 'TOP' when 2 then 'Catégorie' "
    "when 3 then 'Category' when 4 then 'Libellé ' else p_name end AS heading FROM {part}"
)


@add(
    "n09_canonical_names",
    f"SELECT p_partkey, case when contains(s, 'top') and contains(s, 'hfm') then 'top_custo_hfm' "
    "when s in ('top_custo', 'top') then 'top_custo_hfm' when s = 'category' then 'categorie' else s end AS name "
    f"FROM (SELECT p_partkey, {sql_snake('heading')} AS s FROM ({plain_sql(HEADINGS)}))",
)
def n09(spark, sf):
    df = derive(spark, sf, HEADINGS)
    return df.select("p_partkey", shape.canonical_name(text.snake(c("heading"))).alias("name"))


@add(
    "n10_first_filled_columns",
    "SELECT p_partkey AS row_idx, p_brand AS code_condition, p_name AS libelle, cast(p_size as string) AS delai_source FROM part",
)
def n10(spark, sf):
    parts = scan(spark, sf, "part").withColumn("empty", F.lit(None).cast("string"))
    columns = ["empty", "p_brand", "empty", "p_name", "p_size", "p_type"]
    parts = parts.select("p_partkey", *[c(x).alias(f"x{i}") for i, x in enumerate(columns)])
    rows = table_rows(
        parts, [f"x{i}" for i in range(6)], F.lit("conditions.xlsx"), F.lit("Feuil1"), F.lit(0), c("p_partkey")
    )
    return shape.project_positions(rows, ingest.PAYMENT_COLUMNS).drop("path", "sheet", "sheet_idx")


@add("n11_keep_listed_columns", "SELECT p_name AS libelle, p_type AS categorie FROM part")
def n11(spark, sf):
    parts = scan(spark, sf, "part").withColumnsRenamed({"p_name": "libelle", "p_type": "categorie"})
    return shape.keep_listed(parts, shape.CATEGORY_COLUMNS)


# Every sheet but one has a label and a category column, found by synonym.
STACKED_SQL = (
    f"{sql_headers(R.CATCLIENTS)}, named AS (SELECT path, sheet_idx, col_idx, {sql_snake('value')} AS s FROM head_cells), "
    "canon AS (SELECT path, sheet_idx, min(col_idx) FILTER (s = 'libelle') AS a, min(col_idx) FILTER (s IN ('categorie', 'category')) AS b "
    "FROM named GROUP BY ALL), "
    "stacked AS (SELECT path, sheet_idx, row_idx, max(value) FILTER (col_idx = a) AS libelle, max(value) FILTER (col_idx = b) AS categorie "
    "FROM body JOIN canon USING (path, sheet_idx) GROUP BY ALL)"
)


@add("n12_stack_sheets", f"{STACKED_SQL} SELECT * FROM stacked")
def n12(spark, sf):
    rows = grid(spark, sf)
    headers = shape.find_headers(rows, R.CATCLIENTS)
    return shape.stack_sheets(rows, headers, ("libelle", "categorie")).drop("sheet")


_BASE = sql_snake("regexp_replace(path, '\\.[^.]*$', '')")


@add(
    "n13_table_names",
    f"{SRC}, books AS (SELECT path, count(DISTINCT sheet_idx) AS n FROM rws GROUP BY path) "
    f"SELECT DISTINCT path, sheet, substr(case when n = 1 then {_BASE} else {_BASE} || '__' || {sql_snake('sheet')} end, 1, 63) AS name "
    "FROM rws JOIN books USING (path)",
)
def n13(spark, sf):
    rows = grid(spark, sf)
    base = text.snake(F.regexp_replace("path", r"\.[^.]*$", ""))
    sheets = rows.select("path", "sheet").distinct().join(ingest.sheet_counts(rows), "path")
    return sheets.select("path", "sheet", shape.table_name(base, c("sheet"), c("n_sheets")).alias("name"))


@add(
    "n14_skipped_sheets",
    f"{sql_headers(R.SPA)} SELECT DISTINCT path, sheet_idx FROM (SELECT path, sheet_idx + k * 100 AS sheet_idx FROM rws, range(0, 2) t(k)) "
    "WHERE sheet_idx >= 100 OR (path, sheet_idx) NOT IN (SELECT (path, sheet_idx) FROM body)",
)
def n14(spark, sf):
    """Each sheet gets a twin that has a header but no rows below it."""
    rows = grid(spark, sf)
    twins = rows.filter("row_idx = 3").withColumn("sheet_idx", c("sheet_idx") + 100)
    both = rows.unionByName(twins)
    decided = ingest.decide_sheets(both, R.SPA)
    sheets = both.select(*shape.SHEET).distinct()
    return ingest.skipped_sheets(sheets, decided).select("path", c("sheet_idx").cast("long").alias("sheet_idx"))


_WIDE = ", ".join(f"max(value) FILTER (col_idx = {i}) AS c{i}" for i in range(N_COLS))


@add("n15_pivot_cells", f"{SRC} SELECT path, sheet, sheet_idx, row_idx, {_WIDE} FROM cells GROUP BY ALL")
def n15(spark, sf):
    return shape.pivot_cells(shape.rows_to_cells(grid(spark, sf)), N_COLS)


# --- table as a grid ------------------------------------------------------------------------------------
PART_COLUMNS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@add(
    "s05_table_cells",
    " UNION ALL ".join(
        f"SELECT p_partkey AS row_idx, '{x}' AS name, {sql_na(f'cast({x} as string)')} AS value FROM part" for x in PART_COLUMNS
    ),
)
def s05(spark, sf):
    return table_cells(scan(spark, sf, "part"), PART_COLUMNS, c("p_partkey"))


_TOKENS = ", ".join(q(t) for t in text.NA_TOKENS)
TOKENS = (
    f"SELECT c_custkey, case when c_custkey % 2 = 0 then list[cast(c_custkey % {len(text.NA_TOKENS)} as int)] "
    "else c_name end AS v FROM (SELECT c_custkey, c_name, ARR(" + _TOKENS + ") AS list FROM {customer})"
)


@add(
    "s04_missing_tokens",
    f"SELECT c_custkey, {sql_na('v')} AS v FROM ({plain_sql(TOKENS).replace('as int)]', 'as int) + 1]')})",
)
def s04(spark, sf):
    return derive(spark, sf, TOKENS).select("c_custkey", text.na_to_null(c("v")).alias("v"))


# --- deduplication and samples -----------------------------------------------------------------------------
LABELS = (
    "SELECT case when c_custkey % 3 = 0 then null else c_mktsegment || ' ' || cast(c_custkey % 50 as string) end AS libelle, "
    "case when c_custkey % 4 = 0 then '' when c_custkey % 4 = 1 then null else c_name end AS categorie, "
    "c_nationkey AS sheet_idx, c_custkey AS row_idx FROM {customer}"
)
_ORDER = "ORDER BY coalesce(length(categorie) > 0, false) DESC, sheet_idx, row_idx"


@add(
    "d01_dedupe_prefers_category",
    f"SELECT * FROM ({plain_sql(LABELS)}) QUALIFY row_number() OVER (PARTITION BY libelle {_ORDER}) = 1",
)
def d01(spark, sf):
    return dedupe.dedupe_labels(derive(spark, sf, LABELS), ["sheet_idx", "row_idx"])


@add(
    "d01b_labels_over_loads",
    f"SELECT libelle, categorie, sheet_idx, row_idx FROM ({plain_sql(LABELS)}) QUALIFY row_number() OVER (PARTITION BY libelle {_ORDER}) = 1",
)
def d01b(spark, sf):
    """Labels of three loads, one of them twice, merged into a stored table; as if they had come at once."""
    labels = derive(spark, sf, LABELS).withColumn("uncategorised", ~F.coalesce(F.length("categorie") > 0, F.lit(False)))
    name = f"labels_{uuid.uuid4().hex}"
    table = KeyedTable(name, new_folder(spark, "keyed"), ("libelle",), ("uncategorised", "sheet_idx", "row_idx"), buckets=8)
    for number, part in ((1, 0), (2, 1), (2, 1), (3, 2)):
        table.upsert(labels.filter(c("row_idx") % 3 == part), number)
    return table.read(spark).drop("uncategorised")


@add(
    "d02_dedupe_by_position",
    f"SELECT libelle, sheet_idx, row_idx FROM ({plain_sql(LABELS)}) "
    "QUALIFY row_number() OVER (PARTITION BY libelle ORDER BY sheet_idx, row_idx) = 1",
)
def d02(spark, sf):
    return dedupe.dedupe_labels(derive(spark, sf, LABELS).drop("categorie"), ["sheet_idx", "row_idx"])


@add(
    "d03_sort_by_flag",
    f"SELECT row_idx, coalesce(length(categorie) > 0, false) AS filled FROM ({plain_sql(LABELS)}) ORDER BY filled DESC, row_idx",
)
def d03(spark, sf):
    flag = F.coalesce(F.length("categorie") > 0, F.lit(False)).alias("filled")
    return derive(spark, sf, LABELS).select("row_idx", flag).orderBy(c("filled").desc(), "row_idx")


@add("d04_sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def d04(spark, sf):
    orders = scan(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return dedupe.sample_rows(orders, R.SPA.sample, [c("o_orderkey")])


@add(
    "d05_union_by_name",
    "SELECT c_name AS nom, c_acctbal AS solde, c_mktsegment AS categorie FROM customer UNION ALL "
    "SELECT s_name, s_acctbal, null FROM supplier",
)
def d05(spark, sf):
    a = scan(spark, sf, "customer").selectExpr("c_name AS nom", "c_acctbal AS solde", "c_mktsegment AS categorie")
    b = scan(spark, sf, "supplier").selectExpr("s_acctbal AS solde", "s_name AS nom")
    return a.unionByName(b, allowMissingColumns=True)


@add(
    "a11_sheet_report",
    f"{sql_headers(R.RPA)} SELECT path, sheet, count(DISTINCT row_idx) AS n_rows, count(DISTINCT col_idx) FILTER (col_idx <> 4 AND col_idx <> 5) AS n_cols "
    "FROM body GROUP BY path, sheet",
)
def a11(spark, sf):
    decided = ingest.decide_sheets(grid(spark, sf), R.RPA)
    return profile.sheet_report(decided)


_KEY = "path || '|' || sheet_idx || '|' || col_idx"
_KEYED = f"{sql_headers(R.FQT)}, keyed AS (SELECT {_KEY} AS name, value AS raw FROM body)"


@add(
    "n16_sheet_columns_decided",
    f"{sql_profile(R.FQT, _KEYED, 'keyed')}, "
    f"named AS (SELECT path, sheet, sheet_idx, col_idx, {_KEY} AS key, {sql_snake('value')} AS snake FROM head_cells), "
    "uniq AS (SELECT *, row_number() OVER (PARTITION BY path, sheet_idx, snake ORDER BY col_idx) AS nth FROM named), "
    "hinted AS (SELECT prof.*, path, sheet, col_idx, case when nth = 1 then snake else snake || '_' || nth end AS hint "
    "FROM prof JOIN uniq ON name = key WHERE n_value > 0 AND (n_filled > 0 OR n_value < n)), "
    f"decided AS (SELECT *, {sql_chain(R.FQT)} AS d FROM hinted) SELECT path, sheet, col_idx, hint AS name, {SQL_OUTCOME} FROM decided",
)
def n16(spark, sf):
    """Names, types and lost values of every column of every sheet."""
    decided = ingest.decide_sheets(grid(spark, sf), R.FQT)
    return decided.select("path", "sheet", "col_idx", "name", "n", "tag", "method", "lost_values")
