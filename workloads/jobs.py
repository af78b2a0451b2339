"""Whole jobs (P1-P7): untidy sheets in, typed tables out, checked against the clean tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cellweave.functions import text
from cellweave.plans import ingest
from cellweave.plans import rules as R
from cellweave.session import settle
from cellweave.sources.table import table_rows
from workloads import grids
from workloads.base import derive, dmy, french, iso, scan, sql_trim

QUERIES, SQL = {}, {}
c = F.col

# Three sheets of order lines: a title, an empty row, the header, the lines.
HEADER = ("Montant H.T.", "Date de retrait", "Semaine", "Retour", "Motif statut", "Code article", "Heures", "Nature")
NULLS = ", ".join(["null"] * (len(HEADER) - 2))
NUMBERED = (
    "SELECT flag, cast(row_number() OVER (ORDER BY flag) - 1 as int) AS idx FROM (SELECT DISTINCT l_returnflag AS flag FROM {lineitem})"
)
SHEETS = (
    "SELECT flag, idx, cast(0 as bigint) AS row_idx, ARR('Relevé', 'édité', " + NULLS + ") AS vals FROM {numbered} UNION ALL "
    "SELECT flag, idx, cast(1 as bigint), ARR(cast(null as string), null, " + NULLS + ") FROM {numbered} UNION ALL "
    "SELECT flag, idx, cast(2 as bigint), ARR(" + ", ".join(f"'{h}'" for h in HEADER) + ") FROM {numbered} UNION ALL "
    "SELECT l_returnflag, idx, 10 + l_orderkey * 10 + l_linenumber, ARR("
    + french("l_extendedprice", "\xa0")
    + f", {dmy('l_shipdate')}, {iso('l_shipdate')}, case when l_linestatus = 'O' then 'oui' else ' NON ' end, "
    "'S' || cast(l_linenumber % 3 as string), cast(1000000 + l_partkey as string), cast(l_quantity as string), "
    "case when l_linenumber < 4 then 'N/A' else cast(l_quantity * 10 as string) end) "
    "FROM {lineitem} JOIN {numbered} ON l_returnflag = flag"
)


def sheets(spark, sf, sql=SHEETS):
    # The sheets' numbers are metadata, stored so that their size is known and the lines need no shuffle to meet them.
    rows = derive(spark, sf, sql, numbered=settle(derive(spark, sf, NUMBERED)))
    return rows.select(
        F.lit("/depot/Lignes 2025.xlsx").alias("path"),
        F.concat(F.lit("Statut "), "flag").alias("sheet"),
        c("idx").alias("sheet_idx"),
        "row_idx",
        F.transform("vals", text.na_to_null).alias("values"),
    )


def _job(rules):
    def run(spark, sf):
        tables = ingest.typed_sheets(ingest.stage(sheets(spark, sf))[0], rules)
        frames = [t.frame.withColumn("target", F.lit(t.name)) for t in tables]
        return reduce(lambda a, b: a.unionByName(b), frames)

    return run


def _expected(**other: str) -> str:
    """Types by hand from the rules; most columns come out alike in every job."""
    columns = {
        "montant_h_t": "l_extendedprice",
        "date_de_retrait": "cast(l_shipdate as date)",
        "semaine": "cast(l_shipdate as date)",
        "retour": "l_linestatus = 'O'",
        "motif_statut": "'S' || l_linenumber % 3",
        "code_article": "1000000 + l_partkey",
        "heures": "cast(l_quantity as bigint)",
        "nature": "case when l_linenumber >= 4 then cast(l_quantity * 10 as string) end",
        **other,
    }
    picked = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {picked}, 'lignes_2025__statut_' || lower(l_returnflag) AS target FROM lineitem"


for _name, _rules, _other in (
    ("p01_fqt_sheets", R.FQT, {}),
    ("p02_fnp_sheets", R.FNP, {}),
    ("p03_rpa_sheets", R.RPA, {"code_article": "cast(1000000 + l_partkey as string)"}),
    ("p04_spa_sheets", R.SPA, {"heures": "l_quantity"}),
    ("p05_paae_sheets", R.PAAE, {}),
):
    QUERIES[_name] = _job(_rules)
    SQL[_name] = _expected(**_other)


# Some amounts are words and some dates do not exist; a cast loses both.
LOSSY = SHEETS.replace(
    french("l_extendedprice", "\xa0"), f"case when l_partkey % 40 = 0 then 'à voir' else {french('l_extendedprice', chr(160))} end"
).replace(dmy("l_shipdate"), f"case when l_suppkey % 30 = 0 then ' 31/02/2024 ' else {dmy('l_shipdate')} end")


def c03(spark, sf):
    """Every text the casts of a job lose, with its place."""
    tables = ingest.typed_sheets(ingest.stage(sheets(spark, sf, LOSSY))[0], R.RPA, losses=True)
    lost = reduce(lambda a, b: a.unionByName(b), [t.losses for t in tables if t.losses is not None])
    return lost.select("sheet_idx", "row_idx", "col_idx", "name", "text")


_LOST = (
    "SELECT cast(idx as int) AS sheet_idx, 10 + l_orderkey * 10 + l_linenumber AS row_idx, cast({} as int) AS col_idx, "
    "'{}' AS name, '{}' AS text FROM x WHERE {} = 0"
)
QUERIES["c03_lost_cells"] = c03
SQL["c03_lost_cells"] = (
    "WITH x AS (SELECT *, dense_rank() OVER (ORDER BY l_returnflag) - 1 AS idx FROM lineitem) "
    + _LOST.format(0, "montant_h_t", "à voir", "l_partkey % 40")
    + " UNION ALL "
    + _LOST.format(1, "date_de_retrait", "31/02/2024", "l_suppkey % 30")
)


def p06(spark, sf):
    parts = scan(spark, sf, "part").select(
        "p_partkey",
        F.lit(None).cast("string").alias("x0"),
        F.concat(c("p_partkey").cast("string"), F.lit(" ")).alias("x1"),
        F.concat(F.lit("\xa0"), "p_name").alias("x2"),
        F.concat(c("p_size").cast("string"), F.lit(",0")).alias("x3"),
        c("p_type").alias("x4"),
    )
    rows = table_rows(
        parts, [f"x{i}" for i in range(5)], F.lit("/depot/conditions.xlsx"), F.lit("Feuil1"), F.lit(0), c("p_partkey")
    )
    return ingest.payment_terms(rows)


QUERIES["p06_payment_terms"] = p06
QUERIES["t06_decide_payment_terms"] = lambda spark, sf: spark.createDataFrame(
    p06(spark, sf).dtypes, "name string, type string"
)
SQL["p06_payment_terms"] = "SELECT p_partkey AS code_condition, p_name AS libelle, cast(p_size as bigint) AS delai_source FROM part"
SQL["t06_decide_payment_terms"] = (
    "SELECT * FROM (VALUES ('code_condition', case when (SELECT bool_and(p_size >= 0) FROM part) then 'bigint' end), "
    "('libelle', 'string'), ('delai_source', case when (SELECT bool_and(p_size % 1 = 0) FROM part) then 'bigint' end)) t(name, type)"
)


def p07(spark, sf):
    return ingest.client_categories(grids.grid(spark, sf))


def _clean(x: str) -> str:
    nbsp = "\xa0"
    return sql_trim(f"replace({x}, '{nbsp}', ' ')")


QUERIES["p07_client_categories"] = p07
SQL["p07_client_categories"] = (
    f"{grids.STACKED_SQL}, clean AS (SELECT {_clean('libelle')} AS libelle, {_clean('categorie')} AS categorie, sheet_idx, row_idx FROM stacked) "
    "SELECT libelle, categorie FROM clean QUALIFY row_number() OVER "
    "(PARTITION BY libelle ORDER BY coalesce(length(categorie) > 0, false) DESC, sheet_idx, row_idx) = 1"
)
