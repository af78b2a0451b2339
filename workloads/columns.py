"""Column statistics (A), type decisions (T) and casts (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import booleans, dates, numbers, text
from cellweave.operators import cast, decide, profile
from cellweave.operators.history import ProfileStore
from cellweave.plans import rules as R
from cellweave.plans.ingest import type_table
from cellweave.session import new_folder, tune
from workloads.base import (
    clock, derive, dmy, french, iso, mdy, plain_sql, sql_boolean, sql_clean_number, sql_date, sql_fold, sql_has_any,
    sql_is_iso, sql_iso, sql_na, sql_number, sql_number_like, sql_serial, sql_timed, sql_token, sql_trim, sql_snake,
)

QUERIES, SQL = {}, {}
c = F.col
NBSP, NNBSP = "\xa0", " "

# Order lines as they would stand in a business sheet: everything text, French style.
LINES = (
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {french('l_extendedprice', NBSP)} AS montant_ht, "
    f"{french('l_extendedprice', '.')} AS prix_unitaire, "
    f"{dmy('l_shipdate')} AS date_de_retrait, {mdy('l_shipdate')} AS dt_edition, {iso('l_shipdate')} AS livraison, "
    "cast(DAYS(l_shipdate) as string) AS jour_date, cast(l_quantity as string) AS heures, "
    "case l_returnflag when 'A' then 'oui' when 'N' then 'non' else 'Vrai' end AS retour, "
    "case when l_linenumber = 1 then null when l_linenumber = 2 then '0' else l_linestatus end AS statut, "
    "cast(1000000 + l_partkey as string) AS code_article, cast(l_tax * 100 as string) || '%' AS taux_tva, "
    "case when l_linenumber < 4 then 'N/A' else cast(l_quantity * 10 as string) end AS nature "
    "FROM {lineitem}"
)
LINE_COLUMNS = (
    "montant_ht", "prix_unitaire", "date_de_retrait", "dt_edition", "livraison", "jour_date", "heures", "retour",
    "statut", "code_article", "taux_tva", "nature",
)
# Events and orders with times, mixed date styles and few numbers.
EVENTS = (
    f"SELECT event_id, {iso('ts')} || ' ' || {clock('ts')} AS horodatage, "
    f"case when event_id % 10 < 3 then {iso('ts')} || ' ' || {clock('ts')} else event_type end AS motif, "
    f"case when event_id % 10 < 8 then {dmy('ts')} || ' ' || {clock('ts')} else null end AS echeance, "
    f"case when event_id % 2 = 0 then {iso('ts')} else {iso('ts')} || ' ' || {clock('ts')} end AS semaine, "
    "case when event_id % 100 = 0 then cast(value as string) else event_type end AS marge, "
    "cast(date_trunc('day', ts) as string) AS ot, "
    "case when event_id % 20 < 17 then cast(user_id as string) else 'inconnu' end AS solde, "
    "case when event_id % 20 < 16 then cast(user_id as string) else 'inconnu' end AS quantite "
    "FROM {events}"
)
EVENT_COLUMNS = ("horodatage", "motif", "echeance", "semaine", "marge", "solde", "quantite")

ALL_COLUMNS = LINE_COLUMNS + EVENT_COLUMNS

CELLS_SQL = " UNION ALL ".join(
    f"SELECT {i} AS col_idx, '{name}' AS name, {sql_na(name)} AS raw FROM {source}"
    for i, (name, source) in enumerate([(n, "lines") for n in LINE_COLUMNS] + [(n, "moments") for n in EVENT_COLUMNS])
)
SOURCES_SQL = f"WITH lines AS ({plain_sql(LINES)}), moments AS ({plain_sql(EVENTS)}), cells AS MATERIALIZED ({CELLS_SQL})"


def cells(spark, sf):
    """Cells of both tables in long form: (name, value)."""
    lines = profile.melt(derive(spark, sf, LINES), list(LINE_COLUMNS))
    moments = profile.melt(derive(spark, sf, EVENTS), list(EVENT_COLUMNS))
    return lines.unionByName(moments)


REMOVE = {"fqt": f" {NBSP}{NNBSP}", "fnp": f" {NBSP}", "rpa": f" {NBSP}", "spa": f" {NBSP}", "paae": f" {NBSP}{NNBSP}€"}


def sql_profile(r: R.Rules, source: str = SOURCES_SQL, cells: str = "cells") -> str:
    """CTEs ending in ``prof``: the statistics of each column of ``cells`` (name, raw)."""
    v = f"nullif({sql_trim('raw')}, '0')" if r.zero_is_null else sql_trim("raw")
    upper = r.serial_upper or 0.0
    integral = (
        "abs(nl - round_even(nl, 0)) <= 1e-8 + 1e-5 * abs(round_even(nl, 0))" if r.close_is_integral else "nl % 1 = 0"
    )
    return (
        f"{source}, texts AS (SELECT name, raw, {sql_trim('raw')} AS st, {v} AS v FROM {cells}), "
        f"facts AS MATERIALIZED (SELECT name, raw, st, v, {sql_is_iso('v')} AS is_iso, {sql_iso('v')} AS iso, {sql_number('v')} AS num, "
        f"{sql_serial(sql_number('v'), upper)} AS ser, {sql_token('v')} AS tok, {sql_date('v', True)} AS df, "
        f"{sql_date('v', False)} AS mf, {sql_boolean('v')} AS boo, "
        f"{sql_number_like('v', REMOVE[r.name], r.name == 'spa')} AS nl FROM texts), "
        "prof AS (SELECT name, count(*) AS n, count(raw) AS n_value, count(*) FILTER (st <> '') AS n_filled, "
        "count(v) AS n_nonnull, count(*) FILTER (v <> '') AS n_text, count(*) FILTER (is_iso) AS n_iso, "
        f"count(iso) AS n_iso_parsed, count(*) FILTER ({sql_timed('iso')}) AS n_iso_timed, count(num) AS n_number, "
        f"count(*) FILTER (num BETWEEN 60 AND {upper}) AS n_in_range, count(ser) AS n_serial, "
        f"count(*) FILTER ({sql_timed('ser')}) AS n_serial_timed, count(*) FILTER (tok) AS n_token, "
        f"count(df) AS n_day_first, count(*) FILTER ({sql_timed('df')}) AS n_day_first_timed, count(mf) AS n_month_first, "
        f"count(*) FILTER ({sql_timed('mf')}) AS n_month_first_timed, count(boo) AS n_boolean, count(nl) AS n_number_like, "
        f"coalesce(bool_and({integral}), false) AS all_integral FROM facts GROUP BY name)"
    )


def sql_timed_share(timed: str, parsed: str, r: R.Rules) -> str:
    if r.null_is_timed:
        return f"({timed} + n - {parsed}) / n > 0.2"
    return f"coalesce({timed} / nullif({parsed}, 0) > 0.2, false)"


def sql_chain(r: R.Rules) -> str:
    """The ordered rules as one CASE giving ``tag:method``."""

    def dated(method: str) -> str:
        parsed = "n_iso_parsed" if method == "iso" else f"n_{method}"
        return f"case when {sql_timed_share(f'n_{method}_timed', parsed, r)} then 'DATETIME:{method}' else 'DATE:{method}' end"

    best = f"case when n_month_first > n_day_first then {dated('month_first')} else {dated('day_first')} end"
    number = "case when all_integral and n_number_like > 0 then 'INT:int' else 'FLOAT:float' end"
    named = sql_has_any("hint", r.date_words)
    ok = "greatest(n_month_first, n_day_first) / n"
    whens = []
    if r.name == "fqt":
        forced = "hint in ('date_d_attribution', 'date_de_retrait')"
        whens += [(f"{forced} and n_iso / n >= 0.5", dated("month_first")), (forced, best)]
    if r.name == "paae":
        whens.append((sql_has_any("hint", r.text_words), "'STRING:text'"))
    if r.name in ("spa", "paae"):
        also = "hint = 'h'" if r.name == "paae" else "false"
        whens.append((f"({sql_has_any('hint', r.float_words)} or {also}) and n_number_like > 0", "'FLOAT:float'"))
    if r.name != "paae":
        whens.append(("n_iso / n >= 0.5 and n_iso_parsed / n >= 0.5", dated("iso")))
        extra = f" and {named}" if r.name == "spa" else ""
        whens.append((f"n_number / n >= 0.9 and n_serial / n >= 0.7{extra}", dated("serial")))
    without = "0.5" if r.name == "paae" else "0.7"
    whens.append((f"({named} and {ok} >= 0.5) or (not {named} and n_token / n >= 0.3 and {ok} >= {without})", best))
    whens.append(("n_boolean / n >= 0.98", "'BOOL:boolean'"))
    if r.name == "rpa":
        whens.append((f"{sql_has_any('hint', r.amount_words)} and n_number_like > 0", number))
        whens.append((sql_has_any("hint", r.code_words), "'STRING:text'"))
    whens.append(("n_number_like / n >= 0.85", number))
    return "case " + " ".join(f"when {a} then {b}" for a, b in whens) + " else 'STRING:text' end"


def _profile(r):
    return lambda spark, sf: profile.profile_cells(cells(spark, sf), r, ["name"])


# --- statistics: each query shows the part of the profile its operator adds ----------------------------
PARTS = {
    "a01_counts": (R.SPA, ["n", "n_value", "n_filled", "n_nonnull", "n_text"]),
    "a02_iso_share": (R.FNP, ["n_iso", "n_iso_parsed", "iso_ratio"]),
    "a03_plain_number_share": (R.FNP, ["n_number", "num_ratio"]),
    "a04a_serial_share_106750": (R.FNP, ["n_in_range", "n_serial", "serial_ratio"]),
    "a04b_serial_share_60000": (R.RPA, ["n_in_range", "n_serial", "serial_ratio"]),
    "a04c_serial_share_2950000": (R.FQT, ["n_in_range", "n_serial", "serial_ratio"]),
    "a05_date_token_share": (R.FQT, ["n_token", "token_ratio"]),
    "a06_date_parse_counts": (R.RPA, ["n_day_first", "n_month_first"]),
    "a07_boolean_share": (R.FQT, ["n_boolean", "bool_ratio"]),
    "a08_number_like_share": (R.SPA, ["n_number_like", "numlike_ratio"]),
    "a09a_all_integral_strict": (R.FNP, ["all_integral"]),
    "a09b_all_integral_close": (R.FQT, ["all_integral"]),
    "a10_timed_counts": (R.FQT, ["n_iso_timed", "n_serial_timed", "n_day_first_timed", "n_month_first_timed"]),
}
RATIOS = {
    "iso_ratio": "n_iso", "num_ratio": "n_number", "serial_ratio": "n_in_range", "token_ratio": "n_token",
    "bool_ratio": "n_boolean", "numlike_ratio": "n_number_like",
}


def _part(r, columns):
    return lambda spark, sf: profile.ratios(_profile(r)(spark, sf)).select("name", *columns)


for _name, (_rules, _columns) in PARTS.items():
    QUERIES[_name] = _part(_rules, _columns)
    SQL[_name] = (
        sql_profile(_rules)
        + " SELECT name, "
        + ", ".join(f"{RATIOS[x]} / n AS {x}" if x in RATIOS else x for x in _columns)
        + " FROM prof"
    )

# --- decisions -------------------------------------------------------------------------------------------


def _decided(r):
    def run(spark, sf):
        hinted = _profile(r)(spark, sf).withColumn("hint", c("name"))
        return decide.decide(hinted, r).select("name", "n", "tag", "method", "lost_values")

    return run


SQL_OUTCOME = (
    "n, split_part(d, ':', 1) AS tag, split_part(d, ':', 2) AS method, n_text - case split_part(d, ':', 2) "
    "when 'iso' then n_iso_parsed when 'serial' then n_serial when 'day_first' then n_day_first "
    "when 'month_first' then n_month_first when 'boolean' then n_boolean when 'int' then n_number_like "
    "when 'float' then n_number_like else n_text end AS lost_values"
)


def sql_decided(r: R.Rules) -> str:
    return (
        f"{sql_profile(r)}, hinted AS (SELECT *, name AS hint FROM prof), decided AS (SELECT *, {sql_chain(r)} AS d FROM hinted) "
        f"SELECT name, {SQL_OUTCOME} FROM decided"
    )


for _i, _rules in enumerate(R.INFERRED.values(), 1):
    QUERIES[f"t0{_i}_decide_{_rules.name}"] = _decided(_rules)
    SQL[f"t0{_i}_decide_{_rules.name}"] = sql_decided(_rules)


def t07(spark, sf):
    return decide.decide_uniform(_profile(R.CATCLIENTS)(spark, sf)).select("name", "tag", "method", "lost_values")


QUERIES["t07_decide_text"] = t07
SQL["t07_decide_text"] = (
    f"{SOURCES_SQL} SELECT DISTINCT name, 'STRING' AS tag, 'text' AS method, cast(0 as bigint) AS lost_values FROM cells"
)


def t08(spark, sf):
    kinds = decide.sql_types(R.PAAE)
    spark_types = {k: t.simpleString() for k, t in decide.SPARK_TYPES.items()}
    lookup = lambda d: F.create_map(*[F.lit(x) for pair in d.items() for x in pair])[c("tag")]
    return _decided(R.PAAE)(spark, sf).select(
        "name", lookup(kinds).alias("sql_type"), lookup(spark_types).alias("spark_type")
    )


QUERIES["t08_tag_types"] = t08
SQL["t08_tag_types"] = (
    f"SELECT name, case tag when 'DATE' then 'DATE' when 'DATETIME' then 'TIMESTAMP' when 'INT' then 'BIGINT' "
    "when 'FLOAT' then 'DOUBLE PRECISION' when 'BOOL' then 'BOOLEAN' else 'TEXT' end AS sql_type, "
    "case tag when 'DATE' then 'date' when 'DATETIME' then 'timestamp_ntz' when 'INT' then 'bigint' "
    f"when 'FLOAT' then 'double' when 'BOOL' then 'boolean' else 'string' end AS spark_type FROM ({sql_decided(R.PAAE)})"
)



def t09(spark, sf):
    """Types from the stored profiles of three loads, one of them added twice; no load looks at the rows of another."""
    store = ProfileStore(new_folder(tune(spark), "profiles"))
    lines, moments = derive(spark, sf, LINES), derive(spark, sf, EVENTS)
    loads = {
        "first": profile.melt(lines.filter("l_linenumber <= 3"), list(LINE_COLUMNS)),
        "second": profile.melt(lines.filter("l_linenumber > 3"), list(LINE_COLUMNS)),
        "events": profile.melt(moments, list(EVENT_COLUMNS)),
    }
    for load_id in ("first", "second", "events", "first"):
        store.add(profile.profile_cells(loads[load_id], R.RPA, ["name"]), load_id)
    hinted = store.profile(spark, ["name"]).withColumn("hint", c("name"))
    return decide.decide(hinted, R.RPA).select("name", "n", "tag", "method", "lost_values")


QUERIES["t09_decide_over_loads"] = t09
SQL["t09_decide_over_loads"] = SQL["t03_decide_rpa"]

# --- cast ---------------------------------------------------------------------------------------------------
KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def c01(spark, sf):
    return type_table(derive(spark, sf, LINES), R.FQT, list(LINE_COLUMNS), KEYS)


QUERIES["c01_typed_table"] = c01
# The expected values come from the clean columns, not from the texts.
SQL["c01_typed_table"] = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS montant_ht, "
    "l_extendedprice AS prix_unitaire, cast(l_shipdate as date) AS date_de_retrait, "
    "cast(l_shipdate as date) AS dt_edition, cast(l_shipdate as date) AS livraison, "
    "cast(l_shipdate as date) AS jour_date, cast(l_quantity as bigint) AS heures, l_returnflag <> 'N' AS retour, "
    "case when l_linenumber > 2 then l_linestatus end AS statut, "
    "1000000 + l_partkey AS code_article, "
    "cast(l_tax * 100 as string) || '%' AS taux_tva, "
    "case when l_linenumber >= 4 then cast(l_quantity * 10 as string) end AS nature FROM lineitem"
)


def a12(spark, sf):
    """The two gates of the payment terms over whole columns."""
    long = cells(spark, sf)
    texts = long.select(
        "name", text.trimmed(c("value")).alias("v"), numbers.clean_number(c("value"), numbers.WIDE_SPACES).alias("cleaned")
    )
    parsed = texts.select("name", c("v").rlike("^[0-9]+$").alias("digits"), numbers.plain_number(c("cleaned")).alias("x"))
    return parsed.groupBy("name").agg(
        F.coalesce(F.bool_and("digits"), F.lit(True)).alias("all_digits"),
        F.coalesce(F.bool_and(numbers.is_integral(c("x"))), F.lit(True)).alias("all_whole"),
    )


QUERIES["a12_whole_column_gates"] = a12
SQL["a12_whole_column_gates"] = (
    f"{SOURCES_SQL}, parsed AS (SELECT name, regexp_matches({sql_trim('raw')}, '^[0-9]+$') AS digits, "
    f"{sql_number_like('raw', ' ' + NBSP + NNBSP)} AS v FROM cells) "
    "SELECT name, coalesce(bool_and(digits), true) AS all_digits, coalesce(bool_and(v = floor(v)), true) AS all_whole "
    "FROM parsed GROUP BY name"
)
