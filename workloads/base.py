"""Reading the tables, and the SQL spellings that differ between Spark and the check engine."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.text import SPACES
from cellweave.session import tune

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


CENTS = r"cast\(round\((\w+) \* 100\) as bigint\)"


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, **frames: DataFrame) -> DataFrame:
    """Run shared SQL in Spark; ``{table}`` names a test table or one of ``frames``."""
    used = sorted(set(re.findall(r"\{(\w+)\}", sql)))
    tables = {t: frames[t] if t in frames else scan(spark, sf_dir, t) for t in used}
    # Cents are rounded once for a row and not wherever they are named.
    for column in sorted(set(re.findall(CENTS, sql))):
        sql = sql.replace(cents(column), f"{column}_cents")
        tables = {t: df.withColumn(f"{column}_cents", F.expr(cents(column))) if column in df.columns else df for t, df in tables.items()}
    return spark.sql(spark_sql(sql), **tables)


def spark_sql(sql: str) -> str:
    sql = re.sub(r"DAYS\((\w+)\)", r"datediff(\1, DATE '1899-12-30')", sql)
    return sql.replace("ARR(", "array(").replace("DIV(", "floor(")


def plain_sql(sql: str) -> str:
    """The same shared SQL for the check engine."""
    sql = re.sub(r"DAYS\((\w+)\)", r"date_diff('day', DATE '1899-12-30', CAST(\1 AS DATE))", sql)
    sql = sql.replace("ARR(", "list_value(").replace("DIV(", "floor(")
    return re.sub(r"\{(\w+)\}", r"\1", sql)


# --- shared pieces of untidy text --------------------------------------------------------------------

def two(x: str) -> str:
    return f"lpad(cast({x} as string), 2, '0')"


def dmy(c: str, sep: str = "/") -> str:
    return f"{two(f'day({c})')} || '{sep}' || {two(f'month({c})')} || '{sep}' || cast(year({c}) as string)"


def mdy(c: str) -> str:
    return f"{two(f'month({c})')} || '/' || {two(f'day({c})')} || '/' || cast(year({c}) as string)"


def iso(c: str) -> str:
    return f"cast(year({c}) as string) || '-' || {two(f'month({c})')} || '-' || {two(f'day({c})')}"


def clock(c: str) -> str:
    return f"{two(f'hour({c})')} || ':' || {two(f'minute({c})')} || ':' || {two(f'cast(floor(second({c})) as int)')}"


def cents(c: str) -> str:
    return f"cast(round({c} * 100) as bigint)"


def french(c: str, group: str) -> str:
    """An amount as French text: thousands apart, decimal comma, two decimals."""
    n = f"cast(floor(abs({cents(c)}) / 100) as bigint)"
    high = f"cast(cast(floor({n} / 1000) as bigint) as string) || '{group}' || lpad(cast({n} % 1000 as string), 3, '0')"
    return (
        f"case when {c} < 0 then '-' else '' end || "
        f"case when {n} >= 1000 then {high} else cast({n} as string) end || ',' || {two(f'abs({cents(c)}) % 100')}"
    )


# --- operators spelled in SQL for the check engine ----------------------------------------------------

def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_trim(x: str) -> str:
    return f"trim({x}, {q(SPACES)})"


def sql_na(x: str) -> str:
    from cellweave.functions.text import NA_TOKENS

    return f"(case when {x} not in ({', '.join(map(q, NA_TOKENS))}) then {x} end)"


def sql_fold(x: str) -> str:
    return sql_trim(f"lower(strip_accents({x}))")


def sql_snake(x: str) -> str:
    s = f"regexp_replace({sql_fold(x)}, {q('[' + SPACES + '.-]+')}, '_', 'g')"
    s = f"regexp_replace(regexp_replace({s}, '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g')"
    return f"coalesce(nullif(trim({s}, '_'), ''), 'col')"


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def sql_number(x: str) -> str:
    return f"(case when regexp_matches({x}, '{NUMBER}') then try_cast({x} as double) end)"


def sql_clean_number(x: str, remove: str, words: bool = False) -> str:
    s = f"translate({x}, {q(remove)}, '')"
    part = f"string_split({s}, '.')"
    joined = (
        f"array_to_string(list_transform(range(1, len({part}) + 1), lambda i: case when i = 1 then {part}[i] "
        f"when regexp_matches({part}[i - 1], '[0-9]$') and regexp_matches({part}[i], '^[0-9]{{3}}([^0-9]|$)') "
        f"then {part}[i] else '.' || {part}[i] end), '')"
    )
    s = f"replace(case when contains({s}, '.') then {joined} else {s} end, ',', '.')"
    if words:
        s = f"(case when lower({x}) in ('true', 'false', 'yes', 'no', 'vrai', 'faux') then '' else {s} end)"
    return s


def sql_number_like(x: str, remove: str, words: bool = False) -> str:
    return sql_number(sql_clean_number(x, remove, words))


def sql_boolean(x: str) -> str:
    return (
        f"(case when lower({x}) in ('true', 'vrai', 'oui', 'yes', '1', 'y', 'o') then true "
        f"when lower({x}) in ('false', 'faux', 'non', 'no', '0', 'n') then false end)"
    )


def sql_is_iso(x: str) -> str:
    return f"regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}})?$')"


def sql_in_range(ts: str) -> str:
    return f"(case when {ts} >= TIMESTAMP '1677-09-22' and {ts} < TIMESTAMP '2262-04-12' then {ts} end)"


def sql_iso(x: str) -> str:
    return f"(case when {sql_is_iso(x)} then {sql_in_range(f'try_cast({x} as timestamp)')} end)"


def sql_token(x: str) -> str:
    return (
        f"regexp_matches({x}, '(?i)[0-9]{{4}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,2}}|[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{2,4}}"
        "|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|févr|fevr|avr|mai|juin|juil|déc')"
    )


def sql_date(x: str, day_first: bool) -> str:
    """Formats tried one after another, behind a guard on the overall shape."""
    clock_formats = ["", " %H:%M:%S", " %H:%M", "T%H:%M:%S"]
    order = [("%d", "%m"), ("%m", "%d")][not day_first]
    seps = "-/."
    four = [f"%Y{s}%m{s}%d" for s in seps] + [f"{order[0]}{s}{order[1]}{s}%Y" for s in seps]
    two_digits = [f"{order[0]}{s}{order[1]}{s}%y" for s in seps]
    names = ["%d %b %Y", "%d-%b-%Y", "%b %d, %Y", "%b %d %Y", "%B %d, %Y", "%d %B %Y"]

    def tried(formats: list[str], clocks: list[str]) -> str:
        return "try_strptime(" + x + ", [" + ", ".join(q(f + c) for f in formats for c in clocks) + "])"

    shape = r"^([0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4})($|[ T][0-9]{1,2}:)"
    short = r"^[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2}($|[ T][0-9]{1,2}:)"
    worded = r"(?i)^([0-9]{1,2}[ -][a-z]{3,9}[ -][0-9]{4}|[a-z]{3,9} [0-9]{1,2},? [0-9]{4})"
    parsed = (
        f"case when regexp_matches({x}, '{shape}') then {tried(four, clock_formats)} "
        f"when regexp_matches({x}, '{short}') then {tried(two_digits, clock_formats)} "
        f"when regexp_matches({x}, '^[0-9]{{8}}$') then {tried(['%Y%m%d'], [''])} "
        f"when regexp_matches({x}, '^[0-9]{{4}}$') and {x} > '0000' then try_cast({x} || '-01-01' as timestamp) "
        f"when regexp_matches({x}, '^[0-9]{{4}}[-/][0-9]{{1,2}}$') then {tried(['%Y-%m', '%Y/%m'], [''])} "
        f"when regexp_matches({x}, '^[0-9]{{1,2}}[-/][0-9]{{4}}$') then {tried(['%m-%Y', '%m/%Y'], [''])} "
        f"when regexp_matches({x}, '{worded}') then {tried(names, clock_formats)} "
        f"when regexp_matches({x}, '(?i)^[a-z]{{3,9}}[ -][0-9]{{4}}$') then {tried(['%b %Y', '%B %Y', '%b-%Y'], [''])} end"
    )
    return sql_in_range(f"({parsed})")


def sql_serial(v: str, upper: float) -> str:
    return (
        f"(case when {v} >= 60 and {v} <= {upper} and {v} < 132321 then "
        f"TIMESTAMP '1899-12-30' + to_microseconds(cast(round({v} * 86400000000) as bigint)) end)"
    )


def sql_timed(ts: str) -> str:
    return f"({ts} <> date_trunc('day', {ts}))"


def sql_has_any(x: str, words: tuple[str, ...]) -> str:
    return "(" + (" or ".join(f"contains({x}, {q(w)})" for w in words) or "false") + ")"
