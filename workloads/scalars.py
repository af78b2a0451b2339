"""Scalar functions (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import booleans, dates, numbers, text
from workloads.base import (
    cents, derive, dmy, clock, french, iso, mdy, plain_sql, scan, sql_boolean, sql_date, sql_fold, sql_is_iso, sql_iso,
    sql_number, sql_number_like, sql_serial, sql_snake, sql_token, sql_trim, sql_na,
)

QUERIES, SQL = {}, {}
NBSP, NNBSP = "\xa0", "\u202f"


def query(name, shared=None, oracle=None, table=None):
    """Register a query; ``shared`` SQL derives its input in both engines."""

    def add(fn):
        if shared is not None:
            QUERIES[name] = lambda spark, sf: fn(derive(spark, sf, shared))
        else:
            QUERIES[name] = lambda spark, sf: fn(scan(spark, sf, table))
        if oracle is not None:
            source = f"WITH src AS ({plain_sql(shared)}) " if shared is not None else ""
            SQL[name] = source + oracle
        return fn

    return add


c = F.col

# Texts of the documents, the messages and the part types, with white space added around them.
TEXTS = (
    f"SELECT 'd' || cast(doc_id as string) AS id, '{NBSP} ' || text || ' ' AS v FROM {{documents}} "
    "UNION ALL SELECT 'c' || cast(conv_id as string) || '.' || cast(turn as string) AS id, text AS v FROM {conversations} "
    "UNION ALL SELECT 'p' || cast(p_partkey as string) AS id, p_type || ' Pièce n° ' || p_name || '.' AS v FROM {part}"
)


@query("f01_fold_text", TEXTS, f"SELECT id, {sql_fold('v')} AS folded FROM src")
def f01(df):
    return df.select("id", text.fold(c("v")).alias("folded"))


@query("f01_fold_exact", TEXTS, f"SELECT id, {sql_fold('v')} AS folded FROM src")
def f01_exact(df):
    return df.select("id", text.fold(c("v")).alias("folded"))


@query("f02_snake_identifier", TEXTS, f"SELECT id, {sql_snake('v')} AS ident FROM src")
def f02(df):
    return df.select("id", text.snake(c("v")).alias("ident"))


# Amounts written in turn with a space, a dot, a no-break space, a narrow one, and a currency sign.
AMOUNTS = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_linenumber % 5 "
    f"when 0 then {french('l_extendedprice', ' ')} "
    f"when 1 then {french('l_extendedprice', '.')} "
    f"when 2 then {french('l_extendedprice', NBSP)} "
    f"when 3 then {french('l_extendedprice', NNBSP)} "
    f"else {french('l_extendedprice', ' ')} || ' €' end AS v, "
    "case when l_quantity < 5 then 'Vrai' when l_quantity < 10 then 'no' else cast(l_quantity as string) end AS w "
    "FROM {lineitem}"
)
KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
KEY_LIST = KEYS.split(", ")
STYLES = {
    "f03a_number_spaces": (numbers.PLAIN_SPACES, " \xa0", False),
    "f03b_number_narrow_spaces": (numbers.WIDE_SPACES, " \xa0\u202f", False),
    "f03c_number_euro": (numbers.EURO, " \xa0\u202f€", False),
    "f03d_number_no_words": (numbers.NO_WORDS, " \xa0", True),
}
for _name, (_style, _remove, _words) in STYLES.items():

    def _number(df, style=_style):
        return df.select(
            *KEY_LIST, numbers.number_like(c("v"), style).alias("amount"), numbers.number_like(c("w"), style).alias("qty")
        )

    query(
        _name,
        AMOUNTS,
        f"SELECT {KEYS}, {sql_number_like('v', _remove, _words)} AS amount, {sql_number_like('w', _remove, _words)} AS qty FROM src",
    )(_number)

FLAGS = (
    f"SELECT {KEYS}, case l_returnflag when 'A' then 'Oui' when 'N' then 'NON' else 'vrai' end AS a, "
    "case when l_linenumber < 2 then cast(l_linenumber as string) when l_linenumber = 3 then 'peut-être' else 'n' end AS b "
    "FROM {lineitem}"
)


@query("f04_boolean_word", FLAGS, f"SELECT {KEYS}, {sql_boolean('a')} AS a, {sql_boolean('b')} AS b FROM src")
def f04(df):
    return df.select(*KEY_LIST, booleans.boolean_word(c("a")).alias("a"), booleans.boolean_word(c("b")).alias("b"))


@query(
    "f05_zero_to_null",
    "SELECT vec_id, cast(label as string) AS v, cast(cast(label as double) as string) AS w FROM {embeddings}",
    "SELECT vec_id, nullif(v, '0') AS v, nullif(w, '0') AS w FROM src",
)
def f05(df):
    return df.select("vec_id", text.zero_to_null(c("v")).alias("v"), text.zero_to_null(c("w")).alias("w"))


@query("f06_trim_unicode", TEXTS, f"SELECT id, {sql_trim('v')} AS v FROM src")
def f06(df):
    return df.select("id", text.trimmed(c("v")).alias("v"))


# Dates written in turn as ISO, day first, month first, short year, with time, in words, and broken.
DATES = (
    "SELECT o_orderkey, o_orderdate, case cast(o_orderkey % 9 as int) "
    f"when 0 then {iso('o_orderdate')} "
    f"when 1 then {iso('o_orderdate')} || ' 10:30:00' "
    f"when 2 then {dmy('o_orderdate')} "
    f"when 3 then {mdy('o_orderdate')} "
    f"when 4 then {dmy('o_orderdate', '.')} || ' 08:05' "
    f"when 5 then '31/02/' || cast(year(o_orderdate) as string) "
    f"when 6 then cast(day(o_orderdate) as string) || ' Mar ' || cast(year(o_orderdate) as string) "
    f"when 7 then cast(month(o_orderdate) as string) || '/' || cast(year(o_orderdate) as string) "
    f"else substr({dmy('o_orderdate', '-')}, 1, 6) || substr(cast(year(o_orderdate) as string), 3, 2) end AS v "
    "FROM {orders}"
)


@query("f07_is_iso_date", DATES, f"SELECT o_orderkey, {sql_is_iso('v')} AS is_iso FROM src")
def f07(df):
    return df.select("o_orderkey", c("v").rlike(dates.ISO).alias("is_iso"))


@query(
    "f08_has_date_token",
    "SELECT cast(o_orderkey as string) AS id, v FROM (" + DATES + ") UNION ALL "
    "SELECT 'd' || cast(doc_id as string) AS id, text AS v FROM {documents}",
    f"SELECT id, {sql_token('v')} AS has_token FROM src",
)
def f08(df):
    return df.select("id", dates.has_date_token(c("v")).alias("has_token"))


@query(
    "f09_parse_date_both_orders",
    DATES,
    f"SELECT o_orderkey, {sql_date('v', True)} AS day_first, {sql_date('v', False)} AS month_first FROM src",
)
def f09(df):
    return df.select(
        "o_orderkey",
        dates.parse_date(c("v"), True).alias("day_first"),
        dates.parse_date(c("v"), False).alias("month_first"),
    )


@query("f10_parse_iso", DATES, f"SELECT o_orderkey, {sql_iso('v')} AS ts FROM src")
def f10(df):
    return df.select("o_orderkey", dates.parse_iso(c("v")).alias("ts"))


SERIALS = (
    f"SELECT {KEYS}, cast(DAYS(l_shipdate) + (l_linenumber - 3) * 40000 as string) || "
    "case when l_linenumber % 2 = 0 then '.5' else '' end AS v FROM {lineitem}"
)
for _name, _upper in {
    "f11a_serial_to_106750": 106_750.0, "f11b_serial_to_60000": 60_000.0, "f11c_serial_to_2950000": 2_950_000.0,
}.items():

    def _serial(df, upper=_upper):
        return df.select(*KEY_LIST, dates.from_serial(numbers.plain_number(c("v")), upper).alias("ts"))

    query(_name, SERIALS, f"SELECT {KEYS}, {sql_serial(sql_number('v'), _upper)} AS ts FROM src")(_serial)


@query(
    "f12_clean_text",
    f"SELECT doc_id, '{NBSP}' || replace(text, ' ', '{NBSP}') || '  ' AS v FROM {{documents}}",
    f"SELECT doc_id, {sql_trim(f'''replace(v, '{NBSP}', ' ')''')} AS v FROM src",
)
def f12(df):
    return df.select("doc_id", text.clean_text(c("v")).alias("v"))


CODES = (
    "SELECT c_nationkey AS grp, c_custkey AS id, case when c_nationkey % 3 = 0 then c_mktsegment "
    "else cast(c_custkey as string) end AS code, "
    "cast(c_acctbal * case when c_nationkey % 2 = 0 then 100 else 1 end as string) AS delay FROM {customer}"
)


def _gate(df, name, holds, cast):
    gates = df.groupBy("grp").agg(holds.alias("whole"))
    return df.join(gates, "grp").select("grp", "id", F.when(c("whole"), cast).alias(name))


@query(
    "f13_all_digits_gate",
    CODES,
    "SELECT grp, id, case when bool_and(coalesce(regexp_matches(code, '^[0-9]+$'), true)) OVER (PARTITION BY grp) "
    "then try_cast(code as bigint) end AS code FROM src",
)
def f13(df):
    digits = F.coalesce(F.bool_and(text.trimmed(c("code")).rlike("^[0-9]+$")), F.lit(True))
    return _gate(df, "code", digits, numbers.integer_like(c("code"), numbers.WIDE_SPACES))


@query(
    "f14_integral_gate",
    CODES,
    "SELECT grp, id, case when bool_and(v = floor(v)) OVER (PARTITION BY grp) then cast(v as bigint) end AS delay "
    f"FROM (SELECT grp, id, {sql_number_like('delay', chr(32) + NBSP + NNBSP)} AS v FROM src)",
)
def f14(df):
    whole = F.coalesce(F.bool_and(numbers.is_integral(numbers.number_like(c("delay"), numbers.WIDE_SPACES))), F.lit(True))
    return _gate(df, "delay", whole, numbers.integer_like(c("delay"), numbers.WIDE_SPACES))



@query(
    "f15_name_hint",
    TEXTS,
    f"SELECT id, regexp_matches({sql_fold('v')}, 'date|dt|heure|time|ecart') AS hinted FROM src",
)
def f15(df):
    return df.select("id", text.has_any(text.fold(c("v")), ("date", "dt", "heure", "time", "ecart")).alias("hinted"))


@query("f16_cut_identifier", TEXTS, "SELECT id, substr(v, 1, 63) AS ident FROM src")
def f16(df):
    return df.select("id", text.cut_identifier(c("v")).alias("ident"))


@query(
    "f17_mask_secret",
    "SELECT c_custkey, c_name AS a, substr(c_mktsegment, 1, cast(c_custkey % 7 as int)) AS b FROM {customer}",
    "SELECT c_custkey, "
    + ", ".join(
        f"case when length({x}) = 0 then '' when length({x}) <= 4 then repeat('*', length({x})) "
        f"else left({x}, 2) || repeat('*', length({x}) - 4) || right({x}, 2) end AS {x}"
        for x in "ab"
    )
    + " FROM src",
)
def f17(df):
    return df.select("c_custkey", text.mask(c("a")).alias("a"), text.mask(c("b")).alias("b"))


@query("f19_cut_to_date", DATES, f"SELECT o_orderkey, cast({sql_iso('v')} as date) AS d FROM src")
def f19(df):
    return df.select("o_orderkey", dates.parse_iso(c("v")).cast("date").alias("d"))


@query(
    "f20_integral_tests",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS a, l_quantity AS b FROM {lineitem}",
    f"SELECT {KEYS}, "
    + ", ".join(
        f"abs({x} - round_even({x}, 0)) <= 1e-8 + 1e-5 * abs(round_even({x}, 0)) AS {x}_close, {x} % 1 = 0 AS {x}_whole"
        for x in "ab"
    )
    + " FROM src",
)
def f20(df):
    out = []
    for x in "ab":
        out += [numbers.is_close_to_integral(c(x)).alias(f"{x}_close"), numbers.is_integral(c(x)).alias(f"{x}_whole")]
    return df.select(*KEY_LIST, *out)


SETTINGS = (
    "SELECT 'setting_' || cast(p_partkey as string) AS k, case when p_size % 5 = 0 then '  ' "
    "when p_size % 7 = 0 then null else p_name end AS value FROM {part}"
)


@query("f18_missing_settings", SETTINGS, "SELECT k AS key FROM src WHERE coalesce(trim(value), '') = ''")
def f18(df):
    from cellweave.operators.gate import missing_settings

    return missing_settings(df.withColumnRenamed("k", "key"))
