"""Type decision: one ordered chain of conditions over the column profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, LongType, StringType, TimestampNTZType

from cellweave.functions.text import has_any
from cellweave.plans import rules as R
from cellweave.plans.rules import Rules

SPARK_TYPES: dict[str, DataType] = {
    "DATE": DateType(),
    "DATETIME": TimestampNTZType(),
    "INT": LongType(),
    "FLOAT": DoubleType(),
    "BOOL": BooleanType(),
    "STRING": StringType(),
}


def sql_types(rules: Rules) -> dict[str, str]:
    """Tag to SQL column type, for database sinks."""
    return {
        "DATE": "DATE",
        "DATETIME": "TIMESTAMP",
        "INT": rules.sql_integer,
        "FLOAT": "DOUBLE PRECISION",
        "BOOL": "BOOLEAN",
        "STRING": "TEXT",
    }


def _share(c: str) -> Column:
    return F.col(c) / F.col("n")


def _timed(method: str, rules: Rules) -> Column:
    """Share of values with a time of day; some rules count a value that did not parse as timed."""
    timed, parsed = F.col(f"n_{method}_timed"), F.col("n_iso_parsed" if method == "iso" else f"n_{method}")
    if rules.null_is_timed:
        share = (timed + F.col("n") - parsed) / F.col("n")
    else:
        share = F.try_divide(timed, parsed)
    return F.coalesce(share > R.TIMED_SHARE, F.lit(False))


def _date_tag(method: str, rules: Rules) -> Column:
    return F.struct(
        F.when(_timed(method, rules), "DATETIME").otherwise("DATE").alias("tag"),
        F.lit(method).alias("method"),
    )


def _tag(tag: str, method: str) -> Column:
    return F.struct(F.lit(tag).alias("tag"), F.lit(method).alias("method"))


def decision(rules: Rules, hint: Column) -> Column:
    """Struct (tag, method); the first condition that holds wins."""
    month_wins = F.col("n_month_first") > F.col("n_day_first")
    parsed = F.greatest("n_month_first", "n_day_first") / F.col("n")
    best_date = F.when(month_wins, _date_tag("month_first", rules)).otherwise(_date_tag("day_first", rules))
    any_number = F.col("n_number_like") > 0
    number = F.when(F.col("all_integral") & any_number, _tag("INT", "int")).otherwise(_tag("FLOAT", "float"))
    dated_name = has_any(hint, rules.date_words)

    chain: list[tuple[Column, Column]] = []
    if rules.forced_dates:
        forced = hint.isin(*rules.forced_dates)
        chain += [
            (forced & (_share("n_iso") >= R.ISO_SHARE), _date_tag("month_first", rules)),
            (forced, best_date),
        ]
    if rules.text_words:
        chain.append((has_any(hint, rules.text_words), _tag("STRING", "text")))
    if rules.float_words or rules.float_names:
        money = has_any(hint, rules.float_words) | hint.isin(*rules.float_names)
        chain.append((money & any_number, _tag("FLOAT", "float")))
    if rules.iso_rule:
        iso = (_share("n_iso") >= R.ISO_SHARE) & (_share("n_iso_parsed") >= R.ISO_SHARE)
        chain.append((iso, _date_tag("iso", rules)))
    if rules.serial_upper is not None:
        serial = (
            (_share("n_number") >= R.NUMERIC_SHARE)
            & (_share("n_serial") >= R.SERIAL_SHARE)
        )
        chain.append((serial & dated_name if rules.serial_needs_name else serial, _date_tag("serial", rules)))
    chain.append(
        (
            (dated_name & (parsed >= rules.ok_with_name))
            | ((_share("n_token") >= R.TOKEN_SHARE) & (parsed >= F.when(dated_name, rules.ok_with_name).otherwise(rules.ok_with_tokens))),
            best_date,
        )
    )
    chain.append((_share("n_boolean") >= R.BOOLEAN_SHARE, _tag("BOOL", "boolean")))
    if rules.amount_words:
        chain.append((has_any(hint, rules.amount_words) & any_number, number))
    if rules.code_words:
        chain.append((has_any(hint, rules.code_words), _tag("STRING", "text")))
    chain.append((_share("n_number_like") >= R.NUMBER_SHARE, number))

    expr = F.when(*chain[0])
    for condition, outcome in chain[1:]:
        expr = expr.when(condition, outcome)
    return expr.otherwise(_tag("STRING", "text"))


def decide(profile: DataFrame, rules: Rules, hint: str = "hint") -> DataFrame:
    """Add ``tag``, ``method`` and ``lost_values`` (texts the cast will turn into null)."""
    decided = profile.withColumn("_d", decision(rules, F.col(hint)))
    method = F.col("_d.method")
    kept = (
        F.when(method == "iso", F.col("n_iso_parsed"))
        .when(method == "serial", F.col("n_serial"))
        .when(method == "day_first", F.col("n_day_first"))
        .when(method == "month_first", F.col("n_month_first"))
        .when(method == "boolean", F.col("n_boolean"))
        .when(method.isin("int", "float"), F.col("n_number_like"))
        .otherwise(F.col("n_text"))
    )
    return decided.withColumns(
        {"tag": F.col("_d.tag"), "method": method, "lost_values": F.col("n_text") - kept}
    ).drop("_d")


def decide_uniform(profile: DataFrame) -> DataFrame:
    """Every column is text."""
    return profile.withColumns({"tag": F.lit("STRING"), "method": F.lit("text"), "lost_values": F.lit(0).cast("long")})
