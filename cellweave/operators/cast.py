"""Cast: turn texts into typed columns with one projection of built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions import booleans, dates, numbers, text
from cellweave.operators.decide import SPARK_TYPES
from cellweave.plans.rules import Rules


# Holds the texts that a cast turned into null. No column has this name, since names lose their outer underscores.
LOST = "__lost"
LOST_CELLS = "array<struct<col_idx:int,name:string,text:string>>"


class TypedColumn(NamedTuple):
    """Where a column comes from and what it becomes."""

    source: str | int
    name: str
    tag: str
    method: str


def _text(c: Column, rules: Rules) -> Column:
    v = text.trimmed(c)
    return text.zero_to_null(v) if rules.zero_is_null else v


def _rewrite(v: Column, method: str, rules: Rules) -> Column:
    """From the trimmed text to the text that is parsed; parsing refers to it several times."""
    if method == "iso":
        return F.when(v.rlike(dates.ISO), v)
    if method == "day_first":
        return dates.day_first_text(v)
    if method == "month_first":
        return dates.date_text(v)
    if method in ("int", "float"):
        return numbers.clean_number(v, rules.number_style)
    return v


def _prepare(p: Column, method: str) -> Column:
    """From there to what the last step refers to several times."""
    if method in ("iso", "day_first", "month_first"):
        return dates.to_timestamp(p)
    return numbers.plain_number(p) if method == "serial" else p


def _finish(p: Column, tag: str, method: str, rules: Rules) -> Column:
    if method in ("iso", "day_first", "month_first"):
        p = dates.in_range(p)
    elif method == "serial":
        p = dates.from_serial(p, rules.serial_upper)
    elif method == "boolean":
        p = booleans.boolean_word(p)
    elif method == "int":
        p = numbers.to_integer(p)
    elif method == "float":
        p = numbers.plain_number(p)
    return p.cast(SPARK_TYPES[tag])


def cast_value(c: Column, tag: str, method: str, rules: Rules) -> Column:
    """The cast of one column as a single expression."""
    return _finish(_prepare(_rewrite(_text(c, rules), method, rules), method), tag, method, rules)


def _cast_steps(
    df: DataFrame, sources: dict[str, Column], columns: list[TypedColumn], rules: Rules, keep: list[str], lost: bool = False
) -> DataFrame:
    """The cast of many columns as four projections, so that no value is worked out twice.

    With ``lost`` the texts travel along, and a fifth projection keeps those that became null in ``LOST``.
    """
    df = df.select(*keep, *[_text(sources[c.name], rules).alias(c.name) for c in columns])
    risky = [c for c in columns if c.method != "text"] if lost else []
    if risky:
        df = df.withColumn(LOST, F.array(*[F.col(f"`{c.name}`") for c in risky]))
        keep = [*keep, LOST]
    for step in (
        [_rewrite(F.col(f"`{c.name}`"), c.method, rules).alias(c.name) for c in columns],
        [_prepare(F.col(f"`{c.name}`"), c.method).alias(c.name) for c in columns],
        [_finish(F.col(f"`{c.name}`"), c.tag, c.method, rules).alias(c.name) for c in columns],
    ):
        df = df.select(*keep, *step)
    return df.withColumn(LOST, _lost(risky)) if lost else df


def _lost(columns: list[TypedColumn]) -> Column:
    """The texts in ``LOST`` whose column is null, with column number and name; null if there is none. A blank is no text."""
    cells = []
    for i, c in enumerate(columns):
        cell = F.struct(F.lit(c.source).cast("int").alias("col_idx"), F.lit(c.name).alias("name"), F.get(LOST, F.lit(i)).alias("text"))
        cells.append(F.when((F.get(LOST, F.lit(i)) != "") & F.col(f"`{c.name}`").isNull(), cell))
    found = F.array_compact(F.array(*cells)).cast(LOST_CELLS) if cells else F.lit(None).cast(LOST_CELLS)
    return F.when(F.size(found) > 0, found)


def lost_cells(typed: DataFrame, *place: str) -> DataFrame:
    """A row for each text a cast lost: ``place``, then number and name of the column and the trimmed text."""
    return typed.select(*place, F.explode(LOST).alias("cell")).select(*place, "cell.*")


def typed_columns(decided: DataFrame, source: str = "name") -> list[TypedColumn]:
    """Collect a table's decisions: one row per column, metadata only."""
    rows = decided.orderBy("col_idx").select(source, "name", "tag", "method").collect()
    return [TypedColumn(*r) for r in rows]


def cast_table(df: DataFrame, columns: Iterable[TypedColumn], rules: Rules, keep: Iterable[str] = ()) -> DataFrame:
    """Typed projection of a table of texts; ``keep`` passes columns through."""
    columns = list(columns)
    sources = {c.name: text.na_to_null(F.col(f"`{c.source}`").cast("string")) for c in columns}
    return _cast_steps(df, sources, columns, rules, list(keep))


def cast_rows(
    rows: DataFrame, columns: Iterable[TypedColumn], rules: Rules, keep: Iterable[str] = (), lost: bool = False
) -> DataFrame:
    """Typed projection of grid rows: each column is a position of the array. ``lost`` adds the column ``LOST``."""
    columns = list(columns)
    sources = {c.name: F.get("values", F.lit(c.source)) for c in columns}
    return _cast_steps(rows, sources, columns, rules, list(keep), lost)
