"""Grid shaping: from headerless rows to named columns.

The engine's main form is one record per sheet row, ``ROWS``: (path, sheet, sheet_idx, row_idx,
values array<string>). Row-level work is then narrow, and turning a sheet into a wide table needs
no pivot. The long form, ``CELLS``, has one record per cell. ``row_idx`` keeps the order of the
rows; it need not be dense.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions import text
from cellweave.plans.rules import Rules
from cellweave.session import settle

SHEET = ["path", "sheet", "sheet_idx"]
SHEET_KEY = ["path", "sheet_idx"]
ROWS = "path string, sheet string, sheet_idx int, row_idx bigint, values array<string>"
CELLS = "path string, sheet string, sheet_idx int, row_idx bigint, col_idx int, value string"
LATIN_LETTER = "[A-Za-zÀ-ÿ]"


# --- conversions -------------------------------------------------------------------------------

def rows_to_cells(rows: DataFrame) -> DataFrame:
    return rows.select(*SHEET, "row_idx", F.posexplode("values").alias("col_idx", "value"))


def pivot_cells(cells: DataFrame, n_cols: int) -> DataFrame:
    """Cells to one wide record per row; the pivot values are given, so no extra job finds them.

    Texts are aggregated by sorting, so cells are dealt by row first: a task sorts its share of the rows, not what it has read and unpacked.
    """
    wide = (
        cells.repartition(*SHEET, "row_idx")
        .groupBy(*SHEET, "row_idx")
        .pivot("col_idx", list(range(n_cols)))
        .agg(F.first("value", ignorenulls=True))
    )
    return wide.toDF(*SHEET, "row_idx", *[f"c{i}" for i in range(n_cols)])


def cells_to_rows(cells: DataFrame, n_cols: int) -> DataFrame:
    wide = pivot_cells(cells, n_cols)
    return wide.select(*SHEET, "row_idx", F.array(*[f"c{i}" for i in range(n_cols)]).alias("values"))


# --- empty rows and columns ---------------------------------------------------------------------

def drop_blank_rows(rows: DataFrame) -> DataFrame:
    """Keep rows with at least one value; narrow, no shuffle."""
    return rows.filter(F.exists("values", lambda v: v.isNotNull()))


def column_counts(cells: DataFrame) -> DataFrame:
    """Per column: values, values that are not blank, values that are neither blank nor ``nan``."""
    stripped = text.trimmed(F.col("value"))
    return cells.groupBy(*SHEET, "col_idx").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count("value").alias("n_value"),
        F.count_if(stripped != "").alias("n_filled"),
        F.count_if(~stripped.isin("", "nan")).alias("n_not_nan"),
    )


def column_survives(rules: Rules) -> Column:
    """Whether a profiled column is kept, by the dataset's rule for blank columns."""
    if rules.blank_rule == "all_blank":
        return (F.col("n_value") > 0) & ((F.col("n_filled") > 0) | (F.col("n_value") < F.col("n")))
    if rules.blank_rule == "blank_or_nan":
        return F.col("n_not_nan") > 0
    return F.col("n_filled") > 0


# --- header -------------------------------------------------------------------------------------

def head_rows(rows: DataFrame, scan: int, blanks_dropped: bool = False) -> DataFrame:
    """The first rows of each sheet which hold a value, with their position.

    Only the row numbers are ranked: the rank filter runs per task before the shuffle, so a sheet
    of any size sends at most ``scan`` numbers per task. The few rows wanted are then read by
    number. Rows staged without blanks are ranked without reading their values.
    """
    order = Window.partitionBy(*SHEET_KEY).orderBy("row_idx")
    live = rows if blanks_dropped else drop_blank_rows(rows)
    first = live.select(*SHEET_KEY, "row_idx").withColumn("position", F.row_number().over(order))
    first = settle(first.filter(F.col("position") <= scan))
    last = first.agg(F.max("row_idx")).first()[0]
    wanted = rows.filter(F.col("row_idx") <= F.lit(last))
    return wanted.join(first, [*SHEET_KEY, "row_idx"])


def score_rows(head: DataFrame, rules: Rules) -> DataFrame:
    """Keyword hits and text density of header candidates.

    Density is relative: a missing cell prints as ``nan`` in the source system and scores like
    text, which adds three times the number of columns to every row of a sheet alike.
    """
    values = F.col("values")
    hits = F.size(F.filter(values, lambda v: text.has_any(text.fold(v), rules.header_words)))
    present = F.size(F.filter(values, lambda v: v.isNotNull()))
    blank = F.size(F.filter(values, lambda v: text.is_blank(v)))
    latin = F.size(F.filter(values, lambda v: v.rlike(LATIN_LETTER)))
    return head.withColumns({"hits": hits, "density": latin - present - 2 * blank})


def find_headers(rows: DataFrame, rules: Rules, blanks_dropped: bool = False) -> DataFrame:
    """One header per sheet: (path, sheet, sheet_idx, header_row, header_values, hits, sheet_id).

    The result is metadata and is settled, since names, bodies and profiles all refer to it;
    ``sheet_id`` numbers the sheets within it.
    """
    scored = score_rows(head_rows(rows, rules.scan, blanks_dropped), rules)
    enough = F.col("hits") >= rules.min_hits
    by_density = F.col("density") if rules.density_fallback else F.lit(0)
    late = F.col("position") if rules.last_density_wins else -F.col("position")
    rank = F.struct(
        enough,
        F.when(enough, F.col("hits")).otherwise(by_density),
        F.when(enough, -F.col("position")).otherwise(late),
    )
    best = F.max_by(F.struct("row_idx", "values", "hits"), rank)
    headers = scored.groupBy(*SHEET).agg(best.alias("b"))
    return settle(
        headers.select(
            *SHEET,
            F.col("b.row_idx").alias("header_row"),
            F.col("b.values").alias("header_values"),
            F.col("b.hits").alias("hits"),
            F.monotonically_increasing_id().alias("sheet_id"),
        )
    )


def body_rows(rows: DataFrame, headers: DataFrame, blanks_dropped: bool = False) -> DataFrame:
    """Rows below the header of their sheet."""
    where = headers.select(*SHEET_KEY, "header_row", "sheet_id")
    body = rows.join(where, SHEET_KEY).filter(F.col("row_idx") > F.col("header_row"))
    return body if blanks_dropped else drop_blank_rows(body)


# --- column names -------------------------------------------------------------------------------

def unique_names(columns: DataFrame, by: list[str], name: str = "name") -> DataFrame:
    """Second ``a`` becomes ``a_2``. The groups are the columns of one sheet, so they are small."""
    nth = F.row_number().over(Window.partitionBy(*by, name).orderBy("col_idx"))
    return (
        columns.withColumn("_nth", nth)
        .withColumn(name, F.when(F.col("_nth") == 1, F.col(name)).otherwise(F.concat_ws("_", name, "_nth")))
        .drop("_nth")
    )


def header_columns(headers: DataFrame) -> DataFrame:
    """Header cells with their snake-case name, one row per column."""
    cells = headers.select(*SHEET, F.posexplode("header_values").alias("col_idx", "header"))
    return cells.withColumn("name", text.snake(F.col("header")))


def name_columns(profile: DataFrame, headers: DataFrame, rules: Rules) -> DataFrame:
    """Attach names and the text the type hints look at to profiled columns; drop blank columns."""
    columns = header_columns(headers)
    if rules.unique_before_drop:
        columns = unique_names(columns, SHEET_KEY)
    named = (
        profile.join(columns.select(*SHEET_KEY, "col_idx", "header", "name"), [*SHEET_KEY, "col_idx"], "left")
        .withColumn("name", F.coalesce("name", F.lit("col")))
        .filter(column_survives(rules))
    )
    hint = {
        "column": F.col("name"),
        "header": F.coalesce(text.fold(F.col("header")), F.lit("")),
        "snake": F.col("name"),
    }[rules.hint_name]
    named = named.withColumn("hint", hint)
    return named if rules.unique_before_drop else unique_names(named, SHEET_KEY)


# Header names that mean one of the three client category columns.
CATEGORY_SYNONYMS = {
    "libelle": "libelle",
    "top_custo_hfm": "top_custo_hfm",
    "top_custo": "top_custo_hfm",
    "top": "top_custo_hfm",
    "categorie": "categorie",
    "category": "categorie",
}
CATEGORY_COLUMNS = ("libelle", "top_custo_hfm", "categorie")


def canonical_name(name: Column) -> Column:
    """Canonical column name of a snake-case header."""
    synonyms = F.create_map(*[F.lit(x) for pair in CATEGORY_SYNONYMS.items() for x in pair])
    return F.when(name.contains("top") & name.contains("hfm"), "top_custo_hfm").otherwise(
        F.coalesce(F.try_element_at(synonyms, name), name)
    )


def keep_listed(df: DataFrame, listed: tuple[str, ...]) -> DataFrame:
    """Keep the listed columns that exist; none at all is an error."""
    kept = [c for c in listed if c in df.columns]
    if not kept:
        raise ValueError("none of the expected columns exists: " + ", ".join(listed))
    return df.select(*kept)


def stack_sheets(
    rows: DataFrame, headers: DataFrame, columns: tuple[str, ...], cells: DataFrame | None = None
) -> DataFrame:
    """Stack all sheets by canonical column name; a sheet without a column gives nulls.

    One plan for any number of sheets: each sheet's positions are looked up, not one union branch
    per sheet. When a sheet has a name twice, its first column is taken.
    """
    if cells is None:
        cells = header_columns(headers).withColumn("name", canonical_name(F.col("name")))
    positions = cells.groupBy(*SHEET_KEY).agg(
        *[F.min(F.when(F.col("name") == c, F.col("col_idx"))).alias(f"_{c}") for c in columns]
    )
    body = body_rows(rows, headers).join(positions, SHEET_KEY)
    return body.select(*SHEET, "row_idx", *[F.get("values", F.col(f"_{c}")).alias(c) for c in columns])


def project_positions(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Give the first columns that hold any value fixed names; every row is data.

    Returns the names that the grid can fill: all of them, or one less. Fewer is an error.
    """
    filled = (
        column_counts(rows_to_cells(rows))
        .filter("n_value > 0")
        .groupBy("col_idx")
        .count()
        .orderBy("col_idx")
        .limit(len(names))
        .collect()
    )
    found = [r.col_idx for r in filled]
    if len(found) < len(names) - 1:
        raise ValueError(f"fewer than {len(names) - 1} columns hold values")
    return rows.select(*SHEET, "row_idx", *[F.get("values", F.lit(i)).alias(n) for i, n in zip(found, names)])


def unique_tables(sheets: DataFrame, cut: bool = True, within: tuple[str, ...] = ()) -> DataFrame:
    """Number table names that several sheets would have: the second ``t`` becomes ``t__2``.

    ``sheets`` has a row for each sheet (path, sheet_idx, table). Names are numbered by path and sheet, cut
    again so that the number fits, and numbered once more should a numbered name be taken already.
    ``within`` names columns inside whose groups alone names have to differ.
    """
    while sheets.groupBy(*within, "table").count().where("count > 1").limit(1).count():
        by_place = Window.partitionBy(*within, "table").orderBy("path", "sheet_idx")
        nth = F.concat(F.lit("__"), F.row_number().over(by_place).cast("string"))
        sheets = sheets.withColumn("_nth", nth)
        room = F.lit(text.IDENTIFIER_LENGTH) - F.length("_nth") if cut else F.length("table")
        numbered = F.concat(F.left("table", room), "_nth")
        sheets = sheets.withColumn("table", F.when(F.col("_nth") == "__1", F.col("table")).otherwise(numbered)).drop("_nth")
    return sheets


def table_name(base: Column, sheet: Column, n_sheets: Column, cut: bool = True) -> Column:
    """Target table of a sheet: the file's name, with the sheet's when there are several."""
    name = F.when(n_sheets == 1, base).otherwise(F.concat_ws("__", base, text.snake(sheet)))
    return text.cut_identifier(name) if cut else name
