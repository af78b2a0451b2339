"""Column profile: every statistic the type decision needs, in one aggregation over the cells.

Cells are in long form, so a table of hundreds of columns costs one narrow aggregate whose partial
sums are combined before the shuffle. Cells are first counted by text, after texts that no statistic tells apart
were made equal, so that the statistics come from one look at each text, by weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cellweave.functions import booleans, dates, numbers, text
from cellweave.plans.rules import Rules
from cellweave.session import settle

# Above 0, columns are counted by text only where that leaves at most one cell in so many before the shuffle, which takes two more
# looks at all cells. It is for tables with long columns of texts that ``alike`` leaves different.
SHRINKS = 0

# Shorter texts are few, and may be words with a meaning.
SHORT, WORDY = 6, 12
# Whole numbers above all spreadsheet dates that are no dates as they stand, and what stands for them.
LARGE = 3_000_000
LARGE_WHOLE = "^(?:[3-9][0-9]{6}|[1-9][0-9]{3}(?!(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])$)[0-9]{4}|[1-9][0-9]{8,17})$"
# Amounts with a comma and two decimals. The decimals are kept, and below 100,000 the thousands, since from these on a rule may take an
# amount as whole that is nearly so; 999 may be rounded to the next thousand.
GROUP = "[ \xa0\u202f.]?"
AMOUNT = f"^[+-]?(?:[0-9]{{1,2}}{GROUP})?(?!999)[0-9]{{3}},[0-9]{{2}}\\z"
LARGE_AMOUNTS = (
    (f"^(?<sign>[+-]?)[1-9][0-9]{{2}}(?<group>{GROUP})[0-9]{{3}},(?<cents>[0-9]{{2}})$", "${sign}111${group}111,${cents}"),
    (
        f"^(?<sign>[+-]?)[1-9][0-9]{{0,2}}(?<first>{GROUP})[0-9]{{3}}(?<second>{GROUP})[0-9]{{3}},(?<cents>[0-9]{{2}})$",
        "${sign}1${first}111${second}111,${cents}",
    ),
)
# Times of day other than midnight, after a date.
_DAY = "^(?<day>[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}[ T])"
_CLOCK = "(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
TIMES = (
    (f"{_DAY}(?!00:00:00$){_CLOCK}$", "${day}12:34:56"),
    (f"{_DAY}(?!00:00:00[.]0+$){_CLOCK}[.][0-9]{{1,6}}$", "${day}12:34:56.5"),
)
# Letters in no number and in no time.
LETTER = "(?i)[abcdghj-mo-su-xz]"


def cell_facts(cells: DataFrame, rules: Rules, keep: list[str]) -> DataFrame:
    """What one cell is: trimmed text, parsed dates and numbers, one column each.

    Each step is a projection of its own, so that what several columns need is computed once. What
    a text can be narrows down quickly: without a digit it is neither date nor finite number, and a
    plain number is a date only when it has four or eight digits. ``is_zero`` marks the zeros that
    were made null; the dates still have to be checked against the accepted range.
    """
    v, has_digit = F.col("text"), F.col("has_digit")
    zero = v == "0" if rules.zero_is_null else F.lit(False)
    upper = rules.serial_upper if rules.serial_upper is not None else 0.0
    cells = cells.select(
        *keep, text.trimmed(F.col("value")).alias("text"), F.col("value").rlike("[0-9]").alias("has_digit")
    )
    cells = cells.select(
        *keep,
        F.when(~zero, v).alias("text"),
        zero.alias("is_zero"),
        has_digit,
        F.when(has_digit, F.when(~zero, numbers.finite_number(v))).otherwise(numbers.infinite_number(v)).alias("number"),
    )
    number = F.col("number")
    mixed, length = has_digit & number.isNull(), F.length(v)
    cells = cells.select(
        *keep,
        "text",
        "is_zero",
        "number",
        F.when(mixed & length.isin(10, 19), F.when(v.rlike(dates.ISO), v)).alias("iso_text"),
        F.when(mixed | (has_digit & length.isin(4, 8)), dates.date_text(v)).alias("date_text"),
        # Without a digit only the infinite words can be a number, and these begin with an i.
        F.when(F.when(has_digit, number.isNotNull() & ~v.contains(".")).otherwise(~v.rlike("^[^a-zA-Z]*[iI]")), v)
        .otherwise(numbers.clean_number(v, rules.number_style))
        .alias("cleaned"),
        booleans.boolean_word(v).alias("boolean"),
        (number.isNull() & dates.has_date_token(v)).alias("has_token"),
    )
    cleaned = F.col("cleaned")
    # Of its own, since the test of its months and days and the cast both refer to it.
    cells = cells.withColumn("swapped", dates.swap_day_month(F.col("date_text")))
    return cells.select(
        *keep,
        "text",
        "is_zero",
        F.col("iso_text").isNotNull().alias("is_iso"),
        dates.to_timestamp(F.col("iso_text")).alias("iso"),
        dates.to_timestamp(F.col("date_text")).alias("month_first"),
        dates.to_timestamp(F.col("swapped")).alias("day_first"),
        "number",
        F.when(cleaned == v, number).otherwise(numbers.plain_number(cleaned)).alias("number_like"),
        dates.from_serial(number, upper).alias("serial"),
        "boolean",
        "has_token",
    )


def alike(c: Column) -> Column:
    """A text with the same statistics under all rules, the same for as many texts as possible; columns of amounts, times, numbers of
    documents or free text have few.

    Amounts lose their last three digits, times of day become one, whole numbers too large for dates as well, and
    texts of some length that are neither date nor number keep only whether they have a sign of a date. Other texts stay as they are.
    """

    def replaced(v: Column, forms: tuple[tuple[str, str], ...]) -> Column:
        for pattern, replacement in forms:
            v = F.regexp_replace(v, pattern, replacement)
        return v

    size = F.octet_length(c)
    amount = F.concat(F.left(c, F.length(c) - 6), F.lit("111"), F.right(c, F.lit(3)))
    # Most dates are told by their separators, without a pattern.
    whole = F.when(~c.contains("/") & ~c.contains("-") & ~c.contains(".") & c.rlike(LARGE_WHOLE), str(LARGE)).otherwise(c)
    # A date with a month by name has letters, too.
    free = c.rlike(LETTER) & ~text.trimmed(c).rlike(dates.WORD_SHAPE)
    return (
        F.when(size < SHORT, c)
        .when(c.contains(",") & c.rlike(AMOUNT), amount)
        .when(size < WORDY, F.when(c.contains(","), replaced(c, LARGE_AMOUNTS)).otherwise(whole))
        .when(c.contains(":") & ~c.rlike("[a-zA-SU-Z]"), replaced(c, TIMES))
        .when(free, F.when(dates.has_date_token(c), "jan").otherwise("x"))
        .when(c.contains(","), replaced(c, LARGE_AMOUNTS))
        .otherwise(whole)
    )


def weighted(cells: DataFrame, by: list[str]) -> DataFrame:
    """Cells with a ``weight``: the different texts of a column with their numbers, counted within tasks before the shuffle.

    With ``SHRINKS`` it is measured first by how many different texts each task has of a column, since that many rows are
    left before the shuffle; where more than a share of 1 / ``SHRINKS`` would be left, cells stay as they are and are not shuffled.
    """
    if not SHRINKS:
        return cells.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("weight"))
    in_task = cells.groupBy(*by, F.spark_partition_id()).agg(
        F.approx_count_distinct("value").alias("texts"), F.count(F.lit(1)).alias("cells")
    )
    # Metadata: a row for each column, which is looked up for every cell.
    sizes = settle(in_task.groupBy(*by).agg((F.sum("texts") * SHRINKS <= F.sum("cells")).alias("repeats")))
    marked = cells.select(*by, "value").join(sizes, by)
    often = marked.filter("repeats").groupBy(*by, "value").agg(F.count(F.lit(1)).alias("weight"))
    return often.unionByName(marked.filter("not repeats").select(*by, "value", F.lit(1).cast("long").alias("weight")))


def _statistics(rules: Rules) -> list[Column]:
    def cells(where: Column | None = None) -> Column:
        """Number of cells, by weight."""
        weight = F.col("weight")
        return F.sum(weight if where is None else F.when(where, weight).otherwise(0))

    def count_dates(c: str, name: str) -> list[Column]:
        ok = dates.is_in_range(F.col(c))
        return [
            cells(ok).alias(f"n_{name}"),
            cells(ok & dates.has_time(F.col(c))).alias(f"n_{name.removesuffix('_parsed')}_timed"),
        ]

    def present(c: str) -> Column:
        return F.col(c).isNotNull()

    in_range = F.col("number").between(
        dates.SERIAL_MIN, rules.serial_upper if rules.serial_upper is not None else 0.0
    )
    integral = numbers.is_close_to_integral if rules.close_is_integral else numbers.is_integral
    is_zero = F.col("is_zero")
    return [
        cells().alias("n_cells"),
        (cells(present("text")) + cells(is_zero)).alias("n_value"),
        (cells(F.col("text") != "") + cells(is_zero)).alias("n_filled"),
        (cells(~F.col("text").isin("", "nan")) + cells(is_zero)).alias("n_not_nan"),
        cells(present("text")).alias("n_nonnull"),
        cells(F.col("text") != "").alias("n_text"),
        cells(F.col("is_iso")).alias("n_iso"),
        *count_dates("iso", "iso_parsed"),
        cells(present("number")).alias("n_number"),
        cells(in_range).alias("n_in_range"),
        *count_dates("serial", "serial"),
        cells(F.col("has_token")).alias("n_token"),
        *count_dates("day_first", "day_first"),
        *count_dates("month_first", "month_first"),
        cells(present("boolean")).alias("n_boolean"),
        cells(present("number_like")).alias("n_number_like"),
        F.coalesce(F.bool_and(integral(F.col("number_like"))), F.lit(False)).alias("all_integral"),
    ]


def _profile(cells: DataFrame, rules: Rules, by: list[str]) -> DataFrame:
    # Large whole numbers are told apart by rules that take them for dates alone.
    value = alike(F.col("value")) if (rules.serial_upper or 0) < LARGE else F.col("value")
    facts = cell_facts(weighted(cells.select(*by, value.alias("value")), by), rules, [*by, "weight"])
    return facts.groupBy(*by).agg(*_statistics(rules))


def profile_cells(cells: DataFrame, rules: Rules, by: list[str]) -> DataFrame:
    """Profile the column ``value`` per group of ``by``; ``n`` is the number of cells."""
    return _profile(cells, rules, by).withColumnRenamed("n_cells", "n")


def profile_table(df: DataFrame, rules: Rules, columns: list[str] | None = None) -> DataFrame:
    """Profile the columns of a table of untyped texts; one row per column."""
    columns = columns or df.columns
    position = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    return profile_cells(melt(df, columns), rules, ["name"]).withColumn(
        "col_idx", F.element_at(position, F.col("name"))
    )


def melt(df: DataFrame, columns: list[str]) -> DataFrame:
    texts = [text.na_to_null(F.col(f"`{c}`").cast("string")).alias(c) for c in columns]
    return df.select(*texts).unpivot([], columns, "name", "value")


def profile_body(body: DataFrame, headers: DataFrame, rules: Rules) -> DataFrame:
    """Profile the rows below the headers per (path, sheet, column).

    Cells carry the number of their sheet instead of its path and name, which are looked up in the
    small result. Rows may be ragged, so ``n`` is the sheet's number of rows: every row has a first
    position, whose count is carried to the other columns.
    """
    cells = body.select("sheet_id", F.posexplode("values").alias("col_idx", "value"))
    by = ["sheet_id", "col_idx"]
    stats = _profile(cells, rules, by).withColumn("n", F.max("n_cells").over(Window.partitionBy("sheet_id"))).drop("n_cells")
    return headers.select("sheet_id", "path", "sheet", "sheet_idx").join(stats, "sheet_id").drop("sheet_id")


def ratios(profile: DataFrame) -> DataFrame:
    """The same statistics as shares of all rows, for reports."""
    n = F.col("n")
    shares = {
        "iso_ratio": "n_iso",
        "num_ratio": "n_number",
        "serial_ratio": "n_in_range",
        "token_ratio": "n_token",
        "bool_ratio": "n_boolean",
        "numlike_ratio": "n_number_like",
    }
    return profile.withColumns({k: F.col(c) / n for k, c in shares.items()})


def sheet_report(profile: DataFrame) -> DataFrame:
    """Rows and columns per sheet."""
    return profile.groupBy("path", "sheet").agg(
        F.max("n").alias("n_rows"), F.count(F.lit(1)).alias("n_cols")
    )
