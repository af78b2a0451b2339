"""Jobs: grid rows of a dataset to typed, audited tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions import numbers, text
from cellweave.operators import cast, decide, profile, shape
from cellweave.operators.audit import Run, with_audit
from cellweave.operators.dedupe import dedupe_labels
from cellweave.plans import rules as R
from cellweave.plans.rules import Rules
from cellweave.session import new_folder, settle, task_count

# Where a lost text stood. The names are given outer underscores, which no column of a sheet has.
LOST_PLACE = ("__path", "__sheet_idx", "__row_idx")
CATEGORY_TABLE = "dim_client_categories"
AUDIT_SQL_TYPES = {"created_at": "TIMESTAMP WITH TIME ZONE", "created_by": "TEXT"}
STAGED_ROWS = 250_000
PAYMENT_COLUMNS = ("code_condition", "libelle", "delai_source")


@dataclass(frozen=True)
class TypedTable:
    """One output table: its frame, its SQL column types and how many texts the cast lost."""

    path: str
    name: str
    frame: DataFrame
    sql_types: dict[str, str]
    lost_values: int = 0
    losses: DataFrame | None = None  # the texts lost, with their place, where these are wanted and there are any


# --- tables of untyped text -----------------------------------------------------------------------

def decide_table(df: DataFrame, rules: Rules, columns: list[str] | None = None) -> DataFrame:
    """Profile and decide the columns of a table whose header is known."""
    stats = profile.profile_table(df, rules, columns)
    hint = F.col("name") if rules.hint_name == "column" else text.fold(F.col("name"))
    hint = text.snake(F.col("name")) if rules.hint_name == "snake" else hint
    return decide.decide(stats.withColumn("hint", hint), rules)


def type_table(df: DataFrame, rules: Rules, columns: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed version of a table of texts: one pass to profile, one projection to cast."""
    columns = columns or [c for c in df.columns if c not in keep]
    return cast.cast_table(df, cast.typed_columns(decide_table(df, rules, columns)), rules, keep)


# --- sheets ---------------------------------------------------------------------------------------

def stage(rows: DataFrame, by_sheet: bool = True) -> tuple[DataFrame, str]:
    """Write grid rows without blank rows to the shared folder, one partition folder per sheet; the rows and the folder.

    Header search, profile and one cast per sheet read them again; without this a workbook would
    be decoded every time, and a cast would read sheets other than its own. Where sheets are read together, without ``by_sheet``, they
    share files, one for each task, so that their number does not grow with the sheets.
    """
    spark = rows.sparkSession
    path = new_folder(spark, "staged")
    keyed = shape.drop_blank_rows(rows).withColumn("sheet_key", sheet_key(F.col("path"), F.col("sheet_idx")))
    # Rows of a sheet are dealt together, in parts, so that a sheet is a few files and not one for each task.
    spread = F.floor(F.coalesce("row_idx", F.lit(0)) / STAGED_ROWS)
    if by_sheet:
        keyed.repartition("sheet_key", spread).write.partitionBy("sheet_key").parquet(path)
    else:
        keyed.repartition(task_count(spark), "sheet_key", spread).write.parquet(path)
    return spark.read.schema(keyed.schema).parquet(path), path


def sheet_key(path: Column, sheet_idx: Column) -> Column:
    """Names the folder of a sheet's staged rows."""
    return F.md5(F.concat_ws("|", path, sheet_idx.cast("string")))


def decide_sheets(rows: DataFrame, rules: Rules, blanks_dropped: bool = False) -> DataFrame:
    """Decisions for every column of every sheet: metadata, with the header's position."""
    headers = shape.find_headers(rows, rules, blanks_dropped)
    stats = profile.profile_body(shape.body_rows(rows, headers, blanks_dropped), headers, rules)
    decided = decide.decide(shape.name_columns(stats, headers, rules), rules)
    return decided.join(headers.select(*shape.SHEET_KEY, "header_row"), shape.SHEET_KEY)


def skipped_sheets(sheets: DataFrame, decided: DataFrame) -> DataFrame:
    """Sheets with nothing left after shaping."""
    return sheets.join(decided, shape.SHEET_KEY, "left_anti")


def sheet_counts(rows: DataFrame) -> DataFrame:
    """Number of sheets per workbook."""
    return rows.groupBy("path").agg(F.count_distinct("sheet_idx").alias("n_sheets"))


def sheet_tables(sheets: DataFrame, counts: DataFrame, rules: Rules, within: tuple[str, ...] = ()) -> DataFrame:
    """Path, sheet_idx and target table of each sheet; no two sheets, or none within a group, have the same table."""
    base = text.snake(F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1))
    each = sheets.select("path", "sheet", "sheet_idx").distinct().join(counts, "path")
    named = each.withColumn("table", shape.table_name(base, F.col("sheet"), F.col("n_sheets"), rules.cut_table_name))
    return shape.unique_tables(settle(named.select("path", "sheet_idx", "table")), rules.cut_table_name, within)


def typed_sheets(
    staged: DataFrame, rules: Rules, counts: DataFrame | None = None, losses: bool = False
) -> Iterator[TypedTable]:
    """The typed table of each sheet, with the places of lost texts if ``losses`` are wanted.

    ``staged`` comes from ``stage``. Decisions stream to the driver sheet by sheet, so the number
    of sheets is not bounded; each yielded frame reads one sheet only.
    """
    decided = settle(decide_sheets(staged, rules, blanks_dropped=True))
    tables = sheet_tables(decided, counts if counts is not None else sheet_counts(staged), rules)
    named = decided.join(tables, ["path", "sheet_idx"])
    ordered = named.select(
        "path", "sheet_idx", "table", "header_row", "col_idx", "name", "tag", "method", "lost_values"
    ).orderBy("path", "sheet_idx", "col_idx")
    for _, group in groupby(ordered.toLocalIterator(), key=lambda r: (r.path, r.sheet_idx)):
        columns = list(group)
        yield _typed_sheet(staged, columns, rules, losses)


def _typed_sheet(staged: DataFrame, columns: list, rules: Rules, losses: bool) -> TypedTable:
    first = columns[0]
    key = sheet_key(F.lit(first.path), F.lit(first.sheet_idx))
    rows = staged.filter((F.col("sheet_key") == key) & (F.col("row_idx") > first.header_row))
    typed = [cast.TypedColumn(c.col_idx, c.name, c.tag, c.method) for c in columns]
    kinds, n_lost = decide.sql_types(rules), sum(c.lost_values for c in columns)
    frame, lost = split_losses(rows, typed, rules) if losses and n_lost else (cast.cast_rows(rows, typed, rules), None)
    return TypedTable(first.path, first.table, frame, {c.name: kinds[c.tag] for c in typed}, n_lost, lost)


def split_losses(
    rows: DataFrame, columns: list[cast.TypedColumn], rules: Rules, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Cast rows once, written down with the texts lost beside the typed columns; the typed rows, and the lost texts with their place.

    Each frame reads its own columns of what was written.
    """
    placed = rows.withColumns({p: F.col(p.strip("_")) for p in LOST_PLACE})
    written = settle(cast.cast_rows(placed, columns, rules, [*keep, *LOST_PLACE], lost=True))
    lost = cast.lost_cells(written, *keep, *LOST_PLACE)
    return written.drop(*LOST_PLACE, cast.LOST), lost.withColumnsRenamed({p: p.strip("_") for p in LOST_PLACE})


def keep_losses(lost: DataFrame, folder: str, run: Run) -> None:
    """Store lost texts by run and table; tables a run writes again replace their own."""
    writer = lost.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("table").parquet(f"{folder.rstrip('/')}/run_id={run.id}")


# --- datasets with a fixed shape --------------------------------------------------------------------

def payment_terms(rows: DataFrame, rules: Rules = R.CDP) -> DataFrame:
    """First sheet by position; codes and delays become integers only when all of them are."""
    grid = shape.drop_blank_rows(rows.filter("sheet_idx = 0"))
    return _payment_columns(shape.project_positions(grid, PAYMENT_COLUMNS), rules)


def _payment_columns(table: DataFrame, rules: Rules) -> DataFrame:
    code = text.trimmed(F.col("code_condition"))
    gates = [F.coalesce(F.bool_and(code.rlike("^[0-9]+$")), F.lit(True)).alias("code")]
    if "delai_source" in table.columns:
        delay = numbers.number_like(F.col("delai_source"), rules.number_style)
        gates.append(F.coalesce(F.bool_and(numbers.is_integral(delay)), F.lit(True)).alias("delay"))
    whole = table.agg(*gates).first()
    out = {"libelle": text.trimmed(F.col("libelle"))}
    if whole.code:
        out["code_condition"] = numbers.integer_like(F.col("code_condition"), rules.number_style)
    if "delai_source" in table.columns and whole.delay:
        out["delai_source"] = numbers.integer_like(F.col("delai_source"), rules.number_style)
    return table.withColumns(out).select(*[c for c in PAYMENT_COLUMNS if c in table.columns])


def client_categories(rows: DataFrame, rules: Rules = R.CATCLIENTS) -> DataFrame:
    """All sheets stacked by canonical name, one row per label, labels with a category first."""
    headers = shape.find_headers(rows, rules)
    # A column without any value on its sheet is no column of that sheet.
    stats = shape.column_counts(shape.rows_to_cells(shape.body_rows(rows, headers)))
    filled = stats.filter(shape.column_survives(rules)).select(*shape.SHEET_KEY, "col_idx")
    cells = shape.header_columns(headers).join(filled, [*shape.SHEET_KEY, "col_idx"], "left_semi")
    cells = settle(cells.withColumn("name", shape.canonical_name(F.col("name"))))
    present = {r.name for r in cells.filter(F.col("name").isin(*shape.CATEGORY_COLUMNS)).select("name").distinct().collect()}
    if "libelle" not in present:
        raise ValueError("no sheet has the column libelle")
    columns = tuple(c for c in shape.CATEGORY_COLUMNS if c in present)
    stacked = shape.stack_sheets(rows, headers, columns, cells)
    clean = stacked.withColumns({c: text.clean_text(F.col(c)) for c in columns})
    return shape.keep_listed(dedupe_labels(clean, ["sheet_idx", "row_idx"]), shape.CATEGORY_COLUMNS)


# --- one dataset -------------------------------------------------------------------------------------

def typed_tables(
    dataset: str, rows: DataFrame, counts: DataFrame | None = None, losses: bool = False
) -> Iterator[TypedTable]:
    """Output tables of a dataset's grid rows. The rows should be staged."""
    if dataset in R.INFERRED:
        yield from typed_sheets(rows, R.INFERRED[dataset], counts, losses)
        return
    if dataset == "cdp":
        # Each workbook is a table of its own, with its own columns and types.
        books = rows.select("path").distinct()
        base = text.snake(F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1))
        named = settle(books.select("path", F.lit(0).alias("sheet_idx"), text.cut_identifier(base).alias("table")))
        for book in shape.unique_tables(named).orderBy("path").toLocalIterator():
            frame = payment_terms(rows.filter(F.col("path") == book.path))
            kinds = {"bigint": R.CDP.sql_integer, "string": "TEXT"}
            yield TypedTable(book.path, book.table, frame, {n: kinds[t] for n, t in frame.dtypes})
    elif dataset == "catclients":
        frame = client_categories(rows)
        path = rows.agg(F.min("path")).first()[0] or ""
        yield TypedTable(path, CATEGORY_TABLE, frame, dict.fromkeys(frame.columns, "TEXT"))
    else:
        raise ValueError(f"unknown dataset {dataset}")


@dataclass
class LoadReport:
    """What a load did: rows written, texts lost by casts, and why a table was not written."""

    rows: int = 0
    tables: int = 0
    lost_values: int = 0
    problems: list[str] = field(default_factory=list)

    def note(self) -> str | None:
        """What did not go as it should, for the record of the outcome."""
        lost = [f"{self.lost_values} values lost"] if self.lost_values else []
        return "; ".join([*self.problems, *lost]) or None


def load_dataset(
    dataset: str,
    rows: DataFrame,
    sink,
    run: Run,
    counts: DataFrame | None = None,
    taken: dict[str, str] | None = None,
    load_id: str | None = None,
    losses: str | None = None,
) -> LoadReport:
    """Write every table of a dataset with audit columns. ``load_id`` names the load to the sink, by default the run does.
    ``losses`` names a folder that keeps the texts casts lost, with their place.

    A table that fails on its data is reported and the others go on. ``taken`` holds the tables this run
    has written with their file; a table another file has written is refused, never overwritten.
    """
    report, taken = LoadReport(), {} if taken is None else taken
    for table in typed_tables(dataset, rows, counts, losses is not None):
        if taken.setdefault(table.name, table.path) != table.path:
            report.problems.append(f"{table.name}: already written in this run from {taken[table.name]}")
            continue
        audited = with_audit(table.frame, run)
        count = F.count(F.lit(1)).alias("n")
        observed = _observe(audited, count)
        try:
            known = sink.write(observed[0], table.name, {**table.sql_types, **AUDIT_SQL_TYPES}, load_id or run.id)
        except Exception as error:
            if not is_data_error(error):
                raise
            report.problems.append(f"{table.name}: {cause(error)}")
            continue
        # A sink that has the load already writes nothing, so nothing was observed.
        report.rows += observed[1].get["n"] if known is None else known
        report.tables += 1
        report.lost_values += table.lost_values
        if table.losses is not None:
            keep_losses(table.losses.withColumn("table", F.lit(table.name)), losses, run)
    return report


def is_data_error(error: Exception) -> bool:
    """Whether the file is at fault: bad content, not a lost executor, a full disk, a stopped session or a worker without the package."""
    text_ = str(error)
    if re.search(r"\b(ModuleNotFoundError|ImportError)\b", text_):
        return False
    lost = ("ExecutorLostFailure", "FetchFailed", "No space left", "OutOfMemory", "SparkContext was shut down", "Job aborted due to stage failure: Task not serializable")
    return isinstance(error, (ValueError, PySparkException)) and not any(x in text_ for x in lost)


def cause(error: Exception) -> str:
    """The innermost cause in one line; errors of Python workers begin with empty lines and a trace."""
    lines = [x.strip() for x in str(error).splitlines() if x.strip()]
    told = [x for x in lines if not x.startswith(("at ", "File ", "Traceback", "JVM stacktrace", "***", "..."))]
    errors = [x for x in told if re.match(r"[\w.]*(Error|Exception|BadZipFile)\b.*: ?\S", x)]
    return f"{type(error).__name__}: {(errors or told or ['no message'])[-1 if errors else 0][:300]}"


def _observe(df: DataFrame, metric):
    """Count rows while they are written, without another pass."""
    from pyspark.sql import Observation

    observation = Observation()
    return df.observe(observation, metric), observation
