"""Many workbooks of one dataset in one load.

All workbooks are opened, decoded, staged, profiled and decided together. Sheets that come out with the same columns, types and
ways of casting share a layout; each layout is cast and written once, partitioned by table, and the sink then takes every
table's files as they are. So the number of jobs follows the number of layouts, few where workbooks follow a form, and not the
number of workbooks, and a table is the only folder a workbook costs: what is written before lies in files of many sheets. A sink that cannot take files, such as a database, writes each table from them.

Nothing is handed to a sink before every layout is written: a load that fails as a whole has left nothing behind.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators import cast, decide, shape
from cellweave.operators.audit import Run, with_audit
from cellweave.plans import rules as R
from cellweave.plans.ingest import AUDIT_SQL_TYPES, STAGED_ROWS, LoadReport, cause, decide_sheets, is_data_error, keep_losses, sheet_key, sheet_tables, split_losses, stage
from cellweave.plans.rules import Rules
from cellweave.session import new_folder, scratch_space, settle, task_count
from cellweave.sinks.tables import can_adopt, hand_over
from cellweave.sources.listing import SCHEME
from cellweave.sources.workbook import BROKEN_ROW, decode_sheets, list_sheets_of

# No column of a sheet has this name, since names lose their outer underscores.
TABLE = "__table"


@dataclass
class FileResult:
    """What became of a file: a report, or the error that rejects it; and the seconds until it was done."""

    report: LoadReport
    seconds: float = 0.0
    error: Exception | None = None


def has_scheme(path: str) -> bool:
    return re.match(SCHEME, path) is not None


def load_together(
    spark: SparkSession,
    dataset: str,
    files: dict[str, str | None],
    sink,
    run: Run,
    taken: dict[str, str] | None = None,
    losses: str | None = None,
) -> dict[str, FileResult]:
    """Load the workbooks, given as path and id of its load (None: the run's).

    The paths all have a scheme, or none of them has. ``taken`` and ``losses`` are as in ``load_dataset``; of workbooks whose tables have the
    same name the first by path has it. A file's seconds are those from the start of the load to its last table.
    """
    if len({has_scheme(p) for p in files}) > 1:
        raise ValueError("paths with a scheme and paths without one cannot be loaded together")
    with scratch_space(spark, "together"):
        return _load_together(spark, R.INFERRED[dataset], files, sink, run, {} if taken is None else taken, losses)


def _load_together(
    spark: SparkSession, rules: Rules, files: dict[str, str | None], sink, run: Run, taken: dict[str, str], losses: str | None
) -> dict[str, FileResult]:
    started = time.perf_counter()
    results = {path: FileResult(LoadReport()) for path in files}
    sheets = settle(list_sheets_of(spark, list(files)))
    seen = sheets.groupBy("path").agg(F.max("n_sheets").alias("n_sheets"), F.max("error").alias("error")).collect()
    if {r.path for r in seen} != set(files):
        raise ValueError("not every workbook was found")
    for r in seen:
        if r.error:
            results[r.path].error = ValueError(r.error)
    staged, _ = stage(decode_sheets(sheets.filter("error is null"), report_errors=True), by_sheet=False)
    bad = settle(staged.filter(F.col("row_idx") == BROKEN_ROW).select(*shape.SHEET, F.get("values", F.lit(0)).alias("why")))
    for r in bad.orderBy("path", "sheet_idx").collect():  # at most a row for each sheet
        results[r.path].report.problems.append(f"{r.sheet}: {r.why}")
    layouts = sheet_layouts(staged.join(bad, shape.SHEET_KEY, "left_anti"), sheets, rules)

    planned, refused = [], []
    for t in layouts.select(*shape.SHEET_KEY, "sheet_key", "table", "layout", "lost_values").orderBy(*shape.SHEET_KEY).collect():
        if taken.setdefault(t.table, t.path) == t.path:
            planned.append(t)
        else:
            results[t.path].report.problems.append(f"{t.table}: already written in this run from {taken[t.table]}")
            refused.append((t.sheet_key,))
    if refused:
        layouts = settle(layouts.join(spark.createDataFrame(refused, "sheet_key string"), "sheet_key", "left_anti"))

    folder = new_folder(spark, "tables")
    body = _body(staged, layouts)
    written = _write_layouts(body, layouts, rules, run, folder, losses)
    counts = {r[TABLE]: r["count"] for r in body.groupBy(TABLE).count().collect()} if written else {}
    adopts = cache(lambda: can_adopt(sink, spark, folder))  # asked once, for all tables
    for t in planned:
        result, (schema, types) = results[t.path], written[t.layout]
        try:
            source = f"{folder}/layout={t.layout}/{TABLE}={t.table}"
            known = hand_over(sink, spark, source, schema, t.table, types, files[t.path] or run.id, adopts())
        except Exception as error:
            if not is_data_error(error):
                raise
            result.report.problems.append(f"{t.table}: {cause(error)}")
        else:
            result.report.rows += counts[t.table] if known is None else known
            result.report.tables += 1
            result.report.lost_values += t.lost_values
        result.seconds = time.perf_counter() - started
    for result in results.values():
        result.seconds = result.seconds or time.perf_counter() - started
        if result.report.problems and not result.report.tables and not result.error:
            result.error = ValueError("; ".join(result.report.problems))
    return results


def sheet_layouts(rows: DataFrame, sheets: DataFrame, rules: Rules) -> DataFrame:
    """A record for each sheet that has columns: its table, header row, columns, lost values, and its layout.

    Sheets with equal columns in equal places, of equal types, have the same layout.
    """
    decided = settle(decide_sheets(rows, rules, blanks_dropped=True))
    counts = sheets.groupBy("path").agg(F.max("n_sheets").alias("n_sheets"))
    tables = sheet_tables(decided, counts, rules, within=("path",))
    columns = F.sort_array(F.collect_list(F.struct("col_idx", "name", "tag", "method")))
    each = decided.groupBy(*shape.SHEET_KEY).agg(
        columns.alias("columns"), F.max("header_row").alias("header_row"), F.sum("lost_values").alias("lost_values")
    )
    key = sheet_key(F.col("path"), F.col("sheet_idx"))
    named = each.join(tables, shape.SHEET_KEY).withColumns({"layout": F.md5(F.to_json("columns")), "sheet_key": key})
    return settle(named)


def _body(staged: DataFrame, layouts: DataFrame) -> DataFrame:
    """Rows below the headers with their layout and table; dealt by layout if there are several, so that each cast reads its own rows."""
    where = layouts.select("sheet_key", "header_row", "layout", F.col("table").alias(TABLE))
    body = staged.join(where, "sheet_key").filter(F.col("row_idx") > F.col("header_row"))
    if not layouts.agg(F.min("layout") < F.max("layout")).first()[0]:
        return body
    spark, path = body.sparkSession, new_folder(body.sparkSession, "dealt")
    spread = F.floor(F.col("row_idx") / STAGED_ROWS)
    body.repartition(task_count(spark), "layout", "sheet_key", spread).write.partitionBy("layout").parquet(path)
    return spark.read.schema(body.schema).parquet(path)


def _write_layouts(
    body: DataFrame, layouts: DataFrame, rules: Rules, run: Run, folder: str, losses: str | None
) -> dict[str, tuple]:
    """Write the tables of each layout into a folder of its own; schema and SQL types of each layout."""
    kinds, written = decide.sql_types(rules), {}
    forms = layouts.groupBy("layout").agg(F.first("columns").alias("columns"), F.sum("lost_values").alias("n_lost"))
    for form in forms.toLocalIterator():
        columns = [cast.TypedColumn(c.col_idx, c.name, c.tag, c.method) for c in form.columns]
        rows = body.filter(F.col("layout") == form.layout)
        if losses and form.n_lost:
            typed, lost = split_losses(rows, columns, rules, keep=(TABLE,))
            keep_losses(lost.withColumnRenamed(TABLE, "table"), losses, run)
        else:
            typed = cast.cast_rows(rows, columns, rules, keep=(TABLE,))
        audited = with_audit(typed, run)
        audited.write.partitionBy(TABLE).parquet(f"{folder}/layout={form.layout}")
        types = {**{c.name: kinds[c.tag] for c in columns}, **AUDIT_SQL_TYPES}
        written[form.layout] = (audited.drop(TABLE).schema, types)
    return written

