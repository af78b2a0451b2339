"""One run: gate all arrivals, load the accepted files, record every outcome."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators import gate
from cellweave.operators.audit import Run
from cellweave.plans import rules as R
from cellweave.plans.ingest import LoadReport, cause, is_data_error, load_dataset, stage
from cellweave.plans.together import FileResult, has_scheme, load_together
from cellweave.session import new_folder, remove, scratch_space, settle
from cellweave.sinks import outcomes
from cellweave.sources.listing import list_arrivals, literal_path
from cellweave.sources.workbook import BROKEN_ROW, decode_sheets, list_sheets

GRACE_SECONDS = 2.0


def decide_arrivals(
    spark: SparkSession, contract: DataFrame, folders: Iterable[str], grace: float = GRACE_SECONDS
) -> DataFrame:
    """List the folders twice, ``grace`` seconds apart, and gate what is there. The first listing is written down."""
    folders = list(folders)
    first = settle(list_arrivals(spark, folders))  # listed here and now, not when the frame is read
    time.sleep(grace)
    return gate.gate(gate.stability(first, list_arrivals(spark, folders)), contract)


def version_id(path: str, mtime, length: int) -> str:
    """Names a file as it was when it was listed, so that a load of the same content has the same id."""
    return hashlib.md5(f"{path}|{mtime}|{length}".encode()).hexdigest()


def load_file(
    spark: SparkSession,
    path: str,
    dataset: str,
    sink,
    run: Run,
    taken: dict[str, str] | None = None,
    load_id: str | None = None,
    losses: str | None = None,
) -> LoadReport:
    """Load one accepted workbook; one without any readable table raises, so that it is recorded as rejected.

    What the load writes down on its way is removed at its end.
    """
    with scratch_space(spark, "load"):
        return _load_file(spark, path, dataset, sink, run, taken, load_id, losses)


def _load_file(
    spark: SparkSession,
    path: str,
    dataset: str,
    sink,
    run: Run,
    taken: dict[str, str] | None,
    load_id: str | None,
    losses: str | None,
) -> LoadReport:
    sheets = settle(list_sheets(spark, literal_path(path), first_only=dataset == "cdp").withColumn("path", F.lit(path)))
    problem = sheets.filter("error is not null").select("error").first()
    if problem:
        raise ValueError(problem.error)
    counts = sheets.groupBy("path").agg(F.max("n_sheets").alias("n_sheets"))
    staged, _ = stage(decode_sheets(sheets, report_errors=True))
    broken = staged.filter(F.col("row_idx") == BROKEN_ROW).select("sheet_idx", "sheet", F.get("values", F.lit(0)).alias("why"))
    broken = broken.orderBy("sheet_idx").collect()  # at most a row for each sheet of the workbook
    sound = staged.filter(~F.col("sheet_idx").isin(*[r.sheet_idx for r in broken])) if broken else staged
    report = load_dataset(dataset, sound, sink, run, counts, taken, load_id, losses)
    report.problems[:0] = [f"{r.sheet}: {r.why}" for r in broken]
    if report.problems and not report.tables:
        raise ValueError("; ".join(report.problems))
    return report


def run_once(
    spark: SparkSession,
    contract: DataFrame,
    sink,
    run: Run | None = None,
    grace: float = GRACE_SECONDS,
    arrivals: DataFrame | None = None,
    store: str | None = None,
    repeatable: bool = False,
    losses: str | None = None,
) -> DataFrame:
    """Gate, load and record. One file's failure does not stop the others, nor does one sheet's.

    With ``store`` the outcomes are kept in that folder, one part for each run, and nothing else of the run stays; without
    it the returned frame reads the decisions in the shared folder. A fault of the cluster rather than of a file ends the
    run. A ``repeatable`` run names loads by the files' versions, so that a sink that publishes takes each version once.
    ``losses`` names a folder that keeps, by run and table, each text a cast lost, with its place.

    Accepted files are at most the files the contract lists, so a record for each on the driver is bounded by the contract. Workbooks
    of one dataset whose types are inferred load together (``together``), the others one after another, groups by
    their first path. Returns the outcomes of the run.
    """
    run = run or Run()
    contract = contract.persist()
    folder = new_folder(spark, "decided")
    with scratch_space(spark, "listed"):
        if arrivals is None:
            folders = [r.parent for r in gate.watched_folders(contract).orderBy("parent").toLocalIterator()]
            gated = decide_arrivals(spark, contract, folders, grace)
        else:
            gated = gate.gate(arrivals, contract)
        gated.write.parquet(folder)
    decided = spark.read.schema(gated.schema).parquet(folder)
    try:
        records = _outcomes(spark, decided, sink, run, repeatable, outcomes.taken(spark, store, run.id) if store else None, losses)
        return outcomes.append(records, store, run.id) if store else records
    finally:
        contract.unpersist()
        if store:
            remove(spark, folder)


def _load(
    spark: SparkSession, dataset: str, loads: dict[str, str | None], sink, run: Run, taken: dict[str, str], losses: str | None = None
) -> dict[str, FileResult]:
    """Load the files of a dataset together, or one after another if one of them spoils the load of all."""
    if len(loads) > 1:
        tried = dict(taken)
        try:
            results = load_together(spark, dataset, loads, sink, run, tried, losses)
            taken.update(tried)
            return results
        except (ValueError, PySparkException) as error:
            if not is_data_error(error):
                raise
    results = {}
    for path, load_id in loads.items():
        started, result = time.perf_counter(), FileResult(LoadReport())
        try:
            result.report = load_file(spark, path, dataset, sink, run, taken, load_id, losses)
        except (ValueError, PySparkException) as error:
            if not is_data_error(error):
                raise
            result.error = error
        result.seconds = time.perf_counter() - started
        results[path] = result
    return results


def _outcomes(
    spark: SparkSession, decided: DataFrame, sink, run: Run, repeatable: bool, taken_dests: DataFrame | None, losses: str | None
) -> DataFrame:
    """Load the accepted files; the records of all files."""
    results, taken = [], {}
    accepted = decided.filter(F.col("decision") == gate.RUN).orderBy("path").collect()  # files the contract lists
    groups: dict[tuple, list] = {}
    for f in accepted:
        groups.setdefault((f.dataset, has_scheme(f.path)) if f.dataset in R.INFERRED else (f.path,), []).append(f)
    for files in groups.values():
        loads = {f.path: version_id(f.path, f.mtime, f.length) if repeatable else None for f in files}
        for path, result in _load(spark, files[0].dataset, loads, sink, run, taken, losses).items():
            if result.error:
                results.append((path, None, result.seconds, f"ETL failed: {cause(result.error)}", None))
            else:
                results.append((path, result.report.rows, result.seconds, None, result.report.note()))

    done = spark.createDataFrame(results, "path string, rows long, duration_s double, problem string, note string")
    tried = decided.drop("reason").join(done, "path")
    at = F.lit(run.at)
    failed = tried.filter("problem is not null").withColumns({"decision": F.lit(gate.REJECT), "reason": F.col("problem")})
    fine = tried.filter("problem is null").withColumnRenamed("note", "reason")
    refused = decided.filter(F.col("decision") == gate.REJECT)
    return (
        outcomes.rejected(refused, run.id, at, taken_dests)
        .unionByName(outcomes.rejected(failed, run.id, at, taken_dests))
        .unionByName(outcomes.loaded(fine, run.id, at, taken_dests))
    )


def update_manifest(manifest: DataFrame, arrivals: DataFrame, run: Run) -> DataFrame:
    """The manifest after a run: vanished files forgotten, latest time of the others."""
    current = arrivals.select("path", "mtime", "length", F.lit(run.id).alias("run_id"))
    changed = gate.new_or_updated(current, manifest)
    kept = gate.forget_vanished(manifest, arrivals).join(changed.select("path"), "path", "left_anti")
    return kept.unionByName(changed)
