"""Arrival gate: which arrived files are loaded, rejected or left for later.

Arrivals: (path, name, parent, ext, length, mtime). Contract: (env_key, path, parent, dataset).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.text import trimmed
from cellweave.operators.dedupe import number_within
from cellweave.plans.rules import DATASET_KEYS

# Name rules and reasons, as recorded by the source system.
ALLOWED_EXTENSIONS = (".xlsx", ".xls")
IGNORED_SUFFIXES = (".tmp", ".part", ".crdownload", ".swp", ".lock")
TEMP_OR_HIDDEN = "Fichier temporaire/caché"
EMPTY = "Fichier vide (0 octet)"
BAD_EXTENSION = "Extension non autorisée pour un fichier attendu: "
UNLISTED = "Fichier non répertorié dans .env.files.* (chemin inattendu)"

RUN, REJECT, DEFER = "run", "reject", "defer"
LOADED, REJECTED = "Loaded", "Rejects"


def path_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Add name, parent and extension (with its dot) of a path."""
    p = F.col(path)
    name = F.regexp_extract(p, "[^/]*$", 0)
    return df.withColumns(
        {
            "name": name,
            "parent": F.regexp_replace(p, "/[^/]*$", ""),
            "ext": F.regexp_extract(name, r"[^.](\.[^.]+)$", 1),
        }
    )


def make_contract(settings: DataFrame) -> DataFrame:
    """Contract from (env_key, path): other keys and blank paths are skipped; of several keys of a path the last counts."""
    datasets = F.create_map(*[F.lit(x) for pair in DATASET_KEYS.items() for x in pair])
    places = F.create_map(*[F.lit(x) for i, key in enumerate(DATASET_KEYS) for x in (key, i)])
    # A listing writes the scheme of local files with one slash.
    path = F.regexp_replace(trimmed(F.col("path")), "^file:/+", "file:/")
    listed = settings.filter(F.col("env_key").isin(*DATASET_KEYS)).withColumn("path", path)
    last = listed.filter("path <> ''").groupBy("path").agg(
        F.max_by("env_key", F.element_at(places, F.col("env_key"))).alias("env_key")
    )
    return path_parts(last).select(
        "env_key", "path", "parent", F.element_at(datasets, F.col("env_key")).alias("dataset")
    )


def missing_settings(settings: DataFrame) -> DataFrame:
    """Required settings that are null or blank."""
    return settings.filter(F.coalesce(trimmed(F.col("value")), F.lit("")) == "").select("key")


def watched_folders(contract: DataFrame) -> DataFrame:
    return contract.select("parent").distinct()


def match_contract(arrivals: DataFrame, contract: DataFrame) -> DataFrame:
    """Attach dataset and key to listed files. Catalyst broadcasts the contract if it is small."""
    return arrivals.join(contract.select("path", "env_key", "dataset"), "path", "left")


def unlisted(arrivals: DataFrame, contract: DataFrame) -> DataFrame:
    return arrivals.join(contract, "path", "left_anti")


def is_temp_or_hidden(name: Column) -> Column:
    return name.startswith("~$") | name.startswith(".")


def is_ignored_by_watch(name: Column) -> Column:
    low = F.lower(name)
    out = name.startswith("~$")
    for suffix in IGNORED_SUFFIXES:
        out = out | low.endswith(suffix)
    return out


def allowed_extension(ext: Column) -> Column:
    return F.lower(ext).isin(*ALLOWED_EXTENSIONS)


def stability(first: DataFrame, second: DataFrame) -> DataFrame:
    """Compare two listings: a file is stable when it is in both with the same length."""
    later = second.select("path", F.col("length").alias("_later"))
    return (
        first.join(later, "path", "left")
        .withColumn("stable", F.coalesce(F.col("_later") == F.col("length"), F.lit(False)))
        .drop("_later")
    )


def gate(arrivals: DataFrame, contract: DataFrame) -> DataFrame:
    """Decide every arrival, first rule wins. ``stable`` is optional and defaults to true."""
    files = match_contract(arrivals, contract)
    stable = F.col("stable") if "stable" in arrivals.columns else F.lit(True)
    listed = F.col("env_key").isNotNull()
    temp, empty = is_temp_or_hidden(F.col("name")), F.coalesce(F.col("length"), F.lit(0)) == 0
    bad_ext = listed & ~allowed_extension(F.col("ext"))
    return files.withColumns(
        {
            "decision": F.when(temp | empty | bad_ext, REJECT)
            .when(listed & ~stable, DEFER)
            .when(listed, RUN)
            .otherwise(REJECT),
            "reason": F.when(temp, TEMP_OR_HIDDEN)
            .when(empty, EMPTY)
            .when(bad_ext, F.concat(F.lit(BAD_EXTENSION), F.col("ext")))
            .when(~listed, UNLISTED),
        }
    )


def new_or_updated(arrivals: DataFrame, manifest: DataFrame) -> DataFrame:
    """Arrivals not seen yet, or seen with an older modification time."""
    seen = manifest.select(F.col("path").alias("_path"), F.col("mtime").alias("_mtime"))
    known = (F.col("path") == F.col("_path")) & (F.col("mtime") <= F.col("_mtime"))
    return arrivals.join(seen, known, "left_anti")


def forget_vanished(manifest: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Manifest entries whose file is still there."""
    return manifest.join(arrivals.select("path"), "path", "left_semi")


def taken_numbers(dests: DataFrame) -> DataFrame:
    """``dest_dir``, ``name``, ``nth`` of archive paths (``dest``): the numbers of a name that they occupy.

    ``a__2.xlsx`` is number 2 of ``a.xlsx``, and also number 0 of its own name.
    """
    name = F.regexp_extract("dest", "[^/]*$", 0)
    numbered = r"^(.*)__([1-9][0-9]{0,8})((?:\.[^./]+)?)$"
    own = F.struct(name.alias("name"), F.lit(0).cast("long").alias("nth"))
    base = F.concat(F.regexp_extract(name, numbered, 1), F.regexp_extract(name, numbered, 3))
    other = F.struct(base.alias("name"), F.regexp_extract(name, numbered, 2).try_cast("long").alias("nth"))
    both = F.when(name.rlike(numbered), F.array(own, other)).otherwise(F.array(own))
    return dests.select(F.regexp_replace("dest", "/[^/]*$", "").alias("dest_dir"), F.inline(both)).distinct()


def free_numbers(taken: DataFrame) -> DataFrame:
    """``dest_dir``, ``name``, ``start``, ``before``, ``length``: runs of numbers that are free between and behind those taken.

    ``before`` counts the free numbers of the runs before; the last run has no end. Taken numbers become runs first, numbered
    bucket by bucket, so a crowded name is split over tasks and only its runs are put in order.
    """
    key = ["dest_dir", "name"]
    numbered = number_within(taken, key, F.floor(F.col("nth") / 4096), [F.col("nth")], "_i")
    runs = numbered.groupBy(*key, (F.col("nth") - F.col("_i")).alias("_run")).agg(F.min("nth").alias("low"), F.max("nth").alias("high"))
    order = Window.partitionBy(*key).orderBy("low")
    runs = runs.withColumns({"next": F.lead("low").over(order), "first": F.row_number().over(order) == 1})
    gap = F.struct((F.col("high") + 1).alias("start"), (F.col("next") - F.col("high") - 1).alias("length"))
    head = F.struct(F.lit(0).cast("long").alias("start"), F.col("low").alias("length"))
    gaps = runs.select(*key, F.inline(F.when(F.col("first"), F.array(head, gap)).otherwise(F.array(gap))))
    earlier = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = gaps.withColumn("before", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    return counted.filter("length is null or length > 0")


def destinations(decided: DataFrame, status: Column, at: Column, taken: DataFrame | None = None) -> DataFrame:
    """Archive path of each file; a name already taken in its folder gets ``__i`` before the suffix.

    ``taken`` holds archive paths of earlier runs (``dest``); files get the least numbers that these leave free.
    """
    stamp = F.date_format(at, "yyyy-MM-dd_HHmm")
    folder = F.concat_ws("/", F.col("parent"), F.lit("Archives"), F.concat_ws("_", status, stamp))
    stem = F.when(F.col("ext") == "", F.col("name")).otherwise(
        F.expr("left(name, length(name) - length(ext))")
    )
    numbered = number_within(
        decided.withColumn("dest_dir", folder),
        ["dest_dir", "name"],
        F.date_trunc("second", at),
        [at, F.col("path")],
        "_nth",
    )
    numbered = numbered.withColumn("_nth", F.col("_nth").cast("long") - 1)
    if taken is not None:
        free = free_numbers(taken_numbers(taken)).withColumnsRenamed({"dest_dir": "_dir", "name": "_name"})
        free = free.withColumnRenamed("length", "_length")
        here = (F.col("dest_dir") == F.col("_dir")) & (F.col("name") == F.col("_name")) & (F.col("_nth") >= F.col("before"))
        here = here & (F.col("_length").isNull() | (F.col("_nth") < F.col("before") + F.col("_length")))
        number = F.coalesce(F.col("start") + F.col("_nth") - F.col("before"), F.col("_nth"))
        numbered = numbered.join(free, here, "left").withColumn("_nth", number).drop("_dir", "_name", "start", "before", "_length")
    nth = F.col("_nth")
    return numbered.withColumn(
        "dest",
        F.concat(
            F.col("dest_dir"),
            F.lit("/"),
            stem,
            F.when(nth > 0, F.concat(F.lit("__"), nth.cast("string"))).otherwise(""),
            F.col("ext"),
        ),
    ).drop("_nth")


def run_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("run_id").agg(
        F.count_if(F.col("status") == LOADED).alias("ok"),
        F.count_if(F.col("status") == REJECTED).alias("reject"),
    )
