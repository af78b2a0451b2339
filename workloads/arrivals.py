"""Arrival gate (G), records of outcomes (K), audit (U), the run and the streams (P)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from cellweave.operators import audit, gate
from cellweave.plans.runner import update_manifest
from cellweave.session import new_folder, tune
from cellweave.sinks import outcomes
from cellweave.streaming import watch
from cellweave.streaming.stable import stable_files
from workloads.base import derive, plain_sql, q, scan

QUERIES, SQL = {}, {}
c = F.col

# Arrivals: documents as files of twenty folders, with every kind of name, and web pages by address.
ARRIVALS = (
    "SELECT doc_id AS id, '/depot/' || source || '/' || case cast(doc_id % 10 as int) when 0 then '~$suivi.xlsx' when 1 then '.cache' "
    "when 2 then 'SUIVI.XLSX' when 3 then 'notes.csv' when 4 then 'a.b.Part' when 5 then 'releve' "
    "else 'suivi_' || cast(doc_id as string) || '.xlsx' end AS path, "
    "case when doc_id % 13 = 0 then 0 else n_chars end AS length, coalesce(ts, TIMESTAMP '2024-01-01 00:00:00') AS mtime "
    "FROM {documents} LEFT JOIN {events} ON doc_id = event_id UNION ALL "
    "SELECT 1000000000 + page_id, url, cast(length(html) as bigint), coalesce(ts, TIMESTAMP '2024-01-01 00:00:00') FROM {pages} LEFT JOIN {events} ON page_id = event_id"
)
# A listing has each path once.
LISTING = f"SELECT path, max(length) AS length, max(mtime) AS mtime, min(id) AS id FROM ({ARRIVALS}) GROUP BY path"
KEYS = ("FQT", "FNP", "SPA", "RPA", "CDP", "PAAE", "CATCLIENTS")
SETTINGS = (
    "SELECT 'FILE_PATH_' || case cast(id % 8 as int) "
    + " ".join(f"when {i} then '{k}'" for i, k in enumerate(KEYS))
    + f" else 'AUTRE' end AS env_key, case when id % 17 = 0 then ' \t ' when id % 19 = 0 then '\t' || path || ' ' else path end AS path "
    f"FROM ({LISTING}) WHERE id % 9 <> 4 UNION ALL SELECT 'FILE_PATH_RPA', path FROM ({LISTING}) WHERE id % 7 = 0"
)
MANIFEST = (
    f"SELECT path, case when length % 2 = 0 then mtime else TIMESTAMP '2024-01-10 00:00:00' end AS mtime, length FROM ({LISTING}) WHERE id % 3 > 0 "
    "UNION ALL SELECT '/depot/disparu/' || cast(n_nationkey as string), TIMESTAMP '2024-01-10 00:00:00', cast(1 as bigint) FROM {nation}"
)

_PARTS = (
    "regexp_extract(path, '[^/]*$') AS name, regexp_replace(path, '/[^/]*$', '') AS parent, "
    "regexp_extract(regexp_extract(path, '[^/]*$'), '[^.](\\.[^.]+)$', 1) AS ext"
)
_DATASET = "case env_key " + " ".join(f"when 'FILE_PATH_{k}' then '{k.lower()}'" for k in KEYS) + " end"
_ORDER = "case env_key " + " ".join(f"when 'FILE_PATH_{k}' then {i}" for i, k in enumerate(KEYS)) + " end"
CTES = (
    f"WITH arr AS MATERIALIZED (SELECT *, {_PARTS} FROM ({plain_sql(ARRIVALS)})), "
    f"lst AS MATERIALIZED (SELECT *, {_PARTS} FROM ({plain_sql(LISTING)})), "
    f"con AS MATERIALIZED (SELECT env_key, path, {_DATASET} AS dataset, {_PARTS} FROM (SELECT env_key, trim(path, ' \t') AS path FROM ({plain_sql(SETTINGS)})) "
    f"WHERE path <> '' AND {_DATASET} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY path ORDER BY {_ORDER} DESC) = 1), "
    f"man AS MATERIALIZED ({plain_sql(MANIFEST)}), "
    "nxt AS (SELECT path, length + case when id % 5 = 0 then 1 else 0 end AS length FROM lst WHERE id % 11 <> 0), "
    "gated AS (SELECT l.*, c.env_key, c.dataset, coalesce(n.length = l.length, false) AS stable, "
    "case when starts_with(l.name, '~$') or starts_with(l.name, '.') then 'Fichier temporaire/caché' "
    "when l.length = 0 then 'Fichier vide (0 octet)' "
    "when c.path is not null and lower(l.ext) not in ('.xlsx', '.xls') then 'Extension non autorisée pour un fichier attendu: ' || l.ext "
    "when c.path is null then 'Fichier non répertorié dans .env.files.* (chemin inattendu)' end AS reason "
    "FROM lst l LEFT JOIN con c ON l.path = c.path LEFT JOIN nxt n ON l.path = n.path), "
    "decided AS (SELECT *, case when reason is not null then 'reject' when not stable then 'defer' else 'run' end AS decision FROM gated)"
)


def arrivals(spark, sf):
    return gate.path_parts(derive(spark, sf, ARRIVALS))


def listing(spark, sf):
    return gate.path_parts(derive(spark, sf, LISTING))


def contract(spark, sf):
    return gate.make_contract(derive(spark, sf, SETTINGS))


def manifest(spark, sf):
    return derive(spark, sf, MANIFEST)


def second_listing(spark, sf):
    later = listing(spark, sf).filter("id % 11 <> 0")
    return later.withColumn("length", c("length") + F.when(c("id") % 5 == 0, 1).otherwise(0))


def decided(spark, sf):
    return gate.gate(gate.stability(listing(spark, sf), second_listing(spark, sf)), contract(spark, sf))


def add(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = f"{CTES} {sql}"
        return fn

    return register


@add("g01_match_contract", "SELECT l.path, c.env_key, c.dataset FROM lst l LEFT JOIN con c ON l.path = c.path")
def g01(spark, sf):
    return gate.match_contract(listing(spark, sf), contract(spark, sf)).select("path", "env_key", "dataset")


@add("g02_temporary_or_hidden", "SELECT id, name FROM arr WHERE starts_with(name, '~$') OR starts_with(name, '.')")
def g02(spark, sf):
    return arrivals(spark, sf).filter(gate.is_temp_or_hidden(c("name"))).select("id", "name")


@add("g03_empty_files", "SELECT path, reason FROM decided WHERE reason = 'Fichier vide (0 octet)'")
def g03(spark, sf):
    return decided(spark, sf).filter(c("reason") == gate.EMPTY).select("path", "reason")


@add("g04_bad_extension", "SELECT path, ext, reason FROM decided WHERE starts_with(reason, 'Extension')")
def g04(spark, sf):
    return decided(spark, sf).filter(c("reason").startswith(gate.BAD_EXTENSION)).select("path", "ext", "reason")


@add("g05_stable_files", "SELECT l.path, coalesce(n.length = l.length, false) AS stable FROM lst l LEFT JOIN nxt n ON l.path = n.path")
def g05(spark, sf):
    return gate.stability(listing(spark, sf), second_listing(spark, sf)).select("path", "stable")


@add("g06_unlisted_files", "SELECT path FROM lst WHERE path NOT IN (SELECT path FROM con)")
def g06(spark, sf):
    return gate.unlisted(listing(spark, sf), contract(spark, sf)).select("path")


@add("g07_decide_in_order", "SELECT path, decision, reason FROM decided")
def g07(spark, sf):
    return decided(spark, sf).select("path", "decision", "reason")


@add(
    "g08_new_or_updated",
    "SELECT path, mtime FROM lst l WHERE NOT EXISTS (SELECT 1 FROM man m WHERE m.path = l.path AND l.mtime <= m.mtime)",
)
def g08(spark, sf):
    return gate.new_or_updated(listing(spark, sf), manifest(spark, sf)).select("path", "mtime")


@add("g09_forget_vanished", "SELECT path, mtime FROM man WHERE path IN (SELECT path FROM lst)")
def g09(spark, sf):
    return gate.forget_vanished(manifest(spark, sf), listing(spark, sf)).select("path", "mtime")


@add(
    "g10_watch_ignores",
    "SELECT id, name FROM arr WHERE NOT (starts_with(name, '~$') OR regexp_matches(lower(name), '\\.(tmp|part|crdownload|swp|lock)$'))",
)
def g10(spark, sf):
    return arrivals(spark, sf).filter(~gate.is_ignored_by_watch(c("name"))).select("id", "name")


@add("g11_watched_folders", "SELECT DISTINCT parent FROM con")
def g11(spark, sf):
    return gate.watched_folders(contract(spark, sf))


_DEST = (
    "dests AS (SELECT *, parent || '/Archives/Rejects_' || strftime(mtime, '%Y-%m-%d_%H%M') AS dir FROM arr), "
    "nth AS (SELECT *, row_number() OVER (PARTITION BY dir, name ORDER BY mtime, path) - 1 AS i FROM dests)"
)


@add(
    "g12_archive_names",
    f", {_DEST} SELECT id, dir || '/' || left(name, length(name) - length(ext)) || case when i > 0 then '__' || i else '' end || ext AS dest FROM nth",
)
def g12(spark, sf):
    # Arrivals of one day share an archive minute, so that names collide.
    files = arrivals(spark, sf)
    return gate.destinations(files, F.lit(gate.REJECTED), c("mtime")).select("id", "dest")


SQL["g12_archive_names"] = SQL["g12_archive_names"].replace(") , dests", "), dests")

_DAY = "date_trunc('day', mtime)"


@add(
    "g12b_archive_names_crowded",
    f", dests AS (SELECT *, parent || '/Archives/Loaded_' || strftime({_DAY}, '%Y-%m-%d_%H%M') AS dir FROM arr), "
    "nth AS (SELECT *, row_number() OVER (PARTITION BY dir, name ORDER BY path, id) - 1 AS i FROM dests) "
    "SELECT dir, name, max(i) AS last FROM nth GROUP BY dir, name",
)
def g12b(spark, sf):
    files = arrivals(spark, sf).withColumn("mtime", F.date_trunc("day", c("mtime")))
    dest = gate.destinations(files, F.lit(gate.LOADED), c("mtime"))
    nth = F.coalesce(F.regexp_extract("dest", r"__(\d+)(?:\.[^./]+)?$", 1).try_cast("long"), F.lit(0))
    return dest.groupBy(c("dest_dir").alias("dir"), "name").agg(F.max(nth).alias("last"))


@add(
    "g12c_archive_names_over_runs",
    f", {_DEST}, fs AS (SELECT DISTINCT dir, name, ext FROM nth), old AS (SELECT dir, name, k FROM fs, unnest([0, 1, 3, 4]) u(k)), "
    "cand AS (SELECT dir, name, k, row_number() OVER (PARTITION BY dir, name ORDER BY k) - 1 AS i FROM "
    "(SELECT f.dir, f.name, g.k FROM fs f, range(0, (SELECT max(i) + 6 FROM nth)) g(k) WHERE NOT EXISTS "
    "(SELECT 1 FROM old o WHERE o.dir = f.dir AND o.name = f.name AND o.k = g.k))) "
    "SELECT id, n.dir || '/' || left(n.name, length(n.name) - length(n.ext)) || '__' || c.k || n.ext AS dest "
    "FROM nth n JOIN cand c ON n.dir = c.dir AND n.name = c.name AND n.i = c.i",
)
def g12c(spark, sf):
    """Numbers 0, 1, 3 and 4 of every name are taken by an earlier run: 2 comes first, then 5 and on."""
    files = arrivals(spark, sf)
    names = gate.destinations(files, F.lit(gate.REJECTED), c("mtime")).select("dest_dir", "name", "ext").distinct()
    stem = F.expr("left(name, length(name) - length(ext))")
    numbers = F.explode(F.array(*[F.lit(x) for x in ("", "__1", "__3", "__4")])).alias("number")
    taken = names.select("dest_dir", stem.alias("stem"), "ext", numbers).select(F.concat("dest_dir", F.lit("/"), "stem", "number", "ext").alias("dest"))
    return gate.destinations(files, F.lit(gate.REJECTED), c("mtime"), taken).select("id", "dest")


@add("g13_run_summary", "SELECT 'run-1' AS run_id, count(*) FILTER (decision = 'run') AS ok, count(*) FILTER (decision = 'reject') AS reject FROM decided")
def g13(spark, sf):
    files, at = decided(spark, sf), c("mtime")
    records = outcomes.loaded(files, "run-1", at).unionByName(outcomes.rejected(files, "run-1", at))
    return gate.run_summary(records)


@add("g15_blank_settings_skipped", "SELECT env_key, path, parent, dataset FROM con")
def g15(spark, sf):
    return contract(spark, sf)


_RECORD = "SELECT 'run-1' AS run_id, path, dataset, {status} AS status, {reason} AS reason FROM decided WHERE decision = {decision}"
FIELDS = ("run_id", "path", "dataset", "status", "reason")


@add("k04_rejected_records", _RECORD.format(status="'Rejects'", reason="reason", decision="'reject'"))
def k04(spark, sf):
    return outcomes.rejected(decided(spark, sf), "run-1", c("mtime")).select(*FIELDS)


@add("k05_loaded_records", _RECORD.format(status="'Loaded'", reason="cast(null as string)", decision="'run'"))
def k05(spark, sf):
    return outcomes.loaded(decided(spark, sf), "run-1", c("mtime")).select(*FIELDS)


@add(
    "p08b_manifest_after_run",
    "SELECT path, mtime FROM lst l WHERE NOT EXISTS (SELECT 1 FROM man m WHERE m.path = l.path AND l.mtime <= m.mtime) UNION ALL "
    "SELECT m.path, m.mtime FROM man m JOIN lst l ON m.path = l.path AND l.mtime <= m.mtime",
)
def p08b(spark, sf):
    seen = manifest(spark, sf).withColumn("run_id", F.lit("run-0"))
    return update_manifest(seen, listing(spark, sf), audit.Run(id="run-1")).select("path", "mtime")


# --- audit --------------------------------------------------------------------------------------------------
RUN = audit.Run(id="run-0a1b2c3d", at=datetime(2025, 1, 2, 3, 4, 5, tzinfo=timezone.utc), user="loader")


@add("u01_audit_columns", "SELECT c_custkey, '2025-01-02 03:04:05' AS created_at, 'loader' AS created_by FROM customer")
def u01(spark, sf):
    audited = audit.with_audit(scan(spark, sf, "customer").select("c_custkey"), RUN)
    return audited.withColumn("created_at", c("created_at").cast("string"))


USERS = (
    "SELECT c_custkey, case when c_custkey % 2 = 0 then '' else c_name end AS a, "
    "case when c_custkey % 3 = 0 then c_mktsegment end AS b FROM {customer}"
)


@add("u02_loader_user", f"SELECT c_custkey, coalesce(nullif(a, ''), nullif(b, ''), 'unknown') AS who FROM ({plain_sql(USERS)})")
def u02(spark, sf):
    return derive(spark, sf, USERS).select("c_custkey", audit.first_set(c("a"), c("b")).alias("who"))


@add("u03_audit_types", "SELECT 'timestamp' AS created_at, 'string' AS created_by, count(*) AS n FROM customer")
def u03(spark, sf):
    audited = audit.with_audit(scan(spark, sf, "customer"), RUN)
    types = [F.typeof(x).alias(x) for x in audit.AUDIT_TYPES]
    return audited.select(*types).groupBy(*audit.AUDIT_TYPES).agg(F.count(F.lit(1)).alias("n"))


@add("u04_run_id", "SELECT true AS well_formed, cast(1 as bigint) AS n_ids, count(*) AS n FROM decided WHERE decision = 'reject'")
def u04(spark, sf):
    records = outcomes.rejected(decided(spark, sf), audit.run_id("run-"), c("mtime"))
    return records.agg(
        F.bool_and(c("run_id").rlike("^run-[0-9a-f]{8}$")).alias("well_formed"),
        F.count_distinct("run_id").alias("n_ids"),
        F.count(F.lit(1)).alias("n"),
    )


# --- streams ------------------------------------------------------------------------------------------------

@add("p09_watch_folder")
def p09(spark, sf):
    """A stream over a growing folder, run until it has caught up, twice: each file is seen once."""
    docs = scan(spark, sf, "documents").select("doc_id", "source", (c("lang") == "en").alias("english"))
    root, seen, checkpoint = (new_folder(tune(spark), x) for x in ("watched", "seen", "stream"))

    def record(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{seen}/batch_id={batch_id}")

    for half in (True, False):
        part = docs.filter(c("english") == half).groupBy("source", "english").agg(F.count("doc_id").alias("n")).repartition("source")
        part.write.mode("append").partitionBy("english", "source").json(root)
        watch.watch(watch.arriving_files(spark, f"{root}/*/*"), checkpoint, record, None).awaitTermination()
    source = F.regexp_extract("parent", "source=(.*)$", 1).alias("source")
    return spark.read.parquet(seen).groupBy(source).agg(F.count(F.lit(1)).alias("n_files"))


SQL["p09_watch_folder"] = (
    "SELECT source, count(DISTINCT case when lang = 'en' then 1 else 0 end) AS n_files FROM documents GROUP BY source"
)


GRACE = 6 * 3600.0


@add("p09b_stable_files")
def p09b(spark, sf):
    """A stream of listings in three micro-batches; a version of a file is let through once it has been there for six hours."""
    events = scan(spark, sf, "events")
    listings = events.select(
        F.concat(F.lit("/depot/"), c("event_type"), F.lit("/"), c("user_id").cast("string")).alias("path"),
        F.floor(F.abs(c("value")) / 40).cast("long").alias("length"),
        F.date_trunc("week", c("ts")).cast("timestamp").alias("mtime"),
        c("ts").cast("timestamp").alias("listed_at"),
    )
    root, found, checkpoint = (new_folder(tune(spark), x) for x in ("listings", "stable", "stream"))
    day = F.datediff(c("listed_at"), F.lit("1970-01-01").cast("date"))
    low, high = listings.agg(F.min(day), F.max(day)).first()
    third = (high - low) / 3

    def record(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{found}/batch_id={batch_id}")

    for k in range(3):
        part = listings.filter((day >= low + third * k) & ((day < low + third * (k + 1)) | (k == 2)))
        part.write.mode("append").parquet(root)
        stream = spark.readStream.schema(listings.schema).parquet(root)
        writer = stable_files(stream, GRACE).writeStream.outputMode("update").foreachBatch(record)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    read = spark.read.schema("path string, length long, mtime timestamp, listed_at timestamp").parquet(found)
    return read.select("path", "length", c("listed_at").cast("timestamp_ntz").alias("listed_at"))


SQL["p09b_stable_files"] = (
    "WITH l AS (SELECT '/depot/' || event_type || '/' || user_id AS path, cast(floor(abs(value) / 40) as bigint) AS length, "
    "date_trunc('week', ts) AS mtime, ts AS seen_at FROM events), "
    "n AS (SELECT *, coalesce((lag(length) OVER w, lag(mtime) OVER w) <> (length, mtime), true) AS fresh FROM l "
    "WINDOW w AS (PARTITION BY path ORDER BY seen_at, mtime, length)), "
    "v AS (SELECT *, sum(fresh::int) OVER (PARTITION BY path ORDER BY seen_at, mtime, length ROWS UNBOUNDED PRECEDING) AS version FROM n), "
    "s AS (SELECT *, min(seen_at) OVER (PARTITION BY path, version) AS since FROM v) "
    "SELECT path, length, min(seen_at) AS listed_at FROM s WHERE seen_at - since >= INTERVAL 6 HOUR GROUP BY path, version, length"
)


def _feed(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return events.select(
        F.concat(F.lit("/depot/"), c("event_type"), F.lit("/"), c("user_id").cast("string")).alias("path"),
        c("ts").alias("mtime"),
        F.round(c("value") * 100).cast("long").alias("length"),
    )


_FEED_SQL = "(SELECT '/depot/' || event_type || '/' || user_id AS path, ts AS mtime, cast(round(value * 100) as bigint) AS length FROM events)"


@add("p10_latest_versions")
def p10(spark, sf):
    out, checkpoint = new_folder(tune(spark), "versions"), new_folder(spark, "stream")
    query = (
        watch.latest_versions(_feed(spark, sf))
        .writeStream.outputMode("update")
        .foreachBatch(watch.append_versions(out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return watch.read_versions(spark, out)


SQL["p10_latest_versions"] = (
    f"SELECT path, mtime, length FROM {_FEED_SQL} QUALIFY row_number() OVER (PARTITION BY path ORDER BY mtime DESC, length DESC) = 1"
)


@add("p10b_first_sightings")
def p10b(spark, sf):
    out, checkpoint = new_folder(tune(spark), "sightings"), new_folder(spark, "stream")
    feed = _feed(spark, sf).withColumn("mtime", F.date_trunc("hour", c("mtime")).cast("timestamp_ntz"))
    query = (
        watch.first_sightings(feed)
        .select("path", "mtime")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)


SQL["p10b_first_sightings"] = f"SELECT DISTINCT path, date_trunc('hour', mtime) AS mtime FROM {_FEED_SQL}"
