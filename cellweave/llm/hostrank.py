"""URL filters from rules and from the links between hosts.

A page's URL is judged by the longest rule that fits it. Hosts of pages that no rule decides are judged by the link graph with two
personalised PageRanks: trust starts at hosts with pages the rules allow and follows links, each host dealing its score over its own links;
distrust starts at hosts with pages the rules block and follows links backwards, each host dealing its score over those who link there.
A seed's mass is the share of its pages that are judged so, whatever their number, and scores are not scaled, so a host is judged by its
own two scores: it is blocked if any distrust reaches it and that is no less than its trust and the word of its own undecided pages.
These speak for a host that has judged pages as well; a host without any is judged by its links alone, and more links to
other hosts take nothing from the distrust of the one it links to.

Hosts and links are added up before they are shuffled; each round joins scores with links and adds up again, and is
a written table. Host tables are joined by shuffle, where adaptive execution splits a host with many pages.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import discard, keep, written

LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def small_letters(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return small_letters(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule], value: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """``source``, ``target``, ``weight``: the links from pages of one host to another one."""
    targets = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1)
    each = pages.select(host_of(F.col("url")).alias("source"), F.explode(targets).alias("target"))
    each = each.select("source", small_letters(F.col("target")).alias("target"))
    each = each.where("source <> '' and source <> target")
    return each.groupBy("source", "target").agg(F.count("*").cast("double").alias("weight"))


def seeds(judged: DataFrame) -> DataFrame:
    """``host``, ``trust`` and ``distrust``: the shares of a host's pages that rules allow and block; hosts with any of them."""
    shares = judged.where("host <> ''").groupBy("host").agg(
        (F.count_if(F.col("rule_verdict") == "allow") / F.count("*")).alias("trust"),
        (F.count_if(F.col("rule_verdict") == "block") / F.count("*")).alias("distrust"),
    )
    return shares.where("trust + distrust > 0")


def propagate(links: DataFrame, start: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """``kind``, ``host``, ``score``: personalised PageRank of each kind from ``seed``, distrust over links reversed.

    The mass of hosts without links on is not dealt again. Ends when a round moves less than ``tolerance`` of the seeds' mass,
    which takes at most as many rounds as the damping needs to fall below it.
    """
    spark = links.sparkSession
    forward = links.select(F.lit("trust").alias("kind"), "source", "target", "weight")
    backward = links.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    both = forward.unionByName(backward)
    out = both.groupBy("kind", "source").agg(F.sum("weight").alias("out"))
    steps, steps_at = written(both.join(out, ["kind", "source"]).selectExpr("kind", "source", "target", "weight / out as share"), "steps")
    base = keep(start.select("kind", "host", "seed"), "seeds")
    mass = base.agg(F.sum("seed")).first()[0] or 0.0
    scores, path = base.withColumnRenamed("seed", "score"), None
    while mass:
        passed = scores.join(steps, (scores["kind"] == steps["kind"]) & (scores["host"] == steps["source"]))
        parts = (
            passed.select(scores["kind"], F.col("target").alias("host"), (F.col("score") * F.col("share") * damping).alias("new"), F.lit(0.0).alias("old"))
            .unionByName(base.select("kind", "host", (F.col("seed") * (1 - damping)).alias("new"), F.lit(0.0).alias("old")))
            .unionByName(scores.select("kind", "host", F.lit(0.0).alias("new"), F.col("score").alias("old")))
        )
        before = path
        after, path = written(parts.groupBy("kind", "host").agg(F.sum("new").alias("score"), F.sum("old").alias("old")), "scores")
        if before:
            discard(spark, before)
        moved = after.agg(F.sum(F.abs(F.col("score") - F.col("old")))).first()[0] or 0.0
        scores = after.drop("old")
        if moved < tolerance * mass:
            break
    discard(spark, steps_at)
    return scores


def host_verdicts(judged: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """``host``, ``host_verdict``, ``trust_score``, ``distrust_score`` of the hosts any score reaches."""
    own = keep(seeds(judged), "own")
    start = own.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (kind, seed)")).where("seed > 0")
    scores = propagate(links, start, damping, tolerance)
    by_kind = scores.select(
        "host",
        F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0).alias("trust_score"),
        F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0).alias("distrust_score"),
        F.lit(0.0).alias("undecided"),
    )
    # The undecided pages of a host with judged ones, as if they were a seed.
    word = own.select("host", F.lit(0.0).alias("trust_score"), F.lit(0.0).alias("distrust_score"), ((1 - F.col("trust") - F.col("distrust")) * (1 - damping)).alias("undecided"))
    by_host = by_kind.unionByName(word).groupBy("host").agg(*[F.sum(c).alias(c) for c in ("trust_score", "distrust_score", "undecided")])
    # Scores of seeds are fractions that do not come out even in doubles.
    blocked = (F.col("distrust_score") > 0) & (F.col("distrust_score") >= (F.col("trust_score") + F.col("undecided")) * (1 - 1e-9))
    verdict = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return by_host.select("host", verdict.alias("host_verdict"), "trust_score", "distrust_score")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """Per page: ``host``, ``path``, ``rule`` (null if none fits), ``verdict``, and the scores of the host.

    Defined cases: a null URL or one without ``://`` has an empty host and path and, unless a rule for it exists, is allowed;
    a null html has no links; links to the own host do not count; a host that neither trust nor distrust reaches is
    allowed; repeated rows are judged alike; a page of any length is searched whole; other columns are ignored; an empty table gives no rows.
    """
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    judged = judged.select(
        "*", rule_of(host, path, rules, "name").alias("rule"), rule_of(host, path, rules, "verdict").alias("rule_verdict")
    )
    judged = keep(judged, "urls")
    links = keep(host_links(pages), "host-links")
    hosts = host_verdicts(judged, links, damping, tolerance)
    verdict = F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict")
    return judged.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", verdict, "trust_score", "distrust_score"
    )
