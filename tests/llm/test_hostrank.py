import random
import re

import pytest

from cellweave.llm import hostrank, queries
from cellweave.llm.queries import RULES

PAGES = "page_id long, url string, html string, host string, score double"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1.0) for r in rows], PAGES).repartition(3)


def split_by_hand(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_by_hand(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def verdicts_by_hand(rows, damping=0.85, rounds=400):
    judged = []
    for _, url, _ in rows:
        host, path = split_by_hand(url)
        judged.append((host, path, rule_by_hand(host, path)))
    links = {}
    for (host, _, _), (_, _, html) in zip(judged, rows, strict=True):
        for target in re.findall(r"""(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)""", html or "", re.I):
            if host and target.lower() != host:
                links[host, target.lower()] = links.get((host, target.lower()), 0) + 1
    hosts = {h for h, _, _ in judged if h}
    own = {h: [r.verdict if r else None for host, _, r in judged if host == h] for h in hosts}
    share = {k: {h: own[h].count(k) / len(own[h]) for h in hosts} for k in ("allow", "block", None)}
    scores = {}
    for verdict, edges in (("allow", links), ("block", {(b, a): w for (a, b), w in links.items()})):
        seed = {h: s for h, s in share[verdict].items() if s}
        out = {}
        for (a, _), w in edges.items():
            out[a] = out.get(a, 0) + w
        score = dict(seed)
        for _ in range(rounds):
            new = {h: (1 - damping) * s for h, s in seed.items()}
            for (a, b), w in edges.items():
                if a in score:
                    new[b] = new.get(b, 0) + damping * score[a] * w / out[a]
            score = new
        scores[verdict] = score
    result = []
    for (page_id, _, _), (host, path, rule) in zip(rows, judged, strict=True):
        word = (1 - damping) * share[None].get(host, 0) if share["allow"].get(host) or share["block"].get(host) else 0
        trust, distrust = scores["allow"].get(host, 0), scores["block"].get(host, 0)
        blocked = distrust > 0 and distrust >= (trust + word) * (1 - 1e-9)
        verdict = rule.verdict if rule else "block" if blocked else "allow"
        result.append((page_id, host, path, rule.name if rule else None, verdict))
    return result

ODD = [
    (1, None, None), (2, "", "<a href=//x.org>"), (3, "no scheme here", ""), (4, "http://", None), (5, "http://COM/a?b#c", None),
    (6, "http://www.Example.com/en/1?x=/fr/", None), (7, "ftp://example.com/en/#://other.net/es/", None), (8, "http://a.net/es/", None),
    (9, "http://a.net/es", None), (10, "http://b.net?/fr/", None), (11, "http://notexample.com/en/", None), (12, "http://É.ORG/Ä", None),
    (13, "http://u@h.net:80/fr/x", None), (None, "http://a.net/fr/", None), (14, "x://y://z/en/", None), (14, "x://y://z/en/", None),
    (15, "http://example.com\n/en/", None),
]


def linked(seed=7):
    choose = random.Random(seed)
    hosts = [f"h{i}.org" for i in range(14)] + ["good.com", "shop.example.com", "bad.net", "worse.net"]
    rows = []
    for page_id in range(160):
        host = choose.choice(hosts)
        path = choose.choice(["/en/", "/es/", "/fr/x", "/de/"]) if host != "worse.net" else "/es/"
        targets = choose.choices(hosts, k=choose.randint(0, 4))
        html = "".join(f'<a {choose.choice(["href", "HREF "])}="http://{t.upper() if choose.random() < 0.2 else t}/p">' for t in targets)
        rows.append((page_id, f"https://{host}{path}", html + '<a href="/own">'))
    return rows


@pytest.mark.parametrize("rows", [ODD, linked(), linked(8)], ids=["odd", "linked", "linked again"])
def test_against_plain_version(spark, rows):
    result = hostrank.judge_urls(pages(spark, rows), RULES, tolerance=1e-9)
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in result.collect()]
    assert sorted(got, key=repr) == sorted(verdicts_by_hand(rows), key=repr)


def test_distrust_reaches_those_who_link_to_blocked_hosts(spark):
    rows = [
        (1, "http://bad.net/es/1", ""), (2, "http://farm.org/", '<a href="http://bad.net/es/1">' * 3),
        (3, "http://fine.org/", '<a href="http://good.com/">'), (4, "http://good.com/", '<a href="http://fine.org/">'),
        (5, "http://alone.org/", ""),
    ]
    found = {r.page_id: r.verdict for r in hostrank.judge_urls(pages(spark, rows), RULES).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_empty_table(spark):
    assert hostrank.judge_urls(pages(spark, []), RULES).count() == 0


def judged_by_query(spark, tmp_path, rows):
    path = tmp_path / "pages.parquet"
    pages(spark, rows).write.parquet(str(path))
    return {r.page_id: r.verdict for r in queries.op9_host_rank(spark, str(tmp_path)).collect()}


def test_query_blocks_linkers_whatever_the_size_of_other_seeds(spark, tmp_path):
    """A seed of many pages, small ones with one or many linkers; who links to others as well is blocked, who is trusted as well is not."""
    bad = [f"http://hot.net/es/{i}" for i in range(60)] + [f"http://cold{k}.net/es/{i}" for k in range(4) for i in range(2)]
    only = [(f"http://linker{k}.org/", f'<a href="http://cold{min(k, 3)}.net/es/">') for k in range(12)]
    few = "".join(f'<a href="http://other{i}.org/">' for i in range(9)) + '<a href="http://hot.net/es/">'
    only.append(("http://few.org/", few))
    known = '<a href="http://hot.net/es/"><a href="http://other1.org/">'
    rest = [("http://good.com/", '<a href="http://known.org/">'), ("http://known.org/", known), ("http://alone.org/", ""), ("http://other1.org/", "")]
    rows = [(i, *r) for i, r in enumerate([*[(u, "") for u in bad], *only, *rest])]
    found = judged_by_query(spark, tmp_path, rows)
    assert [found[i] for i, _, _ in rows] == ["block"] * (len(bad) + len(only)) + ["allow"] * len(rest)


def test_query_counts_blocked_pages_that_are_no_majority(spark, tmp_path):
    """Half and less of a host's pages are blocked: evidence against the rest of them and those who link there."""
    rows = [(i, f"http://half.net/{'es' if i < 5 else 'de'}/{i}", "") for i in range(10)]
    rows += [(10 + i, f"http://tenth.net/{'es' if i < 1 else 'de'}/{i}", "") for i in range(10)]
    found = judged_by_query(spark, tmp_path, rows)
    assert [found[i] for i in range(20)] == ["block"] * 11 + ["allow"] * 9


def test_rounds_go_on_to_the_tolerance_in_a_cycle(spark):
    links = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "source string, target string, weight double")
    start = spark.createDataFrame([("trust", "a", 1.0)], "kind string, host string, seed double")
    score = {r.host: r.score for r in hostrank.propagate(links, start, 0.85, 1e-6).collect()}
    assert score["a"] == pytest.approx(0.15 / (1 - 0.85**2), abs=1e-5)


def test_links_to_other_hosts_do_not_help_a_host(spark, tmp_path):
    """The same host with one link to a blocked one, then with two more to hosts nothing is known of."""
    for n, more in enumerate(["", '<a href="http://x.org/"><a href="http://y.org/">']):
        rows = [(1, "http://bad.net/es/1", ""), (2, "http://farm.org/", '<a href="http://bad.net/es/1">' + more), (3, "http://x.org/", "")]
        (tmp_path / str(n)).mkdir()
        found = judged_by_query(spark, tmp_path / str(n), rows)
        assert found == {1: "block", 2: "block", 3: "allow"}


def test_a_score_is_dealt_over_the_links_of_its_host(spark):
    links = spark.createDataFrame([("a", "b", 3.0), ("a", "c", 1.0), ("d", "c", 1.0)], "source string, target string, weight double")
    start = spark.createDataFrame([("trust", "a", 1.0), ("distrust", "c", 1.0)], "kind string, host string, seed double")
    score = {(r.kind, r.host): r.score for r in hostrank.propagate(links, start, 0.8, 1e-9).collect()}
    assert score == pytest.approx({
        ("trust", "a"): 0.2, ("trust", "b"): 0.2 * 0.8 * 0.75, ("trust", "c"): 0.2 * 0.8 * 0.25,
        ("distrust", "c"): 0.2, ("distrust", "a"): 0.2 * 0.8 / 2, ("distrust", "d"): 0.2 * 0.8 / 2,
    })
