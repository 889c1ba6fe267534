"""URL rules and link-graph propagation against brute force."""

from __future__ import annotations

import random

import pytest

from wagegrid.llm import linkgraph
from wagegrid.llm.queries_pages import RULES

PAGES = "page_id bigint, url string, html string, host string, rule string, row int, kind string"


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    after = rest[end:]
    stop = min([after.find(c) for c in "?#" if c in after], default=len(after))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), after[:stop]


def plain_rule(host, path, rules):
    fit = [(len(h + p), len(h), v == "block", h + p) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (max(fit)[3], "block" if max(fit)[2] else "allow") if fit else (None, None)


def plain_judge(pages, rules, links, rounds):
    """(page_id, host, path, rule, verdict); ``links`` are (source, target) pairs."""
    split = [(i, *plain_split(url)) for i, url in pages]
    ruled = [(i, h, p, *plain_rule(h, p, rules)) for i, h, p in split]
    worse: dict[str, int] = {}
    for kind, verdict in ((-1, "allow"), (1, "block")):
        seeds: dict[str, int] = {}
        for _, h, _, _, v in ruled:
            if v == verdict and h:
                seeds[h] = seeds.get(h, 0) + 1_000_000
        arcs: dict[tuple, int] = {}
        for s, t in links:
            if s != t:
                key = (s, t) if kind == -1 else (t, s)
                arcs[key] = arcs.get(key, 0) + 1
        total: dict[str, int] = {}
        for (s, _), n in arcs.items():
            total[s] = total.get(s, 0) + n
        score = dict(seeds)
        for _ in range(rounds):
            new = {h: 3 * m for h, m in seeds.items()}
            for (s, t), n in arcs.items():
                if s in score:
                    new[t] = new.get(t, 0) + 17 * (score[s] * n // total[s])
            score = {h: x // 20 for h, x in new.items()}
        for h, x in score.items():
            worse[h] = worse.get(h, 0) + kind * x
    return sorted(str((i, h, p, r, v or ("block" if worse.get(h, 0) > 0 else "allow")))
                  for i, h, p, r, v in ruled)


def judged(spark, pages, rules, rounds=linkgraph.ROUNDS):
    rows = spark.createDataFrame([(i, u, html, "h", "r", 1, "k") for i, u, html in pages], PAGES)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    return sorted(str(tuple(r)) for r in linkgraph.judge(rows, table, rounds=rounds).select(
        "page_id", "host", "path", "rule", "verdict").collect())


URLS = [None, "", "no scheme", "http://", "http://WWW.Example.ORG/es/1?x=/fr/", "https://example.org/en/17#a",
        "https://example.org/en/2", "http://a.b.com/fr/x", "http://com/fr/", "http://xcom/fr/", "ftp://x.com/de/",
        "http://x.com/de", "http://org", "http://org?x", "http://example.org#/es/", "http://n.net/://y.org/",
        "http://ÉX.org/", "http://u:p@x.org:80/p", "a://b://c.org/", "http://x.org/" + "p" * 60_000,
        "http://notexample.org/es/"]


def test_odd_urls(llm):
    pages = [(k, u, None) for k, u in enumerate(URLS)] + [(None, "http://x.org/", "<a href='//q.net/'>")] * 2
    assert judged(llm, pages, RULES) == plain_judge([(i, u) for i, u, _ in pages], RULES, [("x.org", "q.net")] * 2, 12)


def test_longest_rule_wins(llm):
    rules = [("com", "/abcdef", "allow"), ("a.com", "/abc", "block"), ("b.a.com", "", "allow"),
             ("com", "/", "block"), ("com", "/", "allow"), ("A.Com", "/ab", "allow")]
    lower = [(h.lower(), p, v) for h, p, v in rules]
    pages = [(k, f"http://{h}{p}", None) for k, (h, p) in enumerate(
        (h, p) for h in ("com", "a.com", "b.a.com", "c.b.a.com", "ba.com")
        for p in ("", "/", "/a", "/ab", "/abc", "/abcdefg"))]
    assert judged(llm, pages, rules) == plain_judge([(i, u) for i, u, _ in pages], lower, [], 12)


@pytest.mark.parametrize("rounds,heavy", [(1, 100_000), (5, 3)])
def test_propagation(llm, monkeypatch, rounds, heavy):
    monkeypatch.setattr(linkgraph, "HEAVY", heavy)
    monkeypatch.setattr(linkgraph, "BROADCAST", 0)
    rng, hosts = random.Random(rounds), [f"h{k}.net" for k in range(30)]
    hosts += ["good.org", "bad.example.org", "x.com"]
    pages, links = [], []
    for k in range(150):
        h = "h0.net" if k % 3 == 0 else rng.choice(hosts)  # a third on one host
        to = [rng.choice(hosts) for _ in range(rng.randrange(4))] + (["h0.net"] if k % 2 else [])
        html = "<p>" + "".join(rng.choice([
            f'<a href="http://{t}/x">', f"<A HREF = '//{t.upper()}'>", f"<a href=https://{t}?q>"]) for t in to)
        pages.append((k, f"http://{h}/{rng.choice(['es', 'en', 'fr', 'de'])}/{k}", html + '<a href="/own">'))
        links += [(h, t) for t in to]
    for k in range(200, 220):  # a host that only links to a blocked one
        pages += [(k, "http://bad.example.org/es/1", None),
                  (k + 20, "http://only.net/", "<a href='http://bad.example.org'>")]
        links.append(("only.net", "bad.example.org"))
    want = plain_judge([(i, u) for i, u, _ in pages], RULES, links, rounds)
    assert judged(llm, pages, RULES, rounds) == want
    assert any("None, 'block'" in w for w in want) and any("None, 'allow'" in w for w in want)


def test_empty_tables(llm):
    assert judged(llm, [], RULES) == []
    none = llm.createDataFrame([], "host string, path string, verdict string")
    rows = llm.createDataFrame([(1, "http://x.org/", None)], "page_id bigint, url string, html string")
    assert [tuple(r) for r in linkgraph.judge(rows, none).collect()] == [(1, "x.org", "/", None, "allow")]


def test_scores_end_when_nothing_changes(llm):
    seeds = llm.createDataFrame([("trust", "a", 2_000_000)], "kind string, host string, mass bigint")
    edges = llm.createDataFrame([("a", "b", 1), ("b", "c", 3)], "source string, target string, links bigint")
    few = {(r.host, r.score) for r in linkgraph.propagate(seeds, edges, 8).collect()}
    assert few == {(r.host, r.score) for r in linkgraph.propagate(seeds, edges, 400).collect()}
    assert few == {("a", 300_000), ("b", 255_000), ("c", 216_750)}
