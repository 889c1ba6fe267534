"""URL filter: prefix rules, and link-graph propagation where no rule fits.

Trust starts at the pages that a rule allows and follows links; distrust starts at
the pages that a rule blocks and runs against them (who links to a blocked host is
distrusted). Both are personalised PageRank over host edges, in 64-bit integers, so
the scores do not depend on the order of additions. A host whose distrust exceeds
its trust is blocked, every other one allowed.

Hot hosts: edges and pages are counted before they move. The edges of a host with
very many are dealt to slices, and its score is sent to each slice; pages meet their
host's verdict by (host, salt).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, store

UNIT = 1_000_000       # the mass of one seed page
TELEPORT, FOLLOW = 3, 17   # of 20: back to the seeds, along the links
ROUNDS = 12
STEP = 4               # rounds between two written tables
HEAVY = 100_000        # edges of a host beyond which they are dealt to slices
SALTS = 32
BROADCAST = 64 << 20   # bytes of rules or blocked hosts that may be broadcast

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The authority of an absolute or protocol-relative link.
LINK = r"""(?i)href[ \t\r\n]*=[ \t\r\n]*["']?[ \t\r\n]*(?:https?:)?//([^/?#"'<> \t\r\n]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty where it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0,
                  F.substr(url, F.length(F.substring_index(url, "://", 1)) + 4)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def _bytes(rows: DataFrame, *columns: str) -> int:
    """Bytes of text columns, and some for each row."""
    size = F.lit(64)
    for c in columns:
        size = size + F.octet_length(c)
    return rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` (with ``row, host, path``) and the ``rule`` and ``judged`` of the
    longest rule that fits, or nulls.

    A page is looked up by its last labels and first path characters, in the
    numbers that occur among the rules, so every lookup is one equality join and
    no page meets a rule that does not fit.
    """
    rules = rules.select(
        F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        (F.col("verdict") == "block").alias("blocks")).where("rule_host <> ''")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("blocks").alias("blocks"))
    labels = F.length("rule_host") - F.length(F.replace("rule_host", F.lit("."), F.lit(""))) + 1
    shapes = [(r.k, r.n) for r in rules.select(
        labels.alias("k"), F.length("rule_path").alias("n")).distinct().collect()]
    if not shapes:
        return pages.select("*", F.lit(None).cast("string").alias("rule"),
                            F.lit(None).cast("string").alias("judged"))
    shapes.sort()
    own = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1

    def key(k: int, n: int) -> tuple[Column, Column]:
        return F.substring_index("host", ".", -k), F.substring("path", 1, n)

    tries = F.array(*[F.when((own >= k) & (F.length("path") >= n), F.struct(
        F.lit(i).alias("shape"), key(k, n)[0].alias("rule_host"), key(k, n)[1].alias("rule_path")))
        for i, (k, n) in enumerate(shapes)])
    side = F.broadcast(rules) if _bytes(rules, "rule_host", "rule_path") <= BROADCAST else rules
    tried = pages.select("*", F.inline_outer(F.filter(tries, lambda t: t.isNotNull()))).join(
        side, ["rule_host", "rule_path"], "left")
    # The longest rule, then the longest host, as one number.
    size = F.length("rule_host") + F.length("rule_path")
    code = F.when(F.col("blocks").isNotNull(), (
        size.cast("bigint") * (1 << 31) + F.length("rule_host")) * (1 << 16)
        + F.col("shape") * 2 + F.col("blocks").cast("int"))
    best = tried.groupBy(*pages.columns).agg(F.max(code).alias("code"))
    shape = F.shiftright("code", 1).bitwiseAND(F.lit((1 << 15) - 1))
    rule = F.coalesce(*[F.when(shape == i, F.concat(*key(k, n))) for i, (k, n) in enumerate(shapes)])
    judged = F.when(F.col("code") % 2 == 1, "block").when(F.col("code") % 2 == 0, "allow")
    return best.select(*pages.columns, rule.alias("rule"), judged.alias("judged"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``source, target, links``: links between different hosts in ``html``.

    Relative links stay on their host and make no edge.
    """
    return (pages.where("host <> ''")
            .select(F.col("host").alias("source"),
                    F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("target"))
            .select("source", F.translate("target", _UPPER, _LOWER).alias("target"))
            .where("source <> target").groupBy("source", "target")
            .agg(F.count("*").alias("links")))


def _arcs(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both directions of the edges by ``kind, start, slice``, and each start's
    outgoing ``total`` once for each of its slices."""
    forward = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("start"),
                           F.col("target").alias("end"), "links")
    back = edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("start"),
                        F.col("source").alias("end"), "links")
    both = forward.unionByName(back)
    n = 2 * edges.count()
    limit = max(HEAVY, n // HEAVY)  # so that at most HEAVY hosts have more edges
    starts = store(both.groupBy("kind", "start").agg(
        F.count("*").alias("edges"), F.sum("links").alias("total")), "linkgraph-starts")
    slices = (F.col("edges") / limit).cast("bigint")
    heavy = starts.where(F.col("edges") > limit).select("kind", "start", slices.alias("more"))
    arcs = both.join(F.broadcast(heavy), ["kind", "start"], "left").select(
        "kind", "start", "end", "links",
        F.pmod(F.xxhash64("end"), F.coalesce("more", F.lit(0)) + 1).alias("slice"))
    totals = starts.select("kind", "start", "total", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.when(F.col("edges") > limit, slices).otherwise(0))).alias("slice"))
    return store(arcs, "linkgraph-arcs"), totals


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``kind, host, score`` after ``rounds`` rounds of personalised PageRank from
    ``seeds`` (``kind`` trust or distrust, ``host, mass``) over ``edges``.

    Each round a host's score becomes (3 mass + 17 received) div 20; a host sends
    floor(score links / all its links) along an edge. What reaches a host without
    outgoing edges stays there for the round. Rounds end early when one changes
    nothing.
    """
    arcs, totals = _arcs(edges)

    def one(scores: DataFrame) -> DataFrame:
        sent = scores.join(totals, (F.col("host") == F.col("start")) & (
            F.col("kind") == F.col("from_kind"))).select("kind", "start", "slice", "score", "total")
        got = sent.join(arcs, ["kind", "start", "slice"]).select(
            "kind", F.col("end").alias("host"),
            # floor(score * links / total) without a product that could overflow
            F.expr("(score div total) * links + ((score % total) * links) div total").alias("part"))
        return (got.select("kind", "host", (FOLLOW * F.col("part")).alias("part"))
                .unionByName(seeds.select("kind", "host", (TELEPORT * F.col("mass")).alias("part")))
                .groupBy("kind", "host").agg(F.sum("part").alias("sum"))
                .select("kind", "host", F.expr(f"sum div {TELEPORT + FOLLOW}").alias("score")))

    totals = totals.withColumnRenamed("kind", "from_kind")
    now = seeds.select("kind", "host", F.col("mass").alias("score"))
    mark, done = None, 0
    while done < rounds:
        before, step = now, min(STEP, rounds - done)
        for _ in range(step):
            now = one(now)
        now = store(now, "linkgraph-scores")
        if done:
            discard(before)
        done += step
        last, mark = mark, tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("kind", "host", "score"))).first())
        if mark == last and (rounds - done) % STEP == 0:
            break
    return now


def judge(pages: DataFrame, rules: DataFrame, page_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", rounds: int = ROUNDS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits
    its host and all subdomains where the path starts with the rule's; the longest
    host and path together wins, then the longer host; of one rule given with both
    verdicts, block. ``verdict`` is the rule's; without a rule it is ``block`` where
    the host's distrust exceeds its trust (see the module), else ``allow``.

    A null URL, or one without ``://``, has an empty host and path, no rule, no
    part in the graph and is allowed. Null html has no links. Every row is judged,
    repeated rows and null ids too. Other columns are not read. An empty table of
    pages gives no rows; without rules every page is allowed.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(page_col).alias("page_id"),
                        host.alias("host"), path.alias("path"))
    matched = store(match_rules(rows, rules), "linkgraph-pages")
    seeds = store(
        matched.where("judged IS NOT NULL AND host <> ''")
        .groupBy(F.when(F.col("judged") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
        .agg((F.count("*") * UNIT).alias("mass")), "linkgraph-seeds")
    edges = store(host_edges(pages.select(host.alias("host"), F.col(html_col).alias("html"))),
                  "linkgraph-edges")
    scores = propagate(seeds, edges, rounds)
    signed = F.when(F.col("kind") == "distrust", F.col("score")).otherwise(-F.col("score"))
    bad = store(scores.groupBy("host").agg(F.sum(signed).alias("more")).where("more > 0")
                .select("host", F.lit("block").alias("found")), "linkgraph-blocked")
    salted = bad.select("host", "found", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    if _bytes(bad, "host") * SALTS <= BROADCAST:
        salted = F.broadcast(salted)
    return matched.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(
        salted, ["host", "salt"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("judged", "found", F.lit("allow")).alias("verdict"))
