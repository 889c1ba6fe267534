"""Ranked lexical search against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from wagegrid.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_rank(docs, items, k):
    """(item_id, rank, doc_id, score) by the formula, one document at a time."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for doc, c in counts:
            m = 75 + 25 * c.total() * n // total
            scores.append((sum(
                q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t]), doc))
        best = sorted((x for x in scores if x[0] > 0),
                      key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(item, r + 1, doc, s) for r, (s, doc) in enumerate(best)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(docs):
    return [(1, "Hello again WORLD 12345 é"), (2, None), (3, ""), (4, "very VERY very passage of bytes"),
            (4, "very passage"), (5, "x" * 200 + " word1 und3 und3"), (None, "two several documents"),
            (7, "nowhere"), (8, "é" * 120), (9, "... --- !!!")]


def test_odd_rows_equal_brute_force(llm, odd_docs):
    docs = odd_docs.unionByName(odd_docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = llm.createDataFrame(items_of(rows), "item_id bigint, text string").selectExpr(
        "*", "1 AS doc_id", "2 AS shard", "3 AS score", "'x' AS name")
    for k in (1, 3, 20):
        assert got(lexical.rank(docs, items, k)) == plain_rank(rows, items_of(rows), k)


@pytest.mark.parametrize("shard,parts", [(1, 1), (4, 5)])
def test_shards_and_blocks_do_not_change_the_result(llm, sf, monkeypatch, shard, parts):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard * 16)
    monkeypatch.setattr(lexical, "BROADCAST", 0)
    docs = llm.read.parquet(f"{sf}/documents.parquet").repartition(parts)
    items = llm.read.parquet(f"{sf}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert got(lexical.rank(docs, items, 20)) == plain_rank(rows, asked, 20)


def test_many_blocks(llm):
    docs = [(i, f"a{i % 7} b{i % 5} c{i % 3} " * (1 + i % 4)) for i in range(60)]
    items = [(i, f"a{i % 9} b{i % 6} zz{i}") for i in range(600)]
    found = lexical.rank(llm.createDataFrame(docs, "doc_id bigint, text string"),
                         llm.createDataFrame(items, "item_id bigint, text string"), 5)
    assert got(found) == plain_rank(docs, items, 5)


def test_empty_tables(llm, no_docs, odd_docs):
    items = llm.createDataFrame([(1, "hello")], "item_id bigint, text string")
    assert lexical.rank(no_docs, items).collect() == []
    assert lexical.rank(odd_docs, items.where("false")).collect() == []
    assert lexical.rank(odd_docs, items.selectExpr("item_id", "'qqq' AS text")).collect() == []


def test_texts_are_cut_between_terms(monkeypatch):
    text = ("Ab12 \xe9t\xe9 " * 50 + "x" * 300 + " end").encode()
    want = lexical.term_counts(text)
    monkeypatch.setattr(lexical, "PART", 7)
    assert lexical.term_counts(text) == want
    assert want == Counter(t.encode() for t in terms(text.decode()))


def test_bundles_are_written_in_small_row_groups(llm, monkeypatch):
    """a task wrote (and the next one read) all its bundles as one row group."""
    import pyarrow.parquet as pq

    kept, store = [], lexical.store

    def recorded(df, name, *args, **more):
        out = store(df, name, *args, **more)
        if name == "lexical-stage2":
            kept.extend(out.inputFiles())
        return out

    monkeypatch.setattr(lexical, "store", recorded)
    monkeypatch.setattr(lexical, "discard", lambda df: None)
    docs = llm.range(0, 5 * lexical.SHARD_DOCS, 1, 1).selectExpr("id AS doc_id", "concat('a', id % 16) AS text")
    every = " ".join(f"a{k}" for k in range(16))
    items = llm.range(lexical.BLOCK).selectExpr("id AS item_id", f"'{every}' AS text")
    before = llm.conf.get("spark.sql.shuffle.partitions")
    llm.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = lexical.rank(docs, items, 2).collect()
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 2 * lexical.BLOCK and {r.doc_id for r in found} == {0, 1}
    groups = [m.row_group(g) for m in (pq.ParquetFile(f.removeprefix("file:")).metadata for f in kept)
              for g in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 5
    assert sum(g.total_byte_size for g in groups) > 20e6
    assert max(g.total_byte_size for g in groups) < 16e6
