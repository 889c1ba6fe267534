"""SimHash groups, components and suffix-array cuts against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from wagegrid.llm import simhash, suffix
from wagegrid.llm.components import connected_components, forest
from wagegrid.llm.sais import permuted_lcp, suffix_array


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def plain_fingerprint(text, shingle=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[k:k + shingle]) for k in range(max(len(words) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_plain():
    for text in ("", " \t", "One", "One two", "A b\x0bc d", "É à É à" * 9, "x y z w", "a b c " * 50):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprints_of_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "PART", 7)
    for text in ("", "a", "a b", "one two three four five six", "x" * 50 + " y z w", "a b c  d " * 30):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_hash_is_sparks(llm):
    row = llm.sql("select xxhash64('one two three é') h").first()
    assert row.h % 2 ** 64 == xxhash.xxh64_intdigest("one two three é".encode(), 42)


def _plain_groups(fps):
    sets = Sets(fps)
    ids = list(fps)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                sets.join(a, b)
    return {i: sets.root(i) for i in ids}


@pytest.mark.parametrize("dense", [4096, 4])
def test_simhash_query_whole_table(llm, dense):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fps = {r.doc_id: plain_fingerprint(r.text or "") for r in docs.collect()}
    want = _plain_groups(fps)
    for r in simhash.near_duplicates(docs, dense=dense).collect():
        assert r.fingerprint == f"{fps[r.doc_id]:016x}"
        assert r.component_id == want[r.doc_id]


def _signed(x):
    return x - 2 ** 64 if x >= 2 ** 63 else x


@pytest.mark.parametrize("dense", [4096, 16])
def test_planted_fingerprints_link_exactly(llm, dense):
    """Random fingerprints with neighbours at 1 to 5 bits, chains and a crowd."""
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for bits in range(1, 6):
            fps.add(x ^ sum(1 << b for b in rng.sample(range(64), bits)))
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(32), rng.randint(0, 8))) for _ in range(300)}
    fps = sorted(fps)
    links, found = [], simhash._groups(simhash._probe(
        llm.createDataFrame([(_signed(f),) for f in fps], "fp bigint")), 3, dense)
    while True:
        rows = found.collect()
        links += [(r.u, r.v) for r in rows if r.key is None]
        crowd = [(r.key, r.u, r.v) for r in rows if r.key is not None]
        if not crowd:
            break
        found = simhash._groups(simhash._split(llm.createDataFrame(
            crowd, "key bigint, fp bigint, mask bigint")), 3, dense)
    sets = Sets([_signed(f) for f in fps])
    for u, v in links:  # star edges of links, so not links themselves
        sets.join(u, v)
    want = _plain_groups({_signed(f): f for f in fps})
    got = {}
    for f, root in want.items():
        assert got.setdefault(root, sets.root(f)) == sets.root(f)
    assert len(set(got.values())) == len(got)


def test_simhash_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == len(rows)
    blank = {r.doc_id: r.component_id for r in got if r.fingerprint == "0" * 16}
    assert {2, 3, 10} <= blank.keys() and set(blank.values()) == {2}
    assert simhash.near_duplicates(no_docs).collect() == []


def test_forest_and_components(llm):
    rng = np.random.RandomState(0)
    for _ in range(20):
        a, b = rng.randint(0, 60, 40), rng.randint(0, 60, 40)
        sets = Sets(range(60))
        for x, y in zip(a.tolist(), b.tolist()):
            sets.join(x, y)
        node, low = forest(a, b)
        assert {n: lo for n, lo in zip(node.tolist(), low.tolist())} == {
            n: sets.root(n) for n in set(a.tolist()) | set(b.tolist()) if sets.root(n) != n}
    chain = [(k, k + 1) for k in range(300)] + [(1000 + k, 1000) for k in range(200)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(
        llm.createDataFrame(chain, "u bigint, v bigint").repartition(20)).collect()}
    assert all(got.get(k, k) == 0 for k in range(301)) and all(got.get(1000 + k) == 1000 for k in range(1, 200))
    assert connected_components(llm.createDataFrame([], "u bigint, v bigint")).collect() == []


# -- suffix arrays -----------------------------------------------------------------

def test_suffix_array_and_prefixes():
    rng = np.random.RandomState(1)
    for _ in range(300):
        n = rng.randint(1, 60)
        text = np.concatenate([rng.randint(1, rng.randint(2, 6) + 1, n), [0]])
        array = suffix_array(text)
        assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        shared = permuted_lcp(text, array, 10)
        for before, here in zip(array, array[1:]):
            a, b = text[before:].tolist(), text[here:].tolist()
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[here] == min(n, 10)


def test_smallest_documents_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        texts = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(6, 40))) for _ in range(8)})
        first = np.array([rng.randint(0, 99) for _ in texts])
        least = {}
        for t, d in zip(texts, first.tolist()):
            for k in range(len(t) - 5):
                least[t[k:k + 6]] = min(least.get(t[k:k + 6], 999), d)
        got, count = suffix.smallest_documents(texts, first, 6)
        assert count.tolist() == [len(t) - 5 for t in texts]
        assert got.tolist() == [least[t[k:k + 6]] for t in texts for k in range(len(t) - 5)]


def plain_cut(rows, width=50):
    """(id, bytes) -> per row: kept bytes and removed runs."""
    first = {}
    for i, b in rows:
        if i is not None:
            for k in range(len(b) - width + 1):
                w = b[k:k + width]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        if i is not None:
            for k in range(len(b) - width + 1):
                if first[b[k:k + width]] < i:
                    gone[k:k + width] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def _compare(df, rows):
    got = [(r.doc_id, r.n_bytes, sum(s.length for s in r.spans), len(r.spans), bytes(r.kept))
           for r in df.collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[4])
    assert sorted(got, key=key) == sorted(plain_cut(rows), key=key)


@pytest.mark.parametrize("seed", range(3))
def test_planted_repeats(llm, seed, monkeypatch):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    pool = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(12)]
    rows = []
    for i in range(80):
        parts = [rng.choice(pool) if rng.random() < 0.4 else " ".join(word() for _ in range(20))
                 for _ in range(rng.randint(1, 5))]
        rows.append((rng.choice([i, i, i, 5, None]), " ".join(parts)))
    rows += [(200 + k, "a" * (40 + 9 * k) + "b") for k in range(9)] + [(300, ""), (301, None)]
    df = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    _compare(suffix.remove_repeats(df), [(i, (t or "").encode()) for i, t in rows])


def test_small_groups_and_parts_change_nothing(llm, monkeypatch):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    monkeypatch.setattr(suffix, "GROUP_BYTES", 1 << 15)
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 1 << 16)
    _compare(suffix.remove_repeats(docs), rows)


def test_hot_hash_is_split(llm, monkeypatch):
    """Segments that leave a shared passage are different in every document and
    have one hash; no shard holds them all."""
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(300)
    rows = [(i // 2 if i < 8 else i, noise(60) + passage + noise(60)) for i in range(400)]
    rows += [(900 + k, rows[5 * k][1][30:] + noise(20)) for k in range(40)]  # copies of the edges too
    rows += [(None, passage)]
    size = 4096
    for name in ("GROUP_BYTES", "BUCKET_BYTES", "SORT_BYTES"):
        monkeypatch.setattr(suffix, name, size)
    sort_shards = suffix._sort_shards

    def watched(*args):
        run = sort_shards(*args)

        def watch(batches):
            held = {}
            for batch in batches:
                for b, body in zip(batch.column("bucket").to_pylist(), batch.column("body").to_pylist()):
                    held[b] = held.get(b, 0) + len(body)
                    if held[b] > 6 * size:
                        raise ValueError(f"{held[b]} bytes in a shard")
                yield from run(iter([batch]))
        return watch

    docs = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    _compare(suffix.remove_repeats(docs), [(i, t.encode()) for i, t in rows])
    monkeypatch.setattr(suffix, "_sort_shards", watched)
    suffix.remove_repeats(docs).count()


def test_suffix_query_whole_table(llm, sf, queries):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    want = {i: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for i, n, gone, runs, kept in
            plain_cut([(r.doc_id, (r.text or "").encode()) for r in docs.collect()])}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in queries["op2_suffix_array_dedup"](llm, sf).collect()}
    assert got == want


def test_suffix_odd_rows(odd_docs, no_docs):
    _compare(suffix.remove_repeats(odd_docs), [(r.doc_id, (r.text or "").encode()) for r in odd_docs.collect()])
    kept = suffix.remove_repeats(odd_docs)
    assert kept.schema["rest"].dataType.names == ["lang", "source", "n_chars", "id", "g"]
    assert sorted((r.rest.source or "") for r in kept.collect()) == sorted(
        (r.source or "") for r in odd_docs.collect())
    assert suffix.remove_repeats(no_docs).collect() == []


def test_the_edges_of_a_hub_meet_in_slices(llm):
    """One component of a third of all nodes: its hub's edges are not in one task."""
    from pyspark.sql import functions as F
    from wagegrid.llm import components

    edges = [(i, 0) for i in range(1, 4000)] + [(10_000 + 3 * i + 1, 10_000 + 3 * i) for i in range(3000)]
    df = llm.createDataFrame(edges, "u bigint, v bigint")
    before = {k: llm.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        llm.conf.set("spark.sql.adaptive.enabled", "false")
        for large in (True, False):
            share = max(2 * len(edges) // (components.PIECES * 8), components.HUB)
            rows = df if not large else df.unionByName(df.selectExpr("v AS u", "u AS v"))
            least = rows.groupBy("u").agg(F.count("*").alias("n"))
            hubs = least.where(F.col("n") >= share).collect()
            assert len(hubs) == (1 if large else 0)
            plan = components._star(df, large, len(edges))
            parts = [r["count"] for r in plan.groupBy(F.spark_partition_id()).count().collect()]
            assert max(parts) <= 3 * sorted(parts)[len(parts) // 2]
        found = {r.node: r.component for r in components.connected_components(df).collect()}
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)
    assert found == {u: v for u, v in edges}
