"""Graph search and embedding near-duplicates against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from wagegrid.llm import graphs, hnsw, vecdedup

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, vec int"


def _rows(x, first=0):
    return [(first + k, v.astype(np.float32).tolist(), 0, "x", 1) for k, v in enumerate(x)]


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.RandomState(4)
    x = rng.randn(1500, 16)
    near = x[:40].repeat(4, axis=0) + 0.02 * rng.randn(160, 16)
    return np.concatenate([x, near, x[7:8].repeat(30, axis=0), 3 * x[8:9]]).astype(np.float32)


def _cosines(x):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return u @ u.T


def test_beam_search_is_exact_when_wide(cloud):
    x = graphs.unit(cloud[:300])
    graph = graphs.build(x, np.arange(300), None, 16, 32, 1.0)
    found, dist, _ = graphs.beam_search(x, graph, np.zeros((20, 1), np.int64), x[:20], 300)
    assert (found[:, 0] == np.arange(20)).all() and (np.diff(dist, axis=1)[:, :50] >= 0).all()


@pytest.mark.parametrize("shard_size", [8192, 300])
def test_hnsw_recall_ties_and_scores(llm, cloud, shard_size):
    odd = [(5000, None, 0, "x", 1), (5050, [0.0] * 16, 0, "x", 1), (5100, [NAN] * 16, 0, "x", 1),
           (5150, [INF] + [0.0] * 15, 0, "x", 1), (5200, [], 0, "x", 1), (None, [1.0] * 16, 0, "x", 1),
           (50, cloud[50].tolist(), 9, "again", 2)]
    df = llm.createDataFrame(_rows(cloud) + odd, SCHEMA)
    got = hnsw.search(df, df.where("vec_id % 50 = 0"), k=5, shard_size=shard_size).collect()
    cos = _cosines(cloud)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    queries = [q for q in range(len(cloud)) if q % 50 == 0]
    assert sorted(by) == queries
    hits = 0
    for q in queries:
        rows = sorted(by[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
        order = [i for i in np.lexsort((np.arange(len(cloud)), -np.round(cos[q], 12))) if i != q][:5]
        hits += len({r.vec_id for r in rows} & set(order))
        for r in rows:
            assert abs(r.score - cos[q][r.vec_id]) < 1e-9
    assert hits / (5 * len(queries)) >= 0.95
    asked = df.where("vec_id % 50 = 0 AND vec_id < 5000")
    found = llm.createDataFrame(got)
    assert hnsw.audit_recall(df, asked, found) >= 0.95
    assert hnsw.audit_recall(df, asked, found.where("rank <= 2")) == pytest.approx(0.4, abs=0.05)


@pytest.mark.parametrize("held,tasks", [(64 << 20, None), (2_000, None), (64 << 20, 1)])
def test_hnsw_sends_nothing_to_the_driver(llm, cloud, held, tasks, monkeypatch):
    """the copies of the queries, one for each shard, were broadcast by the size of
    the one table they are made from. However shards and queries meet, the result is one."""
    df = llm.createDataFrame(_rows(cloud) + [(9000, [1.0, 2.0], 0, "", 1), (9050, [2.0, 3.0], 0, "", 1)], SCHEMA)
    asked = df.where("vec_id % 50 = 0 OR vec_id > 8000")
    want = sorted(map(tuple, hnsw.search(df, asked, shard_size=300).collect()))
    monkeypatch.setattr(hnsw, "HELD", held, raising=False)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 8)
    if tasks:
        monkeypatch.setattr(hnsw, "_deal", lambda *sizes: (1, 1))
    before = llm.conf.get("spark.sql.autoBroadcastJoinThreshold")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        found = hnsw.search(df, asked, shard_size=300)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, found.collect())) == want
    finally:
        llm.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {q for q, *_ in want} >= {0, 50, 9000, 9050} and (9000, 1, 9050) in {r[:3] for r in want}


def test_hnsw_tasks_hold_bounded_parts(llm):
    for shards, blocks, rows, asked in ((1, 1, 0, 0), (7, 2, 26 << 20, 1 << 19), (75, 12, 315 << 20, 6 << 20),
                                        (1878, 301, 7900 << 20, 158 << 20), (38, 301, 158 << 20, 158 << 20)):
        groups, chunks = hnsw._deal(llm, shards, blocks, rows, asked)
        assert 1 <= groups <= shards and 1 <= chunks <= blocks
        assert rows / groups <= 1.01 * hnsw.HELD and asked / chunks <= 1.01 * hnsw.HELD


def test_hnsw_few_rows(llm):
    rows = [(0, [1.0, 0.0], 0, "", 0), (50, [1.0, 1.0], 0, "", 0), (3, [0.0, 1.0], 0, "", 0)]
    df = llm.createDataFrame(rows, SCHEMA)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in hnsw.search(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 50), (0, 2, 3), (50, 1, 0), (50, 2, 3)]
    none = df.where("false")
    assert hnsw.search(none, none).collect() == [] and hnsw.search(df, none).collect() == []


@pytest.mark.parametrize("shard_size,block", [(4096, 2048), (400, 3)])
def test_near_duplicates_brute_force(llm, cloud, shard_size, block, monkeypatch):
    monkeypatch.setattr(vecdedup, "BLOCK", block)
    odd = [(5000, None, 0, "x", 1), (5001, [0.0] * 16, 0, "x", 1), (5002, [NAN] + [1.0] * 15, 0, "x", 1),
           (5003, [], 0, "x", 1), (5004, [1.0, 2.0], 0, "x", 1), (5005, [2.0, 4.0], 0, "x", 1)]
    df = llm.createDataFrame(_rows(cloud) + odd, SCHEMA)
    got = {r.vec_id: r for r in vecdedup.near_duplicates(df, shard_size=shard_size).collect()}
    assert len(got) == len(cloud) + len(odd)
    near = _cosines(cloud) >= 0.95
    np.fill_diagonal(near, False)
    true = near.sum(axis=1)
    found = np.array([got[k].n_links for k in range(len(cloud))])
    assert (found <= true).all() and found.sum() >= 0.97 * true.sum()
    assert vecdedup.audit_recall(df.where("vec_id < 5000"), llm.createDataFrame(list(got.values()))) >= 0.97
    for k in (5000, 5001, 5002, 5003):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert got[5004].n_links == got[5005].n_links == 1 and got[5005].component_id == 5004
    for r in got.values():
        assert r.kept == (r.vec_id == r.component_id) and got[r.component_id].kept


def test_a_group_spread_over_clusters_is_counted_whole(llm):
    """Near copies far from every centroid, so their clusters differ."""
    rng = np.random.RandomState(11)
    x = rng.randn(3000, 64)
    group = x[:1] + 0.09 * rng.randn(200, 64)
    df = llm.createDataFrame(_rows(np.concatenate([x, group])), SCHEMA)
    got = vecdedup.near_duplicates(df, shard_size=500)
    near = _cosines(np.concatenate([x, group]).astype(np.float32)) >= 0.95
    assert got.agg({"n_links": "sum"}).first()[0] >= 0.98 * (near.sum() - len(near))
    assert vecdedup.audit_recall(df, got) >= 0.98


def test_near_duplicates_empty_and_repeats(llm):
    assert vecdedup.near_duplicates(llm.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, [1.0, 2.0], 0, "", 0), (1, [1.0, 2.0], 0, "", 0), (None, [1.0, 2.0], 0, "", 0)]
    got = vecdedup.near_duplicates(llm.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.n_links) for r in got) == [(-1, 0), (1, 1), (1, 1)]


def test_registered_queries(llm, sf, queries):
    rows = llm.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows])
    ids = np.array([r.vec_id for r in rows])
    cos = _cosines(x)
    found = queries["op8_nearest_neighbours"](llm, sf).collect()
    asked = ids[ids % 50 == 0]
    assert sorted({r.query_id for r in found}) == sorted(asked.tolist())
    at = {int(i): k for k, i in enumerate(ids)}
    hits = 0
    for q in asked.tolist():
        order = [int(ids[k]) for k in np.argsort(-cos[at[q]], kind="stable") if ids[k] != q][:5]
        hits += len({r.vec_id for r in found if r.query_id == q} & set(order))
    assert hits >= 0.9 * 5 * len(asked)
    links = {r.vec_id: r.n_links for r in queries["op10_embedding_near_dedup"](llm, sf).collect()}
    assert links == {int(i): int((cos[k] >= 0.95).sum()) - 1 for k, i in enumerate(ids)}


def test_neighbours_of_mixed_dimensions(llm):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [1.0, 0.0, 0.0]), (4, [0.8, 0.1, 0.0]), (5, [1.0] * 5)]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r.vec_id) for r in hnsw.search(df, df, k=3).collect())
    assert got == [(1, 2), (2, 1), (3, 4), (4, 3)]


def test_pairs_at_cluster_borders_are_found_and_audited(llm):
    """Isolated pairs just above the limit among unstructured vectors, many clusters."""
    rng = np.random.RandomState(3)
    x = rng.randn(12_000, 64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.randn(1500, 64)
    side -= (side * x[:1500]).sum(axis=1, keepdims=True) * x[:1500]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    both = np.concatenate([x, 0.952 * x[:1500] + np.sqrt(1 - 0.952 ** 2) * side])
    df = llm.createDataFrame([(k, v.tolist()) for k, v in enumerate(both)], "vec_id bigint, embedding array<double>")
    got = vecdedup.near_duplicates(df, shard_size=300).collect()
    ends = sum(r.n_links for r in got)
    assert 2985 <= ends <= 3000
    found = llm.createDataFrame(got)
    assert vecdedup.audit_recall(df, found) == pytest.approx(ends / 3000, abs=0.005)
    # An audit tells of links that the result denies.
    lost = found.withColumn("n_links", found["n_links"] * (found["vec_id"] % 10 != 0).cast("int"))
    true = sum(r.n_links for r in got if r.vec_id % 10) / 3000
    assert vecdedup.audit_recall(df, lost) == pytest.approx(true, abs=0.005)


def test_an_id_with_two_vectors_is_two_rows(llm):
    rows = [(7, [1.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0]), (3, [1.0, 0.01, 0.0]), (1, [0.9, 0.0, 0.9]),
            (50, [0.0, 0.0, 1.0]), (50, [1.0, 0.0, 0.1])]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vecdedup.near_duplicates(df).collect())
    assert got == [(1, 0, 1), (3, 2, 3), (7, 0, 7), (7, 2, 3), (50, 0, 50), (50, 2, 3)]
    found = sorted((r["rank"], r.vec_id) for r in hnsw.search(df, df.where("vec_id = 50"), k=2).collect())
    assert found == [(1, 1), (1, 7), (2, 3), (2, 3)] or found == [(1, 1), (1, 7), (2, 3), (2, 7)]


def test_audits_take_many_queries_and_mixed_dimensions(llm, cloud, monkeypatch):
    rows = _rows(cloud[:300]) + [(900 + k, [1.0, float(k)], 0, "x", 1) for k in range(4)]
    df = llm.createDataFrame(rows, SCHEMA)
    good = hnsw.exact_neighbours
    monkeypatch.setattr(hnsw, "exact_neighbours", lambda *a, **k: good(*a, most=64, **k))
    found = hnsw.search(df, df, k=3)
    assert hnsw.audit_recall(df, df, found, k=3) >= 0.95
    assert vecdedup.audit_recall(df, vecdedup.near_duplicates(df)) >= 0.99
