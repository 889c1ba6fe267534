"""Nearest neighbours by one hierarchical navigable small-world graph a shard.

Vectors are dealt over shards by the hash of their id. Each shard draws a level
for every vector (geometric, from the id's hash), builds a graph a level from
the top down, and stores them as flat neighbour arrays. Every block of queries
is searched in every shard: greedily down the upper levels, with a wide beam on
the lowest; the best found are scored on the original vectors in double
precision, and the shards' results are merged by (score, id).

Of equal vectors only the ``k + 1`` smallest ids are indexed: ties go to smaller
ids, so no other can be among the ``k`` nearest of any query (one of them may be
the query itself). A shard holds about ``shard_size`` vectors whatever the table's
size. A task searches one chunk of the blocks in one group of the shards, shard by
shard, and keeps the best of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .graphs import beam_search, build, unit
from .shared import discard, store
from .vectors import as_matrix, exact_neighbours, norms, spread, valid

INDEX = ("shard int, dim int, ids array<bigint>, vectors binary, level_sizes array<int>, "
         "nodes binary, degrees array<int>, neighbours binary")
INDEX_COLUMNS = [c.split()[0] for c in INDEX.split(", ")]
ASKED = "block int, q_dim int, q_numbers array<bigint>, q_ids array<bigint>, q_vectors binary"
ASKED_COLUMNS = [c.split()[0] for c in ASKED.split(", ")]
QUERY_BLOCK = 1024
HELD = 64 << 20  # bytes of vectors of a task's queries, or of its shards
SEED = 7


def levels(ids: np.ndarray, degree: int) -> np.ndarray:
    """Level of each id: geometric with ratio 1 / degree, from its hash."""
    u = np.array([xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), SEED)
                  for i in ids], np.float64) / 2.0 ** 64
    return np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(degree)).astype(int)


def build_shard(ids: np.ndarray, vectors: np.ndarray, degree: int, width: int
                ) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per level, from the top: the positions it holds and its neighbour array
    (positions within the level). Upper levels have half the degree."""
    x, level = unit(vectors), levels(ids, degree)
    nodes, graphs = [], []
    for height in range(level.max(), -1, -1):
        here = np.flatnonzero(level >= height)
        pts = x[here]
        if nodes:
            above = nodes[-1]
            entry = _descend(x, nodes, graphs, pts)
            old = np.searchsorted(here, above)  # those also above come first
            order = np.concatenate([old, np.setdiff1d(np.arange(len(here)), old)])
            entry = np.searchsorted(here, entry)
            entry[old] = old[0]
        else:
            order, entry = np.arange(len(here)), None
        graphs.append(build(pts, order, entry, degree if not height else degree // 2, width, 1.0))
        nodes.append(here)
    return nodes, graphs


def _descend(x, nodes, graphs, q: np.ndarray) -> np.ndarray:
    """The shard position that greedy search down the given levels ends at."""
    at = np.zeros(len(q), np.int64) + nodes[0][0]
    for here, graph in zip(nodes, graphs):
        entry = np.searchsorted(here, at)
        out = []
        for a in range(0, len(q), 512):
            out.append(beam_search(x[here], graph, entry[a:a + 512, None], q[a:a + 512], 4)[0][:, 0])
        at = here[np.concatenate(out)]
    return at


def index(rows: DataFrame, shard_size: int, degree: int, width: int) -> DataFrame:
    """One row a shard and dimension with its vectors and flat neighbour arrays."""
    total = rows.count()
    shards = max(1, -(-total // shard_size))

    def one(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids = table["id"].to_numpy()
        vectors = as_matrix(table["vec"].combine_chunks())
        nodes, graphs = build_shard(ids, vectors, degree, width)
        return pa.table({
            "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
            "dim": pa.array([vectors.shape[1]], pa.int32()),
            "ids": pa.array([ids.tolist()], pa.list_(pa.int64())),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "level_sizes": pa.array([[len(n) for n in nodes]], pa.list_(pa.int32())),
            "nodes": pa.array([np.concatenate(nodes).astype(np.int32).tobytes()], pa.binary()),
            "degrees": pa.array([[g.shape[1] for g in graphs]], pa.list_(pa.int32())),
            "neighbours": pa.array([b"".join(g.astype(np.int32).tobytes() for g in graphs)],
                                   pa.binary())})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("dim", F.size("vec"))
    tasks = spread(dealt.sparkSession, shards)
    return store(dealt.repartitionByRange(tasks, "shard").groupBy("shard", "dim").applyInArrow(one, INDEX), "hnsw-index", wide=True)


def _unpack(row: dict):
    ids = np.array(row["ids"], np.int64)
    vectors = np.frombuffer(row["vectors"]).reshape(len(ids), row["dim"])
    every, flat = (np.frombuffer(row[k], np.int32) for k in ("nodes", "neighbours"))
    nodes, graphs, at, used = [], [], 0, 0
    for size, degree in zip(row["level_sizes"], row["degrees"]):
        nodes.append(every[at:at + size].astype(np.int64))
        graphs.append(flat[used:used + size * degree].reshape(size, degree))
        at, used = at + size, used + size * degree
    return ids, vectors, unit(vectors), nodes, graphs


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
           vector_col: str = "embedding", shard_size: int = 8192, degree: int = 24,
           build_width: int = 48, width: int = 160) -> DataFrame:
    """The ``k`` nearest found of every query row among ``vectors``.

    Returns ``query_id, rank`` (from 1), ``vec_id, score`` (cosine in double
    precision), nearest first, ties to smaller ids; fewer rows where there are
    fewer candidates. A query's own id is no candidate. An id with different vectors
    is as many rows: each is a candidate under its id, and each is a query with a
    ranking of its own, so its id then has that many ranks 1. Null, zero or non-finite
    vectors (and null ids) take no part on either side. Rows that repeat an id
    and vector count once. Vectors of another dimension than a query's are no
    candidates. Other columns are not read; empty tables give no rows.
    """
    rows = valid(vectors, id_col, vector_col).distinct()
    same = Window.partitionBy("vec").orderBy("id")
    rows = store(rows.withColumn("nth", F.row_number().over(same))
                 .where(F.col("nth") <= k + 1).drop("nth"), "hnsw-vectors")
    built = index(rows, shard_size, degree, build_width)
    n_rows, row_bytes = _size(rows)
    discard(rows)
    # A number tells queries apart that share an id.
    asked = store(valid(queries, id_col, vector_col).distinct().withColumn(
        "number", F.monotonically_increasing_id()), "hnsw-asked")
    total, asked_bytes = _size(asked)
    blocks = max(1, -(-total // QUERY_BLOCK))
    shards = max(1, -(-n_rows // shard_size))

    def block(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("id", "ascending"), ("number", "ascending")])
        q = as_matrix(table["vec"].combine_chunks())
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()),
                         "q_dim": pa.array([q.shape[1]], pa.int32()),
                         "q_numbers": pa.array([table["number"].to_pylist()], pa.list_(pa.int64())),
                         "q_ids": pa.array([table["id"].to_pylist()], pa.list_(pa.int64())),
                         "q_vectors": pa.array([q.tobytes()], pa.binary())})

    packed = store(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
                   .withColumn("q_dim", F.size("vec")).groupBy("block", "q_dim")
                   .applyInArrow(block, ASKED), "hnsw-queries", wide=True)
    discard(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, best = {}, {}  # by dimension: blocks of queries, and what is found so far
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                if row["shard"][0].as_py() is None:  # a task's queries come before its shards
                    row = row.select(ASKED_COLUMNS).to_pylist()[0]
                    ids = np.array(row["q_ids"], np.int64)
                    held.setdefault(row["q_dim"], []).append(
                        (np.array(row["q_numbers"], np.int64), ids,
                         np.frombuffer(row["q_vectors"]).reshape(len(ids), row["q_dim"])))
                elif (dim := row["dim"][0].as_py()) in held:
                    shard = _unpack(row.select(INDEX_COLUMNS).to_pylist()[0])
                    new = [_nearest(numbers[a:a + 256], ids[a:a + 256], q[a:a + 256], *shard, k, width)
                           for numbers, ids, q in held[dim] for a in range(0, len(ids), 256)]
                    best[dim] = _merged([best[dim], *new] if dim in best else new, k)
        for table in best.values():
            yield from table.to_batches(max_chunksize=10_000)

    spark = packed.sparkSession
    groups, chunks = _deal(spark, shards, blocks, row_bytes, asked_bytes)
    # Every group of shards meets every chunk of queries in a task of its own. Nothing is
    # joined: a join may be broadcast by what the tables take on disk, not by what the
    # copies take.
    asks = packed.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn(
        "unit", F.col("group") * chunks + F.col("block") % chunks).drop("group")
    copies = built.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn(
        "unit", F.col("shard") % groups * chunks + F.col("chunk")).drop("chunk")
    found = (asks.unionByName(copies, allowMissingColumns=True)
             .repartitionById(groups * chunks, "unit")
             .sortWithinPartitions(F.asc_nulls_first("shard"), "dim", "block")
             .mapInArrow(run, "number bigint, query_id bigint, vec_id bigint, score double"))
    best = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _size(rows: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of their vectors."""
    return rows.agg(F.count("*"), F.coalesce(F.sum(F.size("vec")), F.lit(0)) * 8).first()


def _deal(spark: SparkSession, shards: int, blocks: int, row_bytes: int, asked_bytes: int) -> tuple[int, int]:
    """Into how many groups the shards fall and into how many chunks the blocks, a
    task for each pair: about as many as the session's shuffle partitions, or four
    for each core, and such that the copies of both together are small. No group or
    chunk has much more than ``HELD`` bytes of vectors."""
    tasks = min(shards * blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                     4 * spark.sparkContext.defaultParallelism))
    chunks = round((tasks * asked_bytes / max(1, row_bytes)) ** 0.5)
    chunks = min(blocks, max(1, chunks, -(-tasks // shards), -(-asked_bytes // HELD)))
    return min(shards, max(-(-tasks // chunks), -(-row_bytes // HELD))), chunks


def _merged(batches: list[pa.RecordBatch | pa.Table], k: int) -> pa.Table:
    """The best ``k`` of each query."""
    table = pa.concat_tables([t if isinstance(t, pa.Table) else pa.Table.from_batches([t]) for t in batches])
    number, vec, score = (table[c].to_numpy() for c in ("number", "vec_id", "score"))
    order = np.lexsort((vec, -score, number))
    number = number[order]
    nth = np.arange(len(number)) - np.searchsorted(number, number)
    return table.take(order[nth < k]).combine_chunks()


def _nearest(numbers, q_ids, q, ids, vecs, x, nodes, graphs, k: int, width: int) -> pa.RecordBatch:
    """The best ``k`` of one shard for each query, scored in double precision."""
    qx = unit(q)
    at = _descend(x, nodes[:-1], graphs[:-1], qx) if len(nodes) > 1 else np.zeros(len(q), np.int64)
    found = beam_search(x, graphs[-1], at[:, None], qx, min(width, max(len(x), 1)))[0]
    top = found[:, :4 * k + 8]
    owner, col = np.nonzero(top >= 0)
    point = top[owner, col]
    other = ids[point] != q_ids[owner]
    owner, point = owner[other], point[other]
    score = (q[owner] * vecs[point]).sum(axis=1) / (norms(q)[owner] * norms(vecs)[point])
    order = np.lexsort((ids[point], -score, owner))
    owner, point, score = owner[order], point[order], score[order]
    nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
    keep = nth < k
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers[owner[keep]]), pa.array(q_ids[owner[keep]]), pa.array(ids[point[keep]]),
         pa.array(score[keep])], names=["number", "query_id", "vec_id", "score"])


def audit_recall(vectors: DataFrame, queries: DataFrame, found: DataFrame, k: int = 5) -> float:
    """Share of the ``k`` nearest (by brute force) that ``found``, a result of
    ``search``, has. 1.0 without queries. Ids should be unique."""
    true = exact_neighbours(vectors, queries, k=k).select("query_id", "vec_id")
    row = (true.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")),
                     ["query_id", "vec_id"], "left")
           .agg(F.count("*").alias("n"), F.count("hit").alias("hits")).first())
    return row["hits"] / row["n"] if row["n"] else 1.0
