"""Embedding near-duplicates by range search on a robust-pruned flat graph.

Equal vectors are one point with a number of copies. Centroids are fitted on a
bounded sample (``sample`` points of smallest id hash); every point belongs to
its ``overlap`` nearest centroids' clusters. A cluster with more than
``shard_size`` points is dealt over several shards by the ids' hash. Each shard
builds a robust-pruned graph from its medoid, the adjacency lists of all shards
are united point by point, and every shard takes the united lists of its points.

Each point is searched in all shards of the clusters of its ``probe`` nearest
centroids, from the shard's medoid and, where it is a member, from itself: a
beam search, then the range is expanded from every point found in it until
nothing new lies in it. What is found is checked on the original vectors in
double precision and kept as a spanning forest; points in several clusters tie
the forests together.

Last, the points of each component are compared with each other, block by block,
in double precision. That counts every link inside a component, whichever shards
its points were in; no pair ever becomes a row. ``audit_recall`` compares the
result with brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.spread import left_join_spread
from .components import connected_components, forest
from .graphs import beam_search, build, unit
from .shared import store
from .vectors import (as_matrix, cosines, exact_neighbours, norms, spread, takes_part,
                      valid)

SLACK = 1e-5  # float32 graph distances against the limit in double precision
QUERY_BLOCK = 1024
UNIT = ("cluster int, sub int, dim int, ids array<bigint>, vectors binary, degree int, "
        "neighbours binary")


def fit_centroids(points: DataFrame, clusters: int, sample: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means on the ``sample`` points of smallest id hash."""
    drawn = points.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toArrow()
    x = unit(as_matrix(drawn["vec"].combine_chunks()))
    centre = x[:clusters].copy()
    for _ in range(rounds):
        home = (x @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, home, x)
        size = norms(total.astype(np.float64))
        centre = np.where(size[:, None] > 1e-6, total / np.maximum(size, 1e-6)[:, None],
                          centre).astype(np.float32)
    return centre


def assign(points: DataFrame, centre: np.ndarray, probe: int) -> DataFrame:
    """``cluster, nth, id, vec``: a row for each of a point's ``probe`` nearest
    centroids, ``nth`` from 0."""
    shared = points.sparkSession.sparkContext.broadcast(centre)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = unit(as_matrix(part.column("vec")))
                near = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :probe]
                rows = pa.array(np.repeat(np.arange(len(x)), near.shape[1]))
                out = part.take(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.ravel().astype(np.int32)),
                     pa.array(np.tile(np.arange(near.shape[1], dtype=np.int32), len(x))),
                     out.column("id"), out.column("vec")],
                    names=["cluster", "nth", "id", "vec"])

    return points.select("id", "vec").mapInArrow(
        run, "cluster int, nth int, id bigint, vec array<double>")


def _medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(axis=0)).argmax())


def shard_graphs(members: DataFrame, tasks: int, degree: int, width: int, alpha: float) -> DataFrame:
    """``id, near``: every point's pruned neighbours, united over all shards."""
    def one(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids, x = table["id"].to_numpy(), unit(as_matrix(table["vec"].combine_chunks()))
        first = _medoid(x)
        order = np.concatenate([[first], np.delete(np.arange(len(x)), first)])
        graph = build(x, order, None, degree, width, alpha)
        near = [ids[g[g >= 0]].tolist() for g in graph]
        return pa.table({"id": pa.array(ids), "near": pa.array(near, pa.list_(pa.int64()))})

    lists = (members.repartitionByRange(tasks, "cluster", "sub").groupBy("cluster", "sub")
             .applyInArrow(one, "id bigint, near array<bigint>"))
    # At most ``overlap`` lists of bounded length a point.
    return lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def pack_units(members: DataFrame, united: DataFrame, tasks: int) -> DataFrame:
    """One row a shard: its points and the united adjacency among them."""
    def one(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids, x = table["id"].to_numpy(), as_matrix(table["vec"].combine_chunks())
        near = table["near"].combine_chunks()
        sizes = np.array([len(n) for n in near.to_pylist()], np.int64)
        target = near.flatten().to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(ids, target), len(ids) - 1)
        inside = ids[place] == target
        owner = np.repeat(np.arange(len(ids)), sizes)[inside]
        nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
        graph = np.full((len(ids), int(nth.max()) + 1 if len(nth) else 1), -1, np.int32)
        graph[owner, nth] = place[inside]
        return pa.table({
            "cluster": pa.array([table["cluster"][0].as_py()], pa.int32()),
            "sub": pa.array([table["sub"][0].as_py()], pa.int32()),
            "dim": pa.array([x.shape[1]], pa.int32()),
            "ids": pa.array([ids.tolist()], pa.list_(pa.int64())),
            "vectors": pa.array([x.tobytes()], pa.binary()),
            "degree": pa.array([graph.shape[1]], pa.int32()),
            "neighbours": pa.array([graph.tobytes()], pa.binary())})

    rows = members.join(united, "id")
    return (rows.repartitionByRange(tasks, "cluster", "sub").groupBy("cluster", "sub")
            .applyInArrow(one, UNIT))


def range_search(x: np.ndarray, graph: np.ndarray, q: np.ndarray, own: np.ndarray, start: int,
                 width: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (query, point) found with distance at most ``limit``.

    ``own``: the query's own position, -1 if it is no member.
    """
    entry = np.stack([np.full(len(q), start), own], axis=1)
    entry[entry[:, 0] == entry[:, 1], 1] = -1
    beam, dist, seen = beam_search(x, graph, entry, q, min(width, len(x)))
    owner, col = np.nonzero((dist <= limit) & (beam >= 0))
    point = beam[owner, col]
    owners, points = [owner], [point]
    while len(owner):  # expand the range from what was found in it
        near = graph[point]
        who = np.repeat(owner, near.shape[1])[near.ravel() >= 0]
        to = near.ravel()[near.ravel() >= 0].astype(np.int64)
        fresh = ~seen[who, to]
        pair = np.unique(who[fresh] * len(x) + to[fresh])
        who, to = pair // len(x), pair % len(x)
        seen[who, to] = True
        inside = 1.0 - np.einsum("ij,ij->i", x[to], q[who]) <= limit
        owner, point = who[inside], to[inside]
        owners.append(owner)
        points.append(point)
    return np.concatenate(owners), np.concatenate(points)


BLOCK = 2048  # points of a component that are compared at a time


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    limit: float = 0.95, shard_size: int = 4096, overlap: int = 2, probe: int = 4,
                    sample: int = 16384, degree: int = 24, width: int = 48,
                    alpha: float = 1.2) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row.

    ``n_links``: other rows linked directly (cosine >= ``limit``), copies
    included. ``component_id``: the smallest id reachable, itself included;
    ``kept``: whether that is the row's own id. Null, empty, zero or non-finite
    vectors link with nothing: 0 links, their own id. Rows with a null id link
    with nothing and have a null component; rows that repeat an id with the same
    vector count as copies of each other, and an id with different vectors is as many
    rows, each with its own links and component. Vectors of different dimensions never
    link. Other columns are not read. An empty table gives no rows.
    """
    if not -1.0 < limit <= 1.0:
        raise ValueError("limit: a cosine")
    rows = store(valid(vectors, id_col, vector_col), "vecdup-rows")
    # A point is known by a number of its own; an id may have several points.
    points = store(rows.groupBy("vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
                   .withColumn("dim", F.size("vec")).withColumn("id", F.monotonically_increasing_id()),
                   "vecdup-points")
    dims = [r["dim"] for r in points.select("dim").distinct().orderBy("dim").collect()]
    rest = _unlinked(vectors, id_col, vector_col)
    if not dims:
        return _result(rest, id_col)
    found = [_linked(points.where(F.col("dim") == d), limit, shard_size, overlap, probe, sample,
                     degree, width, alpha) for d in dims]
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    parts = store(connected_components(store(links, "vecdup-links"), "vecdup-components"),
                  "vecdup-parts")
    counts = count_links(points, parts, limit)
    grouped = (points.select("vec", "id", "least", "copies")
               .join(counts, "id", "left")
               .join(parts, F.col("id") == F.col("node"), "left")
               .withColumn("component", F.coalesce("component", "id")))
    grouped = store(grouped, "vecdup-grouped")
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    per_point = left_join_spread(grouped, smallest, "component").select(
        "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    # A vector may have a third of all rows; hot ones are told by a hash.
    done = left_join_spread(rows.withColumn("h", F.xxhash64("vec")),
                            per_point.withColumn("h", F.xxhash64("vec")), "h", ["vec"]).select(
        "id", "n_links", "component_id")
    return _result(done.unionByName(rest), id_col)


def count_links(points: DataFrame, parts: DataFrame, limit: float) -> DataFrame:
    """``id, n``: for each point of a component the copies of the others in it at
    a cosine of at least ``limit``.

    A component of up to ``BLOCK`` points is compared where its points meet;
    a larger one is dealt over blocks and every block is compared with every
    block of the component.
    """
    # Every component has its smallest point, which ``parts`` does not list.
    node = parts.select(F.col("node").alias("id"), "component").unionByName(
        parts.select(F.col("component").alias("id"), "component")).distinct()
    sizes = node.groupBy("component").agg(F.count("*").alias("size"))
    member = store(points.select("id", "copies", "vec").join(node, "id").join(sizes, "component")
                   .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")), "vecdup-linked")

    def counted(table: pa.Table) -> pa.RecordBatch:
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        part = table["component"].to_numpy()
        x = as_matrix(table["vec"].combine_chunks())
        edge = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        n = np.concatenate([_near_copies(x[a:b], x[a:b], copies[a:b], limit, True)
                            for a, b in zip(edge, edge[1:])])
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(held).combine_chunks()
            part = table["component"].to_numpy()
            edge = np.flatnonzero(np.diff(part)) + 1
            if not len(edge):
                held = [table]
                continue
            last = int(edge[-1])  # the last component may go on in the next batch
            yield counted(table.slice(0, last))
            held = [table.slice(last)]
        if held:
            table = pa.concat_tables(held).combine_chunks()
            if table.num_rows:
                yield counted(table)

    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = (member.where("blocks = 1").select("component", "id", "copies", "vec")
             .repartition(tasks, "component").sortWithinPartitions("component")
             .mapInArrow(whole, "id bigint, n bigint"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        return pa.table({
            "component": pa.array([table["component"][0].as_py()], pa.int64()),
            "block": pa.array([table["block"][0].as_py()], pa.int32()),
            "blocks": pa.array([table["blocks"][0].as_py()], pa.int32()),
            "dim": pa.array([len(table["vec"][0])], pa.int32()),
            "ids": pa.array([table["id"].to_pylist()], pa.list_(pa.int64())),
            "copies": pa.array([table["copies"].to_pylist()], pa.list_(pa.int64())),
            "vectors": pa.array([as_matrix(table["vec"].combine_chunks()).tobytes()], pa.binary())})

    large = store(member.where("blocks > 1")
                  .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
                  .groupBy("component", "block").applyInArrow(
                      pack, "component bigint, block int, blocks int, dim int, ids array<bigint>, "
                            "copies array<bigint>, vectors binary"), "vecdup-blocks")
    other = large.select("component", F.col("block").alias("o_block"),
                         F.col("copies").alias("o_copies"), F.col("vectors").alias("o_vectors"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                x, y = (np.frombuffer(row[c]).reshape(-1, row["dim"]) for c in ("vectors", "o_vectors"))
                ids, copies = np.array(row["ids"], np.int64), np.array(row["o_copies"], np.int64)
                same = row["block"] == row["o_block"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(_near_copies(x, y, copies, limit, same))],
                    names=["id", "n"])

    # Block numbers are paired first; vectors meet by (component, block), so a large
    # component is in many places.
    blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    compared = (large.withColumn("o_block", F.explode(blocks))
                .join(other, ["component", "o_block"])
                .mapInArrow(pairs, "id bigint, n bigint"))
    return small.unionByName(compared).groupBy("id").agg(F.sum("n").alias("n"))


def _near_copies(x: np.ndarray, y: np.ndarray, copies: np.ndarray, limit: float, same: bool
                 ) -> np.ndarray:
    """For each row of ``x`` the copies of the rows of ``y`` within ``limit``;
    ``same``: both are one block, and a row is not its own neighbour."""
    size_x, size_y = norms(x), norms(y)
    out = np.zeros(len(x), np.int64)
    for at in range(0, len(x), 256):
        part = slice(at, at + 256)
        score = (x[part] @ y.T) / (size_x[part, None] * size_y[None, :])
        # Sums in another order may differ in the last bits: settle close calls.
        row, col = np.nonzero(np.abs(score - limit) < 1e-12)
        score[row, col] = cosines(x[part][row], y[col])
        near = score >= limit
        if same:
            near[np.arange(len(near)), at + np.arange(len(near))] = False
        out[part] = near @ copies
    return out


def _result(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(F.col("id").alias(id_col), "n_links", "component_id",
                       F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _unlinked(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The rows that ``valid`` leaves out, as rows without links."""
    return vectors.where(~F.coalesce(takes_part(id_col, vector_col), F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("n_links"),
        F.col(id_col).cast("bigint").alias("component_id"))


def _linked(points: DataFrame, limit: float, shard_size: int, overlap: int, probe: int,
            sample: int, degree: int, width: int, alpha: float) -> DataFrame:
    """Star edges ``u, v`` of the links found among points of one dimension."""
    spark = points.sparkSession
    total = points.count()
    clusters = int(min(max(1, -(-total * overlap // shard_size)), sample // 16))
    overlap = min(overlap, clusters)
    centre = fit_centroids(points, clusters, sample)
    near = store(assign(points, centre, min(max(probe, overlap), clusters)), "vecdup-near")
    members = near.where(F.col("nth") < overlap)
    # As many rows as centroids, so bounded by the sample.
    sizes = {r["cluster"]: -(-r["n"] // shard_size) for r in
             members.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    subs = F.element_at(F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv]), F.col("cluster"))
    members = store(members.withColumn("sub", F.pmod(F.xxhash64("id"), subs).cast("int")),
                    "vecdup-members")
    tasks = spread(spark, sum(sizes.values()))
    units = store(pack_units(members, shard_graphs(members, tasks, degree, width, alpha), tasks),
                  "vecdup-units")
    # Query blocks of the points near each cluster, for all its shards.
    asks = -(-probe * shard_size // (overlap * QUERY_BLOCK))
    block = F.pmod(F.shiftright(F.xxhash64("id"), 20), subs * asks).cast("int")

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        return pa.table({
            "cluster": pa.array([table["cluster"][0].as_py()], pa.int32()),
            "block": pa.array([table["block"][0].as_py()], pa.int32()),
            "q_ids": pa.array([table["id"].to_pylist()], pa.list_(pa.int64())),
            "q_vectors": pa.array([as_matrix(table["vec"].combine_chunks()).tobytes()], pa.binary())})

    blocks = store(near.where(F.col("nth") < probe).withColumn("block", block).groupBy("cluster", "block").applyInArrow(
        pack, "cluster int, block int, q_ids array<bigint>, q_vectors binary"),
        "vecdup-queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                yield _search_unit(row, limit, width)

    # A unit moves once for each of its chunks, a few where there are few units; the
    # join is searched where it stands.
    shards = sum(sizes.values())
    chunks = min(asks, -(-2 * spread(spark, 4 * shards) // shards))
    work = (blocks.withColumn("chunk", F.col("block") % chunks)
            .withColumn("sub", F.explode(F.sequence(F.lit(0), subs.cast("int") - 1)))
            .join(units.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))),
                  ["cluster", "sub", "chunk"]))
    return work.mapInArrow(run, "u bigint, v bigint")


def _search_unit(row: dict, limit: float, width: int) -> pa.RecordBatch:
    """One block of queries in one shard: a forest of the links found."""
    ids = np.array(row["ids"], np.int64)
    vecs = np.frombuffer(row["vectors"]).reshape(len(ids), row["dim"])
    graph = np.frombuffer(row["neighbours"], np.int32).reshape(len(ids), row["degree"])
    q_ids = np.array(row["q_ids"], np.int64)
    q = np.frombuffer(row["q_vectors"]).reshape(len(q_ids), row["dim"])
    x, qx = unit(vecs), unit(q)
    start = _medoid(x)
    place = np.minimum(np.searchsorted(ids, q_ids), len(ids) - 1)
    own = np.where(ids[place] == q_ids, place, -1)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, len(q), 256):
        who, to = range_search(x, graph, qx[a:a + 256], own[a:a + 256], start, width,
                               1.0 - limit + SLACK)
        who = who + a
        other = ids[to] != q_ids[who]
        who, to = who[other], to[other]
        ok = np.zeros(len(who), bool)
        for b in range(0, len(who), 1 << 16):
            part = slice(b, b + (1 << 16))
            ok[part] = cosines(q[who[part]], vecs[to[part]]) >= limit
        if ok.any():
            u, v = forest(q_ids[who[ok]], ids[to[ok]])
            us.append(u)
            vs.append(v)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])


def audit_recall(vectors: DataFrame, found: DataFrame, limit: float = 0.95, sample: int = 16384,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Share of the true links of ``sample`` rows (those of smallest id hash, whatever
    the result says of them) that ``found``, a result of ``near_duplicates``, counts.
    1.0 where these rows have no links. Ids should be unique."""
    drawn = store(found.orderBy(F.xxhash64(id_col), id_col).limit(sample), "audit-rows")
    asked = vectors.join(drawn.select(id_col).distinct(), id_col, "left_semi")
    true = (exact_neighbours(vectors, asked, limit=limit, id_col=id_col, vector_col=vector_col)
            .groupBy("query_id").agg(F.count("*").alias("n")))
    row = (drawn.join(true, drawn[id_col] == true["query_id"])
           .agg(F.sum("n").alias("n"), F.sum(F.least("n", "n_links")).alias("hits")).first())
    return row["hits"] / row["n"] if row["n"] else 1.0
