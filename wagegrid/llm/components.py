"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, store

BLOCK = 200_000  # edges contracted at a time within a task
PIECES = 8       # parts of a task's fair share that a hub's edges are dealt in
HUB = 100        # edges that no node needs to share with another slice


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges ``(node, smallest node of its component)`` of the edges a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:  # hook the larger root to the smaller one, then shorten all paths
        lx, ly = label[x], label[y]
        low, high = np.minimum(lx, ly), np.maximum(lx, ly)
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while True:
            short = label[label]
            if (short == label).all():
                break
            label = short
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def contract(edges: DataFrame) -> DataFrame:
    """Replace the edges of each task, block by block, by star edges of the same
    components. Fewer edges, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out():
            u, v = forest(*np.concatenate(held, axis=1))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]))
            size += batch.num_rows
            if size >= BLOCK:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return edges.select("u", "v").mapInArrow(run, "u bigint, v bigint")


def _star(edges: DataFrame, large: bool, count: int) -> DataFrame:
    """One star operation on ``count`` edges with u > v, or fewer.

    Large: every larger neighbour of a node is linked to its smallest
    neighbour (itself included). Small: every smaller one, and the node.
    The smallest neighbour is aggregated before the shuffle and joined back. The
    edges of a hub, a node with more than its share of them, meet it in slices, by
    their other end; there are at most ``PIECES`` hubs a task.
    """
    rows = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
        if large else edges
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(2 * count // (PIECES * tasks), HUB)
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    slices = (F.col("n") / share).cast("bigint") + 1
    hubs = F.broadcast(least.where(F.col("n") >= share).select("u", slices.alias("slices")))
    dealt = rows.join(hubs, "u", "left").select(
        "u", "v", F.pmod(F.xxhash64("v"), F.coalesce("slices", F.lit(1))).alias("slice"))
    told = least.select("u", F.least("u", "m").alias("m") if large else "m", F.explode(F.sequence(
        F.lit(0).cast("bigint"), slices - 1)).alias("slice"))
    met = dealt.join(told, ["u", "slice"])
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (the smallest node reachable) of every linked node.

    ``edges`` has long columns ``u`` and ``v``; order, repeats and loops do not
    matter. Rows with a null end are no links. Nodes without a link (and an
    empty table) give no rows. Every round is written to the shared folder; the
    loop ends when a round changes nothing.
    """
    tidy = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = store(contract(tidy).distinct(), name)
    mark = _mark(now)
    while mark[0]:
        after = store(_star(_star(contract(now), True, mark[0]), False, 2 * mark[0]), name)
        discard(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return now.groupBy("u").agg(F.min("v").alias("component")).select(
        F.col("u").alias("node"), "component")


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free hash of the edges."""
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(h), F.lit(0)),
                    F.coalesce(F.sum(F.shiftright(h, 20)), F.lit(0))).first()
    return tuple(row)
