"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of the first d turns of some conversation. Turns
are named by running sums: each turn has two hashes of its depth and content
(from SHA-256, 60 bits each), and the sums of a prefix's hashes name its node. So
no conversation is ever gathered, however long it is.

Node (d, c), c its smallest member, has two arcs, enter and exit. Sorting every
node with its children (by smallest member) tells each arc's successor:

* enter -> enter of the first child, or the node's own exit at a leaf;
* exit -> enter of the next sibling, or the parent's exit after the last one.

The arcs form one list, which ``scans.list_ranks`` ranks. Sorted by rank, running
sums of a value that stands at the enter arcs give its total over every subtree:
the sum at the exit arc less the sum before the enter arc.

Root, hot nodes and long conversations: children are sorted by range, counts are
combined before they move, and the conversations that end in a node are joined
into texts of up to 4,096 ids before one task hashes a node's texts as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scans import list_ranks, scan
from .shared import store

WORDS = r"[^\x20\x09-\x0D]+"
CHUNK_BITS = 12  # ids of 2^12 in a row are joined before they are hashed

NODE = ("depth", "f1", "f2")


def turn_numbers(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """``conv_id, number`` (from 1), ``content`` (digest of role and text), ``words``.

    Turns are ordered by (turn, role, SHA-256 of the text), nulls first; null roles
    and texts are empty. Repeated rows are turns of their own. Rows without a
    conversation id are left out.
    """
    clean = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("text"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS)).cast("bigint").alias("words"),
        F.lit(1).cast("bigint").alias("one"))
    return scan(clean, ["conv_id"], ["turn", "role", "text"], ["one"], name="trie-turns").select(
        "conv_id", F.col("one_sum").alias("number"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
        .alias("content"), "words")


def _part(digest: str, at: int) -> Column:
    """60 bits of a hexadecimal digest as a long."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")


def _paths(members: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv_id, depth, f1, f2`` of every prefix, its parent's ``p1, p2``, the words
    of its last turn, and ``next`` (null where the conversation ends)."""
    digest = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), "content"), 256)
    hashed = turns.select("conv_id", F.col("depth").cast("bigint").alias("depth"), "words",
                          digest.alias("digest")).select(
        "conv_id", "depth", "words", _part("digest", 1).alias("f1"), _part("digest", 16).alias("f2"))
    zero = F.lit(0).cast("bigint")
    roots = members.select("conv_id", zero.alias("depth"), zero.alias("words"),
                           zero.alias("f1"), zero.alias("f2"))
    return scan(hashed.unionByName(roots), ["conv_id"], ["depth"], ["f1", "f2"], "depth",
                name="trie-paths").select(
        "conv_id", "depth", F.col("f1_sum").alias("f1"), F.col("f2_sum").alias("f2"),
        F.col("f1_before").alias("p1"), F.col("f2_before").alias("p2"), "words", "next")


def _ends(paths: DataFrame) -> DataFrame:
    """``ends_sha256`` of every node in which a conversation ends."""
    texts = (paths.where("next IS NULL")
             .groupBy(*NODE, F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
             .agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for *key, text in zip(*[batch.column(c).to_pylist() for c in (*NODE, "text")]):
                if key != node:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, digest.hexdigest())],
                                             names=names)

    names = [*NODE, "ends_sha256"]
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").mapInArrow(
        run, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string")


def _arcs(nodes: DataFrame) -> DataFrame:
    """Every node's two arcs ``(a, b)`` with their successors. ``a`` is the node's
    smallest member, ``b`` twice its depth, plus one for the exit. Enter arcs carry
    ``leaf`` and ``saved``, exit arcs the parent's smallest member."""
    zero = F.lit(0).cast("bigint")
    as_parent = nodes.select(
        F.col("depth").alias("g"), F.col("f1").alias("g1"), F.col("f2").alias("g2"),
        zero.alias("child"), "conv_id", F.col("conv_id").alias("up"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    as_child = nodes.where("depth > 0").select(
        (F.col("depth") - 1).alias("g"), F.col("p1").alias("g1"), F.col("p2").alias("g2"),
        F.lit(1).cast("bigint").alias("child"), "conv_id", zero.alias("up"), zero.alias("saved"))
    # A family is a node and its children; the running sum of ``up`` is the parent.
    family = scan(as_parent.unionByName(as_child), ["g", "g1", "g2"], ["child", "conv_id"], ["up"],
                  "conv_id", name="trie-family")
    null = F.lit(None).cast("bigint")
    more = F.col("next").isNotNull()
    enter = family.where("child = 0").select(
        F.col("conv_id").alias("a"), (2 * F.col("g")).alias("b"),
        F.coalesce("next", "conv_id").alias("na"),
        F.when(more, 2 * F.col("g") + 2).otherwise(2 * F.col("g") + 1).alias("nb"),
        F.when(more, 0).otherwise(1).cast("bigint").alias("leaf"), "saved", null.alias("parent"))
    leave = family.where("child = 1").select(
        F.col("conv_id").alias("a"), (2 * F.col("g") + 3).alias("b"),
        F.coalesce("next", "up_sum").alias("na"),
        F.when(more, 2 * F.col("g") + 2).otherwise(2 * F.col("g") + 1).alias("nb"),
        zero.alias("leaf"), zero.alias("saved"), F.col("up_sum").alias("parent"))
    end = family.where("child = 0 AND g = 0").select(
        F.col("conv_id").alias("a"), F.lit(1).cast("bigint").alias("b"), null.alias("na"),
        null.alias("nb"), zero.alias("leaf"), zero.alias("saved"), null.alias("parent"))
    return enter.unionByName(leave).unionByName(end)


def prefix_trie(members: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of the conversations ``members`` (``conv_id``, unique).

    ``turns`` has ``conv_id, depth`` (1, 2, ... without a gap, each once per
    conversation), ``content`` (a string that is the same for equal turns) and
    ``words``. Returns per node ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (over the
    subtree, each node's words times its members but one) and ``ends_sha256`` (of
    the ids of the members that end there, in order, joined by commas).

    A member without turns belongs to the root. Turns of no member, and null ids,
    must not be given. Without members there is no node. Other columns are not read.
    """
    paths = store(_paths(members, turns), "trie-prefixes")
    counted = store(paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2")), "trie-nodes")
    children = counted.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")).agg(
        F.count("*").alias("n_children"))
    nodes = counted.join(children, list(NODE), "left").join(_ends(paths), list(NODE), "left").select(
        "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    ranked = list_ranks(_arcs(counted), "trie-ranks")
    summed = scan(ranked, [], ["rank"], ["leaf", "saved"], name="trie-tour")
    enters = F.col("b") % 2 == 0

    def total(value: str) -> Column:
        return F.sum(F.when(enters, -F.col(f"{value}_before")).otherwise(F.col(f"{value}_sum")))

    trees = summed.groupBy(F.col("a").alias("conv_id"), F.shiftright("b", 1).alias("depth")).agg(
        F.max("parent").alias("parent_conv_id"), total("leaf").alias("n_leaves"),
        total("saved").alias("saved_tokens"))
    return nodes.join(trees, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")
