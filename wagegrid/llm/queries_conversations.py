"""Registered query over conversations: the prefix trie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import store
from .trie import prefix_trie, turn_numbers

GROUP = 20          # conversations c - c % GROUP ... share first turns
SHARED = 4          # crc32(c) % SHARED turns are taken from the group's first one
SLICE = 100_000     # turns of a conversation that meet its row in one task


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c and the turns of its rebuilt form (``conv_id, depth,
    content, words``): the first h turns of conversation c - c % 20, then c's own
    turns after its first h; h = crc32(c) % 4.

    The turns of c meet c's row by (c, slice), so a very long conversation is not
    in one place.
    """
    counts = numbered.groupBy("conv_id").agg(F.max("number").alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("bigint")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    convs = store(
        counts.select("conv_id", "n", h.alias("h"), base.alias("base")).join(
            counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
        .select("conv_id", "n", "h", "base",
                F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "trie-conversations")
    first = numbered.where(F.col("number") < SHARED).withColumnRenamed("conv_id", "base")
    taken = convs.where("taken > 0").join(first, "base").where("number <= taken").select(
        "conv_id", F.col("number").alias("depth"), "content", "words")
    part = (F.col("number") / F.lit(SLICE)).cast("bigint")
    parts = convs.select("conv_id", "taken", "h", F.explode(F.sequence(
        F.lit(0).cast("bigint"), (F.col("n") / F.lit(SLICE)).cast("bigint"))).alias("part"))
    own = numbered.where(F.col("number") > h).withColumn("part", part).join(
        parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("number") - F.col("h") + F.col("taken")).alias("depth"), "content", "words")
    return convs.select("conv_id"), taken.unionByName(own)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    numbered = store(turn_numbers(rows), "trie-numbered")
    return prefix_trie(*rebuilt(numbered))
