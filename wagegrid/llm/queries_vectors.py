"""Registered queries over embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import hnsw, vecdedup


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every vector whose id is divisible by 50."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return hnsw.search(rows, rows.where("vec_id % 50 = 0"), k=5)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine >= 0.95 between all vectors, and their components."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return vecdedup.near_duplicates(rows, limit=0.95)
