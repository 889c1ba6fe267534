"""Vector tables: valid rows, packing into shard rows and query blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import store


def takes_part(id_col: str, vector_col: str) -> Column:
    """Not null (id, vector, components), not empty, finite and not zero."""
    vec = F.col(vector_col).cast("array<double>")
    return (F.col(id_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
            & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v)
                       & (F.abs(v) != F.lit(float("inf"))))
            & F.exists(vec, lambda v: v != 0))


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vec`` (doubles) of the rows that take part. Zero components get one
    sign, so that equal vectors have equal arrays."""
    return vectors.where(takes_part(id_col, vector_col)).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(F.col(vector_col).cast("array<double>"),
                    lambda v: v + F.lit(0.0)).alias("vec"))


def as_matrix(lists) -> np.ndarray:
    """A (rows, dimensions) array of an Arrow column of equal-length lists."""
    if isinstance(lists, list):
        return np.array(lists, np.float64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1).astype(np.float64) if len(lists) else flat.reshape(0, 0)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision."""
    return (a * b).sum(axis=1) / (norms(a) * norms(b))


def spread(spark: SparkSession, units: int) -> int:
    """Tasks for so many heavy units of work: one each, up to four times the
    session's shuffle partitions."""
    return max(1, min(units, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def exact_neighbours(vectors: DataFrame, queries: DataFrame, k: int | None = None,
                     limit: float | None = None, id_col: str = "vec_id",
                     vector_col: str = "embedding", most: int = 1024) -> DataFrame:
    """Brute force for an audit: ``query_id, vec_id, score`` of each query's ``k``
    nearest other ids, or of all with a cosine of at least ``limit``.

    Blocks of about ``most`` queries of one dimension go to every task in turn, so
    the work is rows times queries.
    """
    asked = store(valid(queries, id_col, vector_col).distinct().withColumn("dim", F.size("vec")),
                  "exact-queries")
    rows = valid(vectors, id_col, vector_col)
    pairs = vectors.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    for r in asked.groupBy("dim").count().collect():
        blocks = -(-r["count"] // most)
        for block in range(blocks):
            here = (F.col("dim") == r["dim"]) & (F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)) == block)
            drawn = asked.where(here).collect()
            if drawn:
                pairs = pairs.unionByName(_compared(
                    rows.where(F.size("vec") == r["dim"]), np.array([q["id"] for q in drawn], np.int64),
                    np.array([q["vec"] for q in drawn], np.float64), k, limit))
    if limit is not None:
        return pairs
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).drop("n")


def _compared(rows: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int | None,
              limit: float | None) -> DataFrame:
    """All rows against one block of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                ids, x = part.column("id").to_numpy(), as_matrix(part.column("vec"))
                score = (q / norms(q)[:, None]) @ (x / norms(x)[:, None]).T
                score[q_ids[:, None] == ids[None, :]] = -2.0
                if limit is None:  # this block's best can be among the nearest
                    n = min(k, len(ids))
                    col = np.argpartition(-score, n - 1, axis=1)[:, :n].ravel()
                    row = np.repeat(np.arange(len(q)), n)
                    row, col = row[score[row, col] > -2], col[score[row, col] > -2]
                else:
                    row, col = np.nonzero(score >= limit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[row]), pa.array(ids[col]), pa.array(score[row, col])],
                    names=["query_id", "vec_id", "score"])

    return rows.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
