"""Which stored files may hold a key.

Beside a table that is appended to by new keys stands an index: per file the
smallest and largest value of the first key column and a Bloom filter of the keys.
An arriving batch is looked up there first, and only files that may hold one of its
keys are scanned for the exact anti join. A filter that says yes by chance costs a
scan and changes nothing.

The index is a stored table with a partition per load of the source; a load's rows
are written once, from its key columns, when a lookup first needs them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import normalize_keys
from ..operators.merge import with_key_columns
from . import versions
from .tables import StagedAppend, stage_append, write_load
from .versions import Version

BITS, HASHES = 10, 4   # per key
ROW_KEYS = 1 << 20     # keys of a row of the index; a file may have several rows
INDEX = "file string, low bigint, high bigint, nulls boolean, bits bigint, bloom binary"


def _value(schema: T.StructType, key: str) -> Column:
    """The first key column as a long that keeps its order; NULL for other types."""
    kind = schema[key].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(f"`{key}`").cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(f"`{key}`").cast("bigint")
    return F.lit(None).cast("bigint")


def _hashed(rows: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """A hash of the keys (NULL-safe) and the first one's value, and columns ``more``."""
    keyed, cols = with_key_columns(rows.select(*dict.fromkeys([*keys, *more])), keys)
    return keyed.select(F.xxhash64(*cols).alias("h"), _value(rows.schema, keys[0]).alias("value"), *more)


def _places(h: np.ndarray, size: int) -> np.ndarray:
    """``HASHES`` places of every key in a filter of ``size`` bits."""
    h = h.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(size)


def _index_rows(hashed: DataFrame) -> DataFrame:
    """Rows of ``INDEX`` for rows ``h, value, __file``."""
    def row(file: str, h: np.ndarray, value: pa.ChunkedArray):
        size = max(64, len(h) * BITS)
        bits = np.zeros(size, np.uint8)
        bits[_places(h, size).reshape(-1).astype(np.int64)] = 1
        known = value.drop_null().to_numpy()
        cells = (file, int(known.min()) if len(known) else None, int(known.max()) if len(known) else None,
                 bool(value.null_count), size, np.packbits(bits, bitorder="little").tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([c], t) for c, t in zip(cells, (pa.string(), pa.int64(), pa.int64(), pa.bool_(),
                                                      pa.int64(), pa.binary()))],
            names=[c.split()[0] for c in INDEX.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held, n = None, [], 0

        def out():
            table = pa.Table.from_batches(held)
            return row(file, table["h"].to_numpy(), table["value"])

        for batch in batches:
            names = batch.column("__file").to_pandas()
            edges = [0, *(np.flatnonzero(names.values[1:] != names.values[:-1]) + 1), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if b == a:
                    continue
                if held and (names[a] != file or n >= ROW_KEYS):
                    yield out()
                    held, n = [], 0
                file, n = names[a], n + b - a
                held.append(batch.slice(a, b - a).select(["h", "value"]))
        if held:
            yield out()

    return hashed.mapInArrow(run, INDEX)


def refresh_index(spark: SparkSession, source: str, index: str, keys: Sequence[str] | str) -> Version | None:
    """Bring the index up to the source's current version and return that."""
    at, have = versions.latest(spark, source), versions.latest(spark, index)
    if at is None:
        return None
    own = {f"source={load}" for load in at.loads()}
    kept = [p for p in have.parts if p[1] in own] if have else []
    known = {folder for _, folder in kept}
    new = [p for p in at.parts if f"source={p[0]}" not in known]
    if new or (have and len(kept) < len(have.parts)):
        parts = list(kept)
        schema = T.StructType.fromDDL(INDEX).add("source", T.StringType())
        if new:
            keys = normalize_keys(keys)
            rows = versions.read(spark, source, at, new, extra={"__file": F.col("_metadata.file_path")})
            # A row of the index is about one file, whose path names the load.
            made = _index_rows(_hashed(rows, keys, "__file")).withColumn(
                "source", F.regexp_extract("file", f"/{versions.LOAD}=([^/]+)/", 1))
            load = write_load(made, index, ["source"])
            parts += versions.written_parts(spark, index, load, 1)
        versions.commit(spark, index, have, schema, ("source",), parts)
    return at


def candidate_files(spark: SparkSession, index: str, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """The indexed files that may hold a key of ``batch``.

    The batch's keys (its caller has bounded their number) go to the tasks, sorted
    by value; a task takes rows of the index one by one.
    """
    pairs = _hashed(batch, keys).orderBy("value").toArrow()
    h, value = pairs["h"].to_numpy(), pairs["value"]
    nulls = value.null_count  # they come first
    ranged = value.drop_null().to_numpy()
    sent = spark.sparkContext.broadcast((h, ranged, nulls))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, ranged, nulls = sent.value
        for rows in batches:
            hit = []
            for r in rows.to_pylist():
                near = [h[:nulls]] if r["nulls"] else []
                if r["low"] is not None:
                    a, b = np.searchsorted(ranged, r["low"]), np.searchsorted(ranged, r["high"], "right")
                    near.append(h[nulls + a:nulls + b])
                bloom = np.frombuffer(r["bloom"], np.uint8)
                found = False
                for part in near:
                    for at in range(0, len(part), 1 << 18):
                        p = _places(part[at:at + (1 << 18)], r["bits"]).astype(np.int64)
                        found |= bool((bloom[p >> 3] >> (p & 7) & 1).all(axis=1).any())
                hit.append(found)
            kept = rows.filter(pa.array(hit)).select(["file"])
            if kept.num_rows:
                yield kept

    rows = versions.read(spark, index, versions.latest(spark, index)).drop("source")
    return [r.file for r in rows.mapInArrow(run, "file string").distinct().collect()]


def append_indexed(spark: SparkSession, new: DataFrame, target: str, keys: Sequence[str] | str,
                   sequence: Sequence[str] | str, index: str,
                   partition_by: Sequence[str] | None = None,
                   cluster_by: Sequence[str] = ()) -> StagedAppend:
    """``stage_append`` that scans only the files which may hold an arriving key.

    ``index`` is where the key index of ``target`` is kept; it is brought up to date
    first. A batch whose keys exceed the broadcast bound is looked up in all files.
    """
    refresh_index(spark, target, index, keys)
    return stage_append(spark, new, target, keys, sequence, partition_by, cluster_by,
                        holders=lambda batch: candidate_files(spark, index, batch,
                                                              normalize_keys(keys)))
