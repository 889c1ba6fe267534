"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

Fingerprints that differ in at most ``max_bits`` (up to 3) of 64 bits agree up
to one bit in one of their two 32-bit segments. For each segment a fingerprint
is stored under its segment value and probes the values of the Hamming ball of
radius 1. It is enough to probe those with one bit *cleared*: of two values one
bit apart, the one that has the bit finds the other. All that meet under a
value are compared in full, block by block, and only enough links are kept to
connect them (a spanning forest); no pair list is ever built.

A value under which more than ``dense`` fingerprints meet is split further by
four parts of the bits outside the segment: two that differ in at most three of
these agree in one part. That repeats on the bits still free, so every group
compared is bounded and nothing is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.spread import left_join_spread
from .components import connected_components, forest
from .shared import store
from .tokens import slices

SEED = 42
BITS, SEGMENT = 64, 32
PROBES = 65536  # fingerprints turned into probes at a time
PART = 1 << 20  # bytes of a text worked on at a time


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _text_parts(text: bytes) -> Iterator[bytes]:
    """A text cut at white space into parts of at least ``PART`` bytes."""
    begin = 0
    while len(text) - begin > PART and (m := _SPACE.search(text, begin + PART)):
        yield text[begin:m.start()]
        begin = m.end()
    yield text[begin:] if begin else text


def _ones(words: list[bytes], shingle: int) -> tuple[np.ndarray, int]:
    """How many shingles' hashes have each bit, and the number of shingles."""
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    n = max(len(words) - shingle + 1, 1)
    last = ends[min(shingle, len(words)) - 1:][:n].tolist()
    first = (ends - size + 1)[:n].tolist()
    h64 = xxhash.xxh64_intdigest
    h = np.array([h64(joined[a:b], SEED) for a, b in zip(first, last)], np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), n


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of UTF-8 text: words of lower-cased (A-Z) text between ASCII white
    space, ``shingle`` in a row, repeats counted. Without a word: 0."""
    ones, n, held = np.zeros(BITS, np.int64), 0, []
    for part in _text_parts(text):
        held += part.lower().split()  # bytes: exactly A-Z and the six white-space bytes
        if len(held) >= shingle:
            more, k = _ones(held, shingle)
            ones, n, held = ones + more, n + k, held[len(held) - shingle + 1:]
    if not n and held:
        ones, n = _ones(held, shingle)
    return sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist()) if n else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, others: tuple[str, ...] = ()) -> DataFrame:
    """``id, fp`` (the 64 bits as a long) of every row, and the columns ``others``
    as the struct ``rest`` where there are any; a null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                fps = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64)
                cols = [batch.column("id"), pa.array(fps.view(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    cols + [batch.column("rest")] if others else cols,
                    names=["id", "fp", "rest"][:3 if others else 2])

    rest = [F.struct(*others).alias("rest")] if others else []
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), *rest)
    kind = f", rest {rows.schema['rest'].dataType.simpleString()}" if others else ""
    return rows.mapInArrow(run, f"id bigint, fp bigint{kind}")


KEYED = "key bigint, mask bigint, fp bigint"
FREE = 6  # with so few bits free a group is small and always compared


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64))


def _probe(fps: DataFrame) -> DataFrame:
    """Both segments' stored value and probes of every fingerprint.

    ``key`` tells those that meet, ``mask`` the bits that a key fixes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), PROBES // 32):
                fp = every[at:at + PROBES // 32]
                for seg in range(BITS // SEGMENT):
                    value = (fp >> np.uint64(seg * SEGMENT)) & np.uint64((1 << SEGMENT) - 1)
                    keys, owners = [value], [fp]
                    for bit in range(SEGMENT):
                        has = (value >> np.uint64(bit)) & np.uint64(1) == 1
                        keys.append(value[has] ^ np.uint64(1 << bit))
                        owners.append(fp[has])
                    key = np.concatenate(keys) | np.uint64(seg << SEGMENT)
                    mask = np.full(len(key), ((1 << SEGMENT) - 1) << seg * SEGMENT, np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [_signed(key), _signed(mask), _signed(np.concatenate(owners))],
                        names=["key", "mask", "fp"])

    return fps.mapInArrow(run, KEYED)


def _links(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of all pairs within ``max_bits``, block by block."""
    signed = fp.view(np.int64)
    us, vs, block = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], max(1, (1 << 20) // len(fp))
    for at in range(0, len(fp), block):
        near = np.bitwise_count(fp[at:at + block, None] ^ fp[None, :at + block]) <= max_bits
        x, y = np.nonzero(near)
        x += at
        one = x > y
        if one.any():
            u, v = forest(signed[x[one]], signed[y[one]])
            us.append(u)
            vs.append(v)
    u, v = np.concatenate(us), np.concatenate(vs)
    return forest(u, v) if len(us) > 2 else (u, v)


def _groups(keyed: DataFrame, max_bits: int, dense: int) -> DataFrame:
    """Links ``null, u, v`` within each key. Members of a key with more than
    ``dense`` come back instead, as ``key, fp, mask``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def crowd(key, mask, fp):
            return (np.full(len(fp), key), np.ones(len(fp), bool), fp, np.full(len(fp), mask))

        def close(key, mask, fp, spilt):
            """A finished key: its links, or the rest of its many members."""
            fp = np.unique(fp)
            if spilt or len(fp) > dense and BITS - int(mask & (1 << 64) - 1).bit_count() > FREE:
                return crowd(key, mask, fp)
            if len(fp) < 2:
                return None
            u, v = _links(fp.view(np.uint64), max_bits)
            return np.zeros(len(u), np.int64), np.zeros(len(u), bool), u, v

        carry = None  # key, mask, members, whether some have been handed on

        def batch_of(out):
            out = [x for x in out if x is not None and len(x[0])]
            if out:
                key, crowded, u, v = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, mask=~crowded), pa.array(u), pa.array(v)],
                    names=["key", "u", "v"])

        for batch in batches:
            keys, masks, fps = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(keys):
                continue
            edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            out = []
            if carry is not None and carry[0] == keys[0]:
                begin, fp, spilt = int(edges[1]), np.concatenate([carry[2], fps[:edges[1]]]), carry[3]
                fp = np.unique(fp)
                free = BITS - int(int(carry[1]) & (1 << 64) - 1).bit_count()
                if len(fp) > dense and free > FREE:  # hand the members on, keep memory bounded
                    out.append(crowd(carry[0], carry[1], fp))
                    fp, spilt = fp[:0], True
                carry = (keys[0], carry[1], fp, spilt)
            else:
                begin = 0
            if begin < len(keys):
                if carry is not None:
                    out.append(close(carry[0], int(carry[1]), carry[2], carry[3]))
                last = int(edges[-2])
                inner = (np.diff(edges) > 1) & (edges[:-1] >= begin) & (edges[:-1] < last)
                for a, b in zip(edges[:-1][inner].tolist(), edges[1:][inner].tolist()):
                    out.append(close(keys[a], int(masks[a]), fps[a:b], False))
                carry = (keys[last], masks[last], fps[last:].copy(), False)
            yield from batch_of(out)
        if carry is not None:
            yield from batch_of([close(carry[0], int(carry[1]), carry[2], carry[3])])

    placed = (keyed.repartition(_partitions(keyed), "key", "mask")
              .sortWithinPartitions("key", "mask"))
    return placed.mapInArrow(run, "key bigint, u bigint, v bigint")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _parts(mask: int) -> list[int]:
    """Four interleaved parts of the bits that ``mask`` leaves free."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [sum(1 << b for b in free[k::4]) for k in range(4)]


def _split(crowded: DataFrame) -> DataFrame:
    """Finer keys for the members of crowded keys: the old key with the value of
    one of four parts of the free bits. Fingerprints within 3 bits agree in one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old, fp, mask = (c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns)
            for m in np.unique(mask).tolist():
                here = mask == np.uint64(m)
                for part in _parts(m):
                    value = fp[here] & np.uint64(part)
                    key = _mix(_mix(old[here] ^ np.uint64(part)) ^ value)
                    now = np.full(len(key), m | part, np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [_signed(key), _signed(now), _signed(fp[here])], names=["key", "mask", "fp"])

    return crowded.mapInArrow(run, KEYED)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3, dense: int = 4096) -> DataFrame:
    """``id_col, fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits. Texts without a word have fingerprint 0 and
    link like any other; a null text counts as empty. Repeated rows repeat. A
    null id never is a component's id, unless the whole component has null ids.
    Other columns are not read. An empty table gives no rows.
    """
    return components(docs, id_col, text_col, shingle, max_bits, dense).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = 3, max_bits: int = 3, dense: int = 4096) -> DataFrame:
    """``id, fp, component, component_id`` of every row, as ``near_duplicates``;
    ``component`` tells components apart whose smallest ids are the same."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits: 0 to 3 (two segments, radius 1)")
    marked = store(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    # One row per fingerprint: copies, however many, are counted up first.
    distinct = store(marked.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    found = store(_groups(_probe(distinct.select("fp")), max_bits, dense), "simhash-links")
    links = found.where("key is null").select("u", "v")
    # Each round fixes a quarter of the free bits, so there are few.
    while found.where("key is not null").limit(1).count():
        crowded = found.where("key is not null").select("key", "u", F.col("v").alias("mask"))
        found = store(_groups(_split(crowded), max_bits, dense), "simhash-links")
        links = links.unionByName(found.where("key is null").select("u", "v"))
    parts = connected_components(links, "simhash-components")
    labelled = (distinct.join(parts, distinct["fp"] == parts["node"], "left")
                .select("fp", "first", F.coalesce("component", "fp").alias("component")))
    labelled = store(labelled, "simhash-labels")
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    # A component, or a fingerprint, may have a third of all rows.
    by_fp = store(left_join_spread(labelled, least, "component")
                  .select("fp", "component", "component_id"), "simhash-groups")
    return left_join_spread(marked, by_fp, "fp").select("id", "fp", "component", "component_id")
