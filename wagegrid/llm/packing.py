"""Cost-balanced packing of token ids into fixed-length training sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder, slices


def capacities(total: int, seq_len: int) -> np.ndarray:
    """Room of the sequences for ``total`` tokens: full ones, then the rest as
    falling powers of two, which need no padding."""
    rest = total % seq_len
    small = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([seq_len] * (total // seq_len) + small, np.int64)


def assign(lengths: np.ndarray, seq_len: int, linear: float, quadratic: float
           ) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of one batch.

    Attention within a piece costs ``linear * n + quadratic * n**2``. What a
    document has beyond whole sequences' lengths is taken in descending order;
    each goes to the cheapest sequence so far that has room for all of it. When
    none has, it is cut at the room of the cheapest one with any room left. The
    sequences' room is the number of tokens, so nothing is padded.
    """
    room = capacities(int(lengths.sum()), seq_len)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    full = int(lengths.sum()) // seq_len
    pieces, seq = [], 0
    whole = lengths // seq_len
    for doc in np.flatnonzero(whole):
        for k in range(whole[doc]):
            pieces.append((int(doc), k * seq_len, seq_len, seq, 0))
            seq += 1
    used[:seq], room[:seq] = seq_len, 0
    cost[:seq] = np.inf
    assert seq <= full
    tail = lengths % seq_len
    for doc in np.argsort(-tail, kind="stable"):
        start, left = int(whole[doc]) * seq_len, int(tail[doc])
        while left:
            fits = np.where(room >= left, cost, np.inf)
            best = int(fits.argmin())
            if not np.isfinite(fits[best]):
                best = int(np.where(room > 0, cost, np.inf).argmin())
            n = min(left, int(room[best]))
            pieces.append((int(doc), start, n, best, int(used[best])))
            used[best] += n
            room[best] -= n
            cost[best] += linear * n + quadratic * n * n
            start, left = start + n, left - n
    return pieces


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         seq_len: int = 2048, end_id: int = 1, batch_tokens: int = 1 << 20,
         linear: float = 1.0, quadratic: float = 1.0 / 4096) -> DataFrame:
    """All documents as pieces of sequences of at most ``seq_len`` tokens.

    Returns per piece ``doc_id, start, length, ids`` (little-endian unsigned
    32-bit), ``doc_tokens, sequence_id, offset, cost``. A document is its
    text's ids and ``end_id``; a null or empty text is ``end_id`` alone.

    Each task packs batches of about ``batch_tokens`` tokens on their own, so
    memory is bounded and nothing is shuffled; a document with more tokens than
    that is a batch with its neighbours. Every sequence is full or has a
    power-of-two length. Repeated rows are packed once each; null ids stay null.
    Other columns are not read. An empty table gives no rows. Sequence numbers
    hold the partition's number in their upper bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoder(tokenizer), TaskContext.get().partitionId() << 36
        names, ids, held, done = [], [], 0, 0
        for whole in batches:
            for batch in slices(whole):
                texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
                flat, counts = enc.encode(texts)
                ids += np.split(flat, np.cumsum(counts)[:-1])
                names.append(batch.column("id"))
                held += len(flat) + len(texts)
                if held >= batch_tokens:
                    out, done = _pack_batch(names, ids, base, done)
                    yield out
                    names, ids, held = [], [], 0
        if ids:
            yield _pack_batch(names, ids, base, done)[0]

    def _pack_batch(names, ids, base, done):
        key = pa.concat_arrays(names)
        tokens = [np.append(x, end_id).astype("<u4") for x in ids]
        sizes = np.array([len(x) for x in tokens], np.int64)
        rows = assign(sizes, seq_len, linear, quadratic)
        doc, start, length, seq, offset = (np.array(c, np.int64) for c in zip(*rows))
        body = [tokens[d][s:s + n].tobytes() for d, s, n, _, _ in rows]
        cost = linear * length + quadratic * length.astype(float) ** 2
        out = pa.RecordBatch.from_arrays(
            [key.take(pa.array(doc)), pa.array(start), pa.array(length),
             pa.array(body, pa.binary()), pa.array(sizes[doc]), pa.array(base + done + seq),
             pa.array(offset), pa.array(cost)],
            names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"])
        return out, done + int(seq.max()) + 1

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"{id_col} {kind}, start bigint, length bigint, ids binary, "
                                "doc_tokens bigint, sequence_id bigint, offset bigint, cost double")
