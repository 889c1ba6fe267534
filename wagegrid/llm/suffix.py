"""Removal of long repeated strings across documents, by suffix arrays of shards.

Every byte covered by a ``width``-byte string that also starts in a document
with a smaller id is removed; strings are judged on the input.

1. Each ``width``-byte window is put under the smallest hash of the ``GRAM``-byte
   strings inside it. Equal windows have equal hashes, so they always meet.
   Consecutive windows under one hash are a *segment* of text.
2. Hashes are dealt over buckets to find those that occur in two documents at
   least. Each group of documents sends a hash once, whatever its copies.
3. Segments under such hashes go to the shard of their hash, equal ones of a
   group of documents once, with their smallest document id. A hash whose
   segments may hold more than ``SORT_BYTES`` is split: its different windows go
   to shards by their own hash, each once a group with its smallest document id.
4. A shard sorts its different segments into a suffix array by induced sorting;
   common prefixes of ``width`` bytes or more, in text order, give the classes
   of equal windows and the smallest document of each. (Segments alone under
   their hash have no other to be compared with.) Single windows are compared
   by a 128-bit hash.
5. Groups of documents get back, for their segments, the windows found in
   smaller documents, and cut the bytes these cover.

Groups, buckets and shards hold a bounded share of the text, so their number
grows with it; a passage in very many documents counts once a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sais import permuted_lcp, suffix_array
from .shared import discard, store

GRAM = 16          # bytes hashed
CHUNK = 1 << 18    # bytes of text worked on at a time
MAX_RUN = 1024     # windows of a segment; longer runs are split
GROUP_BYTES = 2 << 20    # text of a group of documents
BUCKET_BYTES = 4 << 20   # text whose hashes share a bucket, and a shard
FLUSH_BYTES = 16 << 20   # segments a task holds before it sends them
SORT_BYTES = 4 << 20     # text sorted into one suffix array
SMALL = 128              # bytes under a hash in a group that are told as none
SPREAD = 4               # shards of windows a bucket
WINDOWS = 1 << 17        # windows hashed at a time

ROWS = "bucket int, g int, body binary"
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position, from halves of halves."""
    h = (buf.astype(np.uint64) + np.uint64(1)) * _M1
    size = 1
    while size < GRAM:
        right = h[size:]
        h = (h[:-size] * _M2) ^ (right * _M1 + (right >> np.uint64(29)))
        size *= 2
    h ^= h >> np.uint64(32)
    h *= _M2
    return h ^ (h >> np.uint64(29))


def _lowest(h: np.ndarray, span: int) -> np.ndarray:
    """Smallest of ``span`` values from every position."""
    out, size = h, 1
    while 2 * size <= span:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < span:
        n = len(h) - span + 1
        out = np.minimum(out[:n], out[span - size:span - size + n])
    return out


class Chunk:
    """Whole short texts, or a part of a long one, joined into one buffer."""

    def __init__(self, parts: list[tuple[int, int, bytes]], width: int):
        """``parts``: document's place, offset in its text, bytes."""
        self.docs = np.array([p[0] for p in parts], np.int64)
        self.data = b"".join(p[2] for p in parts)
        size = np.array([len(p[2]) for p in parts], np.int64)
        begin = np.cumsum(size) - size
        self.shift = np.array([p[1] for p in parts], np.int64) - begin
        buf = np.frombuffer(self.data, np.uint8)
        self.hash = np.zeros(0, np.uint64)
        self.start = self.count = self.part = np.zeros(0, np.int64)
        if len(buf) < width:
            return
        low = _lowest(_gram_hashes(buf), width - GRAM + 1)
        owner = np.repeat(np.arange(len(parts), dtype=np.int32), size)
        inside = owner[:len(low)] == owner[width - 1:]
        new = np.ones(len(low), bool)
        new[1:] = ((low[1:] != low[:-1]) | (inside[1:] != inside[:-1])
                   | (owner[1:len(low)] != owner[:len(low) - 1]))
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(low)))
        kept = inside[start]
        start, count = start[kept], count[kept]
        if len(count) and count.max() > MAX_RUN:
            pieces = -(-count // MAX_RUN)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            whole = np.repeat(count, pieces)
            start = np.repeat(start, pieces) + nth * MAX_RUN
            count = np.minimum(whole - nth * MAX_RUN, MAX_RUN)
        self.hash, self.start, self.count, self.part = low[start], start, count, owner[start]


def chunks(texts: list[bytes], width: int) -> Iterator[Chunk]:
    """Chunks that hold every window of every text once."""
    parts, held = [], 0
    for k, text in enumerate(texts):
        if len(text) < width:
            continue
        if len(text) > CHUNK:
            for at in range(0, len(text) - width + 1, CHUNK):
                yield Chunk([(k, at, text[at:at + CHUNK + width - 1])], width)
            continue
        parts.append((k, 0, text))
        held += len(text)
        if held >= CHUNK:
            yield Chunk(parts, width)
            parts, held = [], 0
    if parts:
        yield Chunk(parts, width)


def _keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a hash and 32 of its other bits, as one number."""
    return ((h >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)


def _by_bucket(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Bucket and range of each run of sorted keys."""
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b > a:
            yield int(bucket[a]), a, b


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())],
        names=["bucket", "g", "body"])


class _Group:
    """A group of documents and the rows sent to it."""

    def __init__(self, g: int):
        self.g, self.sent, self.ids, self.texts, self.rest = g, [], [], [], []


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[_Group]:
    """Groups out of rows sorted by ``g, kind``: first what was sent, then texts."""
    group = None
    for batch in batches:
        g, kind, num = (batch.column(k).to_pylist() for k in ("g", "kind", "num"))
        body = batch.column("body")
        rest = batch.column("rest") if "rest" in batch.schema.names else None
        for n in range(batch.num_rows):
            if group is None or g[n] != group.g:
                if group is not None:
                    yield group
                group = _Group(g[n])
            data = body[n].as_py()
            if kind[n]:
                group.ids.append(num[n])
                group.texts.append(data)
                if rest is not None:
                    group.rest.append(rest.slice(n, 1))
            else:
                group.sent.append((num[n], data))
    if group is not None:
        yield group


def _known(group: _Group) -> tuple[list[int], list[bytes]]:
    """Documents that take part: those with an id."""
    some = [k for k, i in enumerate(group.ids) if i is not None]
    return some, [group.texts[k] for k in some]


def _find_hashes(width: int, buckets: int):
    """Step 2a: the different hashes of a group, with a byte that says whether two
    documents of the group have them and bounds the bytes of their segments:
    fewer than ``SMALL << (byte & 127)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            some, texts = _known(group)
            ids = np.array([group.ids[k] for k in some], np.int64)
            keys, low, high, held = [], [], [], []
            for c in chunks(texts, width):
                key = _keys(c.hash, buckets)
                doc = ids[c.docs[c.part]] if len(key) else np.zeros(0, np.int64)
                order = np.argsort(key, kind="stable")
                k, first = np.unique(key[order], return_index=True)
                if len(k):
                    keys.append(k)
                    low.append(np.minimum.reduceat(doc[order], first))
                    high.append(np.maximum.reduceat(doc[order], first))
                    held.append(np.add.reduceat(c.count[order] + width - 1, first))
            if not keys:
                continue
            key, lo, hi, size = (np.concatenate(x) for x in (keys, low, high, held))
            order = np.argsort(key, kind="stable")
            key, first = np.unique(key[order], return_index=True)
            twice = (np.minimum.reduceat(lo[order], first) != np.maximum.reduceat(hi[order], first))
            _, level = np.frexp((np.add.reduceat(size[order], first) // SMALL).astype(float))
            bits, flag = key.astype(np.uint32), (twice * 128 + level).astype(np.uint8)
            yield _table([(b, group.g, bits[x:y].tobytes() + flag[x:y].tobytes())
                          for b, x, y in _by_bucket(key)])
    return run


def _shared_hashes(buckets: int, most: int):
    """Step 2b: per bucket, the hashes that two documents have, back to groups;
    those that may hold over ``most`` bytes under a number from ``buckets`` on."""
    def close(bucket, rows):
        groups, bodies = zip(*rows)
        size = np.array([len(x) // 5 for x in bodies])
        bits = np.concatenate([np.frombuffer(x, np.uint32, n) for x, n in zip(bodies, size)])
        flag = np.concatenate([np.frombuffer(x, np.uint8, n, 4 * n) for x, n in zip(bodies, size)])
        g = np.repeat(np.array(groups), size)
        order = np.argsort(bits, kind="stable")
        value, first, count = np.unique(bits[order], return_index=True, return_counts=True)
        shared = (count > 1) | (np.maximum.reduceat(flag[order], first) > 127)
        hot = np.add.reduceat(SMALL << (flag[order] & 127).astype(np.int64), first) > most
        out = []
        for num, some in ((bucket, shared & ~hot), (buckets + bucket, shared & hot)):
            keep = order[np.repeat(some, count)]
            keep = keep[np.argsort(g[keep], kind="stable")]
            out += [(num, int(g[keep[a]]), bits[keep[a:b]].tobytes())
                    for a, b in zip(*_edges(g[keep]))]
        return _table(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _per_bucket(batches, close)
    return run


def _per_bucket(batches, close) -> Iterator[pa.RecordBatch]:
    bucket, rows = None, []
    for batch in batches:
        for b, g, body in zip(*(batch.column(k).to_pylist() for k in ("bucket", "g", "body"))):
            if b != bucket:
                if rows:
                    yield close(bucket, rows)
                bucket, rows = b, []
            rows.append((g, body))
    if rows:
        yield close(bucket, rows)


def _wanted(group: _Group, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the hashes sent to a group, and of those to be split."""
    keys, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for num, body in group.sent:
        keys.append(np.uint64(num % buckets) << np.uint64(32)
                    | np.frombuffer(body, np.uint32).astype(np.uint64))
        if num >= buckets:
            hot.append(keys[-1])
    return np.sort(np.concatenate(keys)), np.sort(np.concatenate(hot))


def _member(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _segments(width: int, buckets: int):
    """Step 3: a group's different segments under shared hashes, with their
    smallest and largest document id, to the shards of the hashes; of hashes to
    be split the different windows, to the shards of the windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(g, found, split):
            text, rows = list(found), np.array(list(found.values()), object)
            key = rows[:, 0].astype(np.uint64)
            hot = _member(split, key)
            some = np.flatnonzero(hot)
            ends = np.cumsum([len(text[k]) - width + 1 for k in some])
            for a, b in zip(*_edges(ends // WINDOWS)):
                part = some[a:b]
                yield _table(_windows(g, [text[k] for k in part], key[part],
                                      rows[part, 1].astype(np.int64),
                                      rows[part, 2].astype(np.int64), width, buckets))
            order = np.flatnonzero(~hot)
            order = order[np.argsort(key[order], kind="stable")]
            key = key[order]
            lo, hi = rows[order, 1].astype(np.int64), rows[order, 2].astype(np.int64)
            size = np.array([len(text[k]) for k in order], np.uint16)
            out = []
            for b, x, y in _by_bucket(key):
                head = np.array([y - x], np.uint32).tobytes()
                body = b"".join(text[k] for k in order[x:y])
                out.append((b, g, head + key[x:y].astype(np.uint32).tobytes() + size[x:y].tobytes()
                            + lo[x:y].tobytes() + hi[x:y].tobytes() + body))
            yield _table(out)

        for group in _groups(batches):
            table, split = _wanted(group, buckets)
            if not len(table):
                continue
            some, texts = _known(group)
            ids = [group.ids[k] for k in some]
            found: dict[bytes, list] = {}
            held = 0
            for c in chunks(texts, width):
                key = _keys(c.hash, buckets)
                hit = np.flatnonzero(_member(table, key))
                begin = c.start[hit]
                data = c.data
                for k, a, b, p in zip(key[hit].tolist(), begin.tolist(),
                                      (begin + c.count[hit] + width - 1).tolist(),
                                      c.docs[c.part[hit]].tolist()):
                    text, doc = data[a:b], ids[p]
                    old = found.get(text)
                    if old is None:
                        found[text] = [k, doc, doc]
                        held += b - a
                    elif doc < old[1]:
                        old[1] = doc
                    elif doc > old[2]:
                        old[2] = doc
                if held > FLUSH_BYTES:
                    yield from send(group.g, found, split)
                    found, held = {}, 0
            if found:
                yield from send(group.g, found, split)
    return run


def _windows(g: int, texts: list[bytes], key: np.ndarray, lo: np.ndarray, hi: np.ndarray,
             width: int, buckets: int) -> list[tuple]:
    """Rows of the different windows of segments: hash, key, smallest and largest
    document. Their shards are numbered from ``buckets`` on."""
    h = xxhash.xxh3_128_digest
    count = np.array([len(t) - width + 1 for t in texts])
    digest = np.frombuffer(b"".join([h(t[k:k + width]) for t, n in zip(texts, count.tolist())
                                     for k in range(n)]), np.uint64).reshape(-1, 2)
    shard = (buckets + digest[:, 0] % np.uint64(SPREAD * buckets)).astype(np.int64)
    order = np.lexsort((digest[:, 1], digest[:, 0], shard))
    digest, shard = digest[order], shard[order]
    first = _first(digest)
    owner = np.repeat(np.arange(len(texts)), count)[order]
    lo, hi = np.minimum.reduceat(lo[owner], first), np.maximum.reduceat(hi[owner], first)
    digest, shard, key = digest[first], shard[first], key[owner[first]]
    return [(int(shard[x]), g, digest[x:y].tobytes() + key[x:y].tobytes()
             + lo[x:y].tobytes() + hi[x:y].tobytes()) for x, y in zip(*_edges(shard))]


def _first(digest: np.ndarray) -> np.ndarray:
    """Places of the first of each run of equal rows."""
    return np.flatnonzero(np.append(True, (digest[1:] != digest[:-1]).any(axis=1)))


def _join_windows(bucket: int, rows: list[tuple]) -> pa.RecordBatch:
    """Step 4 for single windows: back to each group those whose smallest document
    is smaller than the largest in the group."""
    digests, keys, lows, highs, groups = [], [], [], [], []
    for g, body in rows:
        n = len(body) // 40
        digests.append(np.frombuffer(body, np.uint64, 2 * n).reshape(-1, 2))
        keys.append(np.frombuffer(body, np.uint64, n, 16 * n))
        lows.append(np.frombuffer(body, np.int64, n, 24 * n))
        highs.append(np.frombuffer(body, np.int64, n, 32 * n))
        groups.append(np.full(n, g))
    digest, key, lo, hi, g = (np.concatenate(x) for x in (digests, keys, lows, highs, groups))
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    first = _first(digest[order])
    least = np.empty(len(lo), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(lo[order], first),
                             np.diff(np.append(first, len(lo))))
    told = least < hi
    digest, key, least, g = digest[told], key[told], least[told], g[told]
    return _table([(bucket, int(g[x]), digest[x:y].tobytes() + key[x:y].tobytes()
                    + least[x:y].tobytes()) for x, y in zip(*_edges(g))])


def _parse_segments(body: bytes):
    n = int(np.frombuffer(body, np.uint32, 1)[0])
    at = 4
    bits = np.frombuffer(body, np.uint32, n, at)
    at += 4 * n
    size = np.frombuffer(body, np.uint16, n, at).astype(np.int64)
    at += 2 * n
    lo = np.frombuffer(body, np.int64, n, at)
    hi = np.frombuffer(body, np.int64, n, at + 8 * n)
    ends = at + 16 * n + np.cumsum(size)
    return bits, lo, hi, [body[a:b] for a, b in zip((ends - size).tolist(), ends.tolist())]


def smallest_documents(texts: list[bytes], first: np.ndarray, width: int
                       ) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every text (one text after the other) the smallest
    ``first`` of all texts that hold the window, by one suffix array over all of
    them; and the number of windows of each text."""
    size = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    begin = np.cumsum(size + 1) - size - 1
    text = raw.astype(np.uint16) + 2
    text[begin + size] = 1  # a separator is in no window
    text = np.append(text, 0)
    array = suffix_array(text, width)
    owner = np.repeat(np.arange(len(texts)), size + 1)
    starts = np.zeros(len(text), bool)
    count = size - width + 1
    at = np.repeat(begin, count) + _ranges(count)
    starts[at] = True
    array = array[starts[array]]  # no other suffix has width bytes in common
    alike = permuted_lcp(text, array, width)[array] >= width
    least = np.minimum.reduceat(first[owner[array]], np.flatnonzero(~alike))
    out = np.empty(len(text), np.int64)
    out[array] = least[np.cumsum(~alike) - 1]
    return out[at], count


def _ranges(count: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _sort_shards(width: int, buckets: int, most: int):
    """Step 4: back to each group, for its segments, runs of windows whose
    smallest document is smaller than the segment's largest in the group."""
    def close(bucket, rows):
        if bucket >= buckets:
            return _join_windows(bucket, rows)
        number: dict[bytes, int] = {}
        parts = []  # per group: segment, smallest and largest document in the group
        hashes, lows = [], []
        for g, body in rows:
            bits, lo, hi, texts = _parse_segments(body)
            known = len(number)
            seg = np.fromiter((number.setdefault(t, len(number)) for t in texts), np.int64, len(texts))
            new = seg >= known
            hashes.append(bits[new])
            lows.append((seg, lo))
            parts.append((np.full(len(seg), g), seg, hi))
        texts, hashes = list(number), np.concatenate(hashes)
        first = np.full(len(texts), np.iinfo(np.int64).max)
        for seg, lo in lows:
            np.minimum.at(first, seg, lo)
        # Runs of each segment; one alone under its hash has a single one.
        runs, begin, doc = np.ones(len(texts), np.int64), [], []
        _, at, kinds = np.unique(hashes, return_inverse=True, return_counts=True)
        single = np.flatnonzero(kinds[at] == 1)
        several = np.flatnonzero(kinds[at] > 1)
        several = several[np.argsort(hashes[several], kind="stable")]
        begin.append(np.zeros(len(single), np.int64))
        doc.append(first[single])
        # Equal windows share the hash, so text may be sorted hash by hash.
        size = np.cumsum(np.array([len(texts[k]) for k in several], np.int64))
        part = 0
        while part < len(several):
            base = size[part - 1] if part else 0
            end = int(np.searchsorted(size, base + most)) + 1
            while end < len(several) and hashes[several[end]] == hashes[several[end - 1]]:
                end += 1
            some = several[part:end]
            least, count = smallest_documents([texts[k] for k in some], first[some], width)
            within = _ranges(count)
            new = within == 0
            new[1:] |= least[1:] != least[:-1]
            begin.append(within[new])
            doc.append(least[new])
            runs[some] = np.add.reduceat(new, np.cumsum(count) - count)
            part = end
        order = np.concatenate([single, several])
        start = np.empty(len(texts), np.int64)
        start[order] = np.cumsum(runs[order]) - runs[order]
        begin, doc = np.concatenate(begin), np.concatenate(doc)
        lowest = np.empty(len(texts), np.int64)
        lowest[order] = np.minimum.reduceat(doc, start[order])
        digest = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64)
        g, seg, high = (np.concatenate(c) for c in zip(*parts))
        told = lowest[seg] < high
        g, seg = g[told], seg[told]
        out = []
        for x, y in zip(*_edges(g)):
            some = seg[x:y]
            n = runs[some]
            row = np.repeat(start[some], n) + _ranges(n)
            head = np.array([len(some), len(row)], np.uint32)
            out.append((bucket, int(g[x]), head.tobytes() + hashes[some].tobytes()
                        + digest[some].tobytes() + n.astype(np.uint16).tobytes()
                        + begin[row].astype(np.uint16).tobytes() + doc[row].tobytes()))
        return _table(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _per_bucket(batches, close)
    return run


def _edges(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal values."""
    at = (np.flatnonzero(np.diff(values)) + 1).tolist()
    return ([0] + at, at + [len(values)]) if len(values) else ([], [])


class _Found:
    """What the shards told a group: per segment digest, runs of windows; per hash
    of a single window, its smallest document."""

    def __init__(self, sent: list[tuple[int, bytes]], buckets: int):
        keys, digests, counts, begins, docs = [], [], [], [], []
        split, self.least, self.seen = [np.zeros(0, np.uint64)], {}, {}
        for bucket, body in sent:
            if bucket >= buckets:
                n = len(body) // 32
                split.append(np.frombuffer(body, np.uint64, n, 16 * n))
                for k, doc in enumerate(np.frombuffer(body, np.int64, n, 24 * n).tolist()):
                    self.least[body[16 * k:16 * k + 16]] = doc
                continue
            n, r = np.frombuffer(body, np.uint32, 2).astype(int).tolist()
            at = 8
            keys.append(np.uint64(bucket) << np.uint64(32)
                        | np.frombuffer(body, np.uint32, n, at).astype(np.uint64))
            at += 4 * n
            digests.append(np.frombuffer(body, np.uint8, 8 * n, at).view(np.uint64))
            at += 8 * n
            counts.append(np.frombuffer(body, np.uint8, 2 * n, at).view(np.uint16))
            at += 2 * n
            begins.append(np.frombuffer(body, np.uint8, 2 * r, at).view(np.uint16))
            docs.append(np.frombuffer(body, np.uint8, 8 * r, at + 2 * r).view(np.int64))
        self.split = np.unique(np.concatenate(split))
        self.keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
        digest = np.concatenate(digests) if keys else np.zeros(0, np.uint64)
        self.count = (np.concatenate(counts) if keys else np.zeros(0)).astype(np.int64)
        self.begin = (np.concatenate(begins) if keys else np.zeros(0)).astype(np.int64)
        self.doc = np.concatenate(docs) if keys else np.zeros(0, np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.order = np.argsort(digest, kind="stable")
        self.digest = digest[self.order]

    def covered(self, c: Chunk, ids: np.ndarray, width: int, buckets: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document places and byte ranges (in the texts) to be removed."""
        return tuple(np.concatenate(x) for x in zip(
            self._of_segments(c, ids, width, buckets), self._of_windows(c, ids, width, buckets)))

    def _of_windows(self, c: Chunk, ids: np.ndarray, width: int, buckets: int
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hit = np.flatnonzero(_member(self.split, _keys(c.hash, buckets)))
        a, n, part = c.start[hit], c.count[hit], c.part[hit]
        doc, begin, end = [], [], []
        for x, y, d, i, s in zip(a.tolist(), (a + n + width - 1).tolist(), c.docs[part].tolist(),
                                 ids[c.docs[part]].tolist(), (a + c.shift[part]).tolist()):
            for least, first, stop in self._runs(c.data[x:y], width):
                if least < i:
                    doc.append(d)
                    begin.append(s + first)
                    end.append(s + stop + width - 1)
        return tuple(np.array(x, np.int64) for x in (doc, begin, end))

    def _runs(self, text: bytes, width: int) -> list[tuple[int, int, int]]:
        """Smallest document and range of each run of windows of a segment."""
        runs = self.seen.get(text)
        if runs is None:
            if len(self.seen) >= WINDOWS:
                self.seen.clear()
            h, runs = xxhash.xxh3_128_digest, []
            for k in range(len(text) - width + 1):
                least = self.least.get(h(text[k:k + width]))
                if least is None:
                    continue
                if runs and runs[-1][2] == k and runs[-1][0] == least:
                    runs[-1] = (least, runs[-1][1], k + 1)
                else:
                    runs.append((least, k, k + 1))
            self.seen[text] = runs
        return runs

    def _of_segments(self, c: Chunk, ids: np.ndarray, width: int, buckets: int
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hit = np.flatnonzero(_member(self.keys, _keys(c.hash, buckets)))
        none = np.zeros(0, np.int64)
        if not len(hit):
            return none, none, none
        a, n = c.start[hit], c.count[hit]
        data, h = c.data, xxhash.xxh3_64_intdigest
        digest = np.array([h(data[x:y]) for x, y in zip(a.tolist(), (a + n + width - 1).tolist())],
                          np.uint64)
        place = np.minimum(np.searchsorted(self.digest, digest), max(len(self.digest) - 1, 0))
        ok = self.digest[place] == digest
        hit, a, n, seg = hit[ok], a[ok], n[ok], self.order[place[ok]]
        runs = self.count[seg]
        row = np.repeat(np.arange(len(seg)), runs)
        run = self.first[seg][row] + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        begin = self.begin[run]
        last = np.ones(len(run), bool)
        last[:-1] = row[1:] != row[:-1]
        end = np.where(last, n[row], np.append(begin[1:], 0))
        part = c.part[hit][row]
        gone = self.doc[run] < ids[c.docs[part]]
        at = a[row] + c.shift[part]
        return (c.docs[part][gone], (at + begin)[gone], (at + end + width - 1)[gone])


def merge_spans(doc: np.ndarray, begin: np.ndarray, end: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of byte ranges per document, as maximal runs in order."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    reach = int(end.max()) + 1  # documents apart, one running maximum for all
    far = np.maximum.accumulate(doc * reach + end)
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] * reach + begin[1:] > far[:-1]
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(doc)) - 1
    return doc[start], begin[start], far[stop] - doc[start] * reach


def _cut(width: int, buckets: int):
    """Step 5: the documents of a group without the repeated bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if not group.texts:
                continue
            found = _Found(group.sent, buckets)
            some, texts = _known(group)
            ids = np.array([group.ids[k] for k in some], np.int64)
            marks = ([found.covered(c, ids, width, buckets) for c in chunks(texts, width)]
                     if len(found.keys) or len(found.split) else [])
            spans: dict[int, list] = {}
            if marks:
                doc, begin, end = merge_spans(*(np.concatenate(m) for m in zip(*marks)))
                for d, a, b in zip(doc.tolist(), begin.tolist(), end.tolist()):
                    spans.setdefault(some[d], []).append((a, b - a))
            kept, cuts = [], []
            for k, text in enumerate(group.texts):
                at, parts = 0, []
                for a, n in spans.get(k, ()):
                    parts.append(text[at:a])
                    at = a + n
                kept.append(b"".join([*parts, text[at:]]) if at else text)
                cuts.append([{"start": a, "length": n} for a, n in spans.get(k, ())])
            cols = [pa.array(group.ids, pa.int64()),
                    pa.array([len(t) for t in group.texts], pa.int64()),
                    pa.array(kept, pa.binary()),
                    pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()),
                                                       ("length", pa.int64())])))]
            names = ["id", "n_bytes", "kept", "spans"]
            if group.rest:
                cols.append(pa.concat_arrays(group.rest))
                names.append("rest")
            # Bounded output batches: a group is small unless one text is not.
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 50) -> DataFrame:
    """Every row without the repeated bytes: ``id_col, n_bytes, kept`` (bytes),
    ``spans`` (removed maximal runs, ``start, length`` in bytes of the input) and
    all other input columns as the struct ``rest``.

    One row per input row. A null text counts as empty. Rows with a null id stay
    whole and take no part. Rows that repeat an id do not remove each other's
    text. Texts shorter than ``width`` stay whole. Columns named like the
    results do not clash, being inside ``rest``. An empty table gives no rows.
    ``docs`` is read four times; where it is costly to compute, store it first.
    """
    if width < 2 * GRAM:
        raise ValueError(f"width: {2 * GRAM} or more")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    buckets = max(1, -(-total // BUCKET_BYTES))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    # Equal texts are spread over groups by their ids.
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.octet_length(text_col)), F.lit(groups)).cast("int").alias("g"),
        F.lit(1).alias("kind"), F.col(id_col).cast("bigint").alias("num"), body.alias("body"),
        F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(True).alias("none")]).alias("rest"))
    lean = rows.drop("rest")

    def together(texts: DataFrame, sent: DataFrame | None) -> DataFrame:
        if sent is not None:
            told = sent.select("g", F.lit(0).alias("kind"), F.col("bucket").cast("bigint").alias("num"),
                               "body")
            if "rest" in texts.columns:
                told = told.withColumn("rest", F.lit(None).cast(texts.schema["rest"].dataType))
            texts = texts.unionByName(told)
        return texts.repartition(tasks, "g").sortWithinPartitions("g", "kind")

    def dealt(found: DataFrame) -> DataFrame:
        return found.repartition(tasks, "bucket").sortWithinPartitions("bucket")

    hashes = together(lean, None).mapInArrow(_find_hashes(width, buckets), ROWS)
    shared = store(dealt(hashes).mapInArrow(_shared_hashes(buckets, SORT_BYTES), ROWS), "suffix-hashes")
    segments = together(lean, shared).mapInArrow(_segments(width, buckets), ROWS)
    found = store(dealt(segments).mapInArrow(_sort_shards(width, buckets, SORT_BYTES), ROWS), "suffix-found")
    discard(shared)
    kind = rows.schema["rest"].dataType.simpleString()
    return together(rows, found).mapInArrow(
        _cut(width, buckets),
        f"id bigint, n_bytes bigint, kept binary, spans array<struct<start:bigint,length:bigint>>, "
        f"rest {kind}").withColumnRenamed("id", id_col)
