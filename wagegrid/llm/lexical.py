"""Ranked lexical search by pipelined term partitioning.

The index is cut twice. Documents fall into *shards* of at most ``SHARD_DOCS``
documents or ``SHARD_BYTES`` of text; terms belong to *owners* by their hash. A
row of the index is one owner's inverted lists over one shard, so no list of a
frequent term is ever whole in one place.

Items (queries) fall into blocks of ``BLOCK`` items. The bundle of a block and a
shard carries the block's weighted terms and a sparse accumulator of integer
scores per (item, document). It goes through the owners one after the other: at
each stage bundles and that owner's lists meet in a cogroup on (shard, block),
the owner adds its terms' contributions, and the bundle moves on without these
terms. After the last owner each bundle gives its best documents of every item,
which a window ranks.

The hand-over from one stage to the next is a table in the shared folder, so a
lost executor costs a re-read and one task, and the one before is deleted.
Nothing is capped: accumulators hold every document with a score.

Only terms that may occur in an item are indexed. That is told by a bitmap of
``BITS`` hash positions, whose size does not depend on the items or documents; a
term that passes by chance is in the index and meets no item.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import discard, store
from .tokens import slices

OWNERS = 4            # stages that a bundle passes
BLOCK = 256           # items of a bundle
SHARD_DOCS = 2048     # documents of a shard
SHARD_BYTES = 32 << 20
BITS = 1 << 24        # positions of the term bitmap (2 MB)
BUCKET = 32768        # positions of one row of Spark's bitmap functions
LONG = 64             # bytes from which a term is told by its SHA-256
PART = 1 << 20        # bytes of a text worked on at a time
MEMO = 200_000        # terms whose bitmap lookup a task remembers
BROADCAST = 64 << 20  # bytes of block terms that may be broadcast
SEED = 42

# ASCII letters and digits, and every byte of a character beyond ASCII.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def term_counts(text: bytes) -> Counter:
    """Occurrences of every term of UTF-8 text; only A-Z is lower-cased."""
    counts: Counter = Counter()
    begin = 0
    while begin < len(text):
        cut = _BREAK.search(text, begin + PART)  # no term crosses the cut
        end = cut.start() if cut else len(text)
        counts.update(_TERM.findall(text[begin:end].lower()))
        begin = end
    return counts


def _name(term: bytes) -> bytes:
    """What stands for a term in tables: itself, or its digest where it is long
    (no term starts with a zero byte)."""
    return term if len(term) <= LONG else b"\0" + hashlib.sha256(term).digest()


def _hash(name: bytes) -> int:
    return xxhash.xxh64_intdigest(name, SEED)


def _place(h: int) -> int:
    return h % BITS


def _item_terms(items: DataFrame) -> DataFrame:
    """``item, name, owner, place, times`` of every item's terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                out: list[tuple] = []
                for item, text in zip(batch.column("item").to_pylist(),
                                      batch.column("text").cast(pa.binary()).to_pylist()):
                    for term, times in term_counts(text or b"").items():
                        h = _hash(name := _name(term))
                        out.append((item, name, (h >> 32) % OWNERS, _place(h) + 1, times))
                cols = zip(*out) if out else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (
                        pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64()))],
                    names=["item", "name", "owner", "place", "times"])

    return items.select("item", "text").mapInArrow(
        run, "item bigint, name binary, owner int, place bigint, times bigint")


def _bitmap(terms: DataFrame) -> bytes:
    """The positions of all item terms as bits; ``BITS`` / 8 bytes at most."""
    rows = (terms.groupBy(F.bitmap_bucket_number("place").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect())
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        at = (r.bucket - 1) * (BUCKET // 8)
        out[at:at + BUCKET // 8] = np.frombuffer(r.bits, np.uint8)
    return out.tobytes()


INDEX = ("shard bigint, owner int, names array<binary>, dfs array<bigint>, docs binary, tfs binary, "
         "doc_ids array<bigint>, lens array<bigint>")
_INDEX_TYPES = (pa.int64(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(),
                pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
DIRECTORY = -1  # the "owner" whose rows tell a shard's documents and their lengths


def _index(docs: DataFrame, bitmap: bytes) -> DataFrame:
    """A row per shard and owner with inverted lists, and one with the documents.

    A document's place in its shard is its number in the lists; documents
    without a term are left out. ``docs`` and ``tfs`` hold the lists of
    ``names`` one after the other, each as long as its entry of ``dfs``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        shard = TaskContext.get().partitionId() << 32
        known: dict[bytes, tuple[bytes, int] | None] = {}
        lists: list[dict] = [{} for _ in range(OWNERS)]
        ids: list[int | None] = []
        lens: list[int] = []
        held = 0

        def row(owner, lists, ids, lens):
            names = list(lists)
            joined = [b"".join(lists[n][k].tobytes() for n in names) for k in (0, 1)]
            cells = (shard, owner, names, [len(lists[n][0]) for n in names], *joined, ids, lens)
            return pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip(cells, _INDEX_TYPES)],
                names=[c.split()[0] for c in INDEX.split(", ")])

        def rows():
            yield row(DIRECTORY, {}, ids, lens)
            for owner in range(OWNERS):
                yield row(owner, lists[owner], [], [])

        for whole in batches:
            for batch in slices(whole):
                for doc_id, text in zip(batch.column("id").to_pylist(),
                                        batch.column("text").cast(pa.binary()).to_pylist()):
                    counts = term_counts(text or b"")
                    if not counts:
                        continue
                    at, held = len(ids), held + len(text)
                    ids.append(doc_id)
                    lens.append(counts.total())
                    for term, tf in counts.items():
                        if (found := known.get(term, 0)) == 0:
                            if len(known) >= MEMO:
                                known.clear()
                            h = _hash(name := _name(term))
                            p = _place(h)
                            found = (name, (h >> 32) % OWNERS) if bits[p >> 3] >> (p & 7) & 1 else None
                            known[term if len(term) <= LONG else name] = found
                        if found:
                            name, owner = found
                            if (pair := lists[owner].get(name)) is None:
                                pair = lists[owner][name] = (array("H"), array("Q"))
                            pair[0].append(at)
                            pair[1].append(tf)
                    if len(ids) >= SHARD_DOCS or held >= SHARD_BYTES:
                        yield from rows()
                        shard, held, ids, lens = shard + 1, 0, [], []
                        lists = [{} for _ in range(OWNERS)]
        if ids:
            yield from rows()

    return docs.select("id", "text").mapInArrow(run, INDEX)


BUNDLE = ("shard bigint, block bigint, doc_ids array<bigint>, norms array<bigint>, "
          "words array<struct<owner:int,name:binary,weight:bigint,item:int,times:bigint>>, "
          "slots binary, scores binary")
_BUNDLE_ARROW = pa.schema([
    ("shard", pa.int64()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("norms", pa.list_(pa.int64())),
    ("words", pa.list_(pa.struct([("owner", pa.int32()), ("name", pa.binary()), ("weight", pa.int64()),
                                  ("item", pa.int32()), ("times", pa.int64())]))),
    ("slots", pa.binary()), ("scores", pa.binary())])


def _scores(row: dict, n: int) -> np.ndarray:
    """The accumulator of a bundle as an array of items by documents."""
    acc = np.zeros(BLOCK * n, np.int64)
    acc[np.frombuffer(row["slots"], np.int32)] = np.frombuffer(row["scores"], np.int64)
    return acc.reshape(BLOCK, n)


def _stage(bundles: DataFrame, lists: DataFrame, owner: int) -> DataFrame:
    """Bundles after ``owner`` has added the contributions of its terms."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        found: dict[bytes, list[tuple[np.ndarray, np.ndarray]]] = {}
        for row in right.to_pylist():
            docs, tfs = np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["tfs"], np.uint64)
            ends = np.cumsum(row["dfs"])
            for name, end, df in zip(row["names"], ends.tolist(), row["dfs"]):
                found[name] = (docs[end - df:end], tfs[end - df:end].astype(np.int64))
        for row in left.to_pylist():
            norms = np.array(row["norms"], np.int64)
            acc = _scores(row, len(norms))
            parts: dict[bytes, np.ndarray] = {}
            for word in row["words"]:
                if word["owner"] != owner or (pair := found.get(word["name"])) is None:
                    continue
                if (part := parts.get(word["name"])) is None:
                    docs, tf = pair
                    part = parts[word["name"]] = word["weight"] * (
                        1_000_000_000 * tf // (1000 * tf + 12 * norms[docs]))
                acc[word["item"], pair[0]] += word["times"] * part
            slots = np.flatnonzero(acc)
            row["words"] = [w for w in row["words"] if w["owner"] != owner]
            row["slots"] = slots.astype(np.int32).tobytes()
            row["scores"] = acc.reshape(-1)[slots].tobytes()
            out.append(row)
        return pa.Table.from_pylist(out, _BUNDLE_ARROW)

    return (bundles.groupBy("shard", "block")
            .cogroup(lists.groupBy("at_shard", "at_block")).applyInArrow(run, BUNDLE))


def _best(bundles: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of each item of each bundle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                null = np.array([i is None for i in row["doc_ids"]])
                ids = np.array([i or 0 for i in row["doc_ids"]], np.int64)
                acc = _scores(row, len(ids))
                items, docs = [], []
                for item in np.flatnonzero(acc.any(axis=1)).tolist():
                    some = np.flatnonzero(acc[item] > 0)
                    if len(some) > k:  # all that reach the k-th highest score
                        least = np.partition(acc[item, some], len(some) - k)[len(some) - k]
                        some = some[acc[item, some] >= least]
                    order = np.lexsort((ids[some], null[some], -acc[item, some]))[:k]
                    docs.append(some[order])
                    items.append(np.full(len(order), item))
                if not items:
                    continue
                i, d = np.concatenate(items), np.concatenate(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["block"] * BLOCK + i), pa.array(ids[d], mask=null[d]),
                     pa.array(acc[i, d])], names=["item", "doc_id", "score"])

    return bundles.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def rank(docs: DataFrame, items: DataFrame, k: int = 20, doc_col: str = "doc_id",
         doc_text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` documents of highest score of every item: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII,
    A-Z lower-cased. With N documents that hold a term and L terms in them, a term
    held by df documents weighs ``w = floor(1000 ln((2N+2)/(2df+1)))``; a document
    of n terms has ``m = 75 + 25nN div L`` and scores the sum over the item's terms,
    repeats included, of ``w * (10^9 tf div (1000 tf + 12 m))``, in 64-bit integers.

    Rank 1 has the highest score; equal scores rank by ascending id, null ids
    last. Documents with score 0 are not returned. A null or empty text has no
    term: such an item has no row. Every input row is a document or an item of its
    own, so repeated rows rank (or are asked) once each; a null ``item_id`` stays
    null. Ids are long. Other columns are not read. With an empty table on either
    side there are no rows.
    """
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    some = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text).alias("text"))
    # Items are numbered within few partitions, so that blocks are full.
    parts = 1 + some.count() // (BLOCK * 64)
    asked = store(some.coalesce(parts).select(
        F.monotonically_increasing_id().alias("item"), "item_id", "text"), "lexical-items")
    terms = store(_item_terms(asked), "lexical-terms")
    index = store(_index(docs.select(F.col(doc_col).cast("bigint").alias("id"),
                                     F.col(doc_text).alias("text")), _bitmap(terms)),
                  "lexical-index", by=("owner",), wide=True)
    directory = index.where(F.col("owner") == DIRECTORY).select("shard", "doc_ids", "lens")
    n, total = directory.agg(
        F.sum(F.size("lens").cast("bigint")),
        F.sum(F.aggregate("lens", F.lit(0).cast("bigint"), lambda t, x: t + x))).first()
    if not n:
        return empty
    df = (index.where(F.col("owner") != DIRECTORY)
          .select(F.explode(F.arrays_zip("names", "dfs")).alias("x"))
          .groupBy(F.col("x.names").alias("name")).agg(F.sum("x.dfs").alias("df")))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2).cast("double") / (2 * F.col("df") + 1)))
    words = store(
        terms.join(df, "name").select(
            F.shiftright("item", 8).alias("block"),
            F.struct("owner", "name", weight.alias("weight"),
                     F.col("item").bitwiseAND(F.lit(BLOCK - 1)).cast("int").alias("item"),
                     "times").alias("word"))
        .groupBy("block").agg(F.sort_array(F.collect_list("word")).alias("words")), "lexical-words")
    # One number per block of items, and the size of what would be broadcast.
    blocks = [r.block for r in words.select("block").collect()]
    if not blocks:
        return empty
    size = words.agg(F.sum(F.aggregate(
        "words", F.lit(0).cast("bigint"), lambda t, w: t + F.octet_length(w["name"]) + 32))).first()[0]
    every = F.explode(F.array(*[F.lit(b).cast("bigint") for b in blocks])).alias("block")
    # Beyond the bound there are hundreds of blocks, so the shuffle on them spreads.
    side = F.broadcast(words) if size <= BROADCAST else words
    norm = F.expr(f"transform(lens, x -> 75L + (25L * x * {n}L) div {total}L)")
    bundles = (directory.select("shard", "doc_ids", norm.alias("norms"), every)
               .join(side, "block")
               .select("shard", "block", "doc_ids", "norms", "words",
                       F.lit(b"").alias("slots"), F.lit(b"").alias("scores")))
    before = None
    for owner in range(OWNERS):
        lists = index.where(F.col("owner") == owner).select(
            F.col("shard").alias("at_shard"), every.alias("at_block"), "names", "dfs", "docs", "tfs")
        bundles = _stage(bundles, lists, owner)
        if owner < OWNERS - 1:
            bundles = store(bundles, f"lexical-stage{owner}", wide=True)
            if before:
                discard(before)
            before = bundles
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = (_best(bundles, k).select("*", F.row_number().over(by_score).alias("rank"))
              .where(F.col("rank") <= k))
    return ranked.join(asked.select("item", "item_id"), "item").select(
        "item_id", "rank", "doc_id", "score")
