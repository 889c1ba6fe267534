"""Running sums over a sorted table, and ranks of a linked list.

Both work on tables of any size: sorting is by range, a task holds a bounded
number of rows, and what tasks hand to each other is one row a task. A segment
(or a list) that holds most of the rows spreads over as many tasks as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import discard, store

TASK_ROWS = 200_000  # rows of a task of a scan
LINKS = 65_536       # list elements that a task contracts
LAST = 16_384        # list elements that are ranked in one task


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _parts(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def scan(rows: DataFrame, segment: Sequence[str], order: Sequence[str], sums: Sequence[str],
         following: str | None = None, name: str = "scan") -> DataFrame:
    """``rows`` with running sums within each segment, in ``order`` (nulls first).

    ``segment`` and ``sums`` name long columns without nulls. Every column x of
    ``sums`` gives ``x_sum`` (this row included) and ``x_before`` (without it), both
    modulo 2^64. ``following`` gives the column ``next``: its value in the segment's
    next row, null in the last. Rows alike in ``order`` come in any order. An empty
    table gives an empty result.

    A task sums its own range; its last sums go on to the first segment of the
    next task (two rows a task are taken to the driver for that).
    """
    kept = store(rows, f"{name}-rows")
    schema = T.StructType(list(kept.schema.fields))
    for c in sums:
        schema.add(f"{c}_sum", T.LongType()).add(f"{c}_before", T.LongType())
    if following:
        schema.add("next", kept.schema[following].dataType)
    flags = T.StructType(list(schema.fields)).add("task", T.IntegerType()) \
        .add("opening", T.BooleanType()).add("first", T.BooleanType()).add("last", T.BooleanType())

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        totals = {c: np.zeros(1, np.int64) for c in sums}
        at: tuple | None = None  # the segment of the row before
        opening = True           # whether that is the task's first one
        held = None              # a batch whose last row has yet to learn its next

        def done(batch, starts, open_, extra, more):
            n = batch.num_rows
            columns = list(batch.columns) + extra
            if following:
                value = batch.column(following)
                nexts = pa.concat_arrays([value.slice(1), more if more is not None
                                          else pa.nulls(1, value.type)])
                ends = np.append(starts[1:], more is None)
                columns.append(pa.array(
                    [None if e else v for e, v in zip(ends.tolist(), nexts.to_pylist())], value.type))
            last = np.zeros(n, bool)
            last[-1] = final
            first = np.zeros(n, bool)
            first[0] = initial
            columns += [pa.array(np.full(n, task, np.int32)), pa.array(open_), pa.array(first),
                        pa.array(last)]
            return pa.RecordBatch.from_arrays(columns, names=flags.names)

        initial, final = True, False
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            starts = np.zeros(n, bool)
            now = tuple(int(_longs(batch.slice(0, 1), c)[0]) for c in segment)
            starts[0] = at is not None and now != at
            for c in segment:
                x = _longs(batch, c)
                starts[1:] |= x[1:] != x[:-1]
            if held:
                yield done(*held, None if starts[0] else batch.column(following).slice(0, 1)
                           if following else None)
                initial = False
            number = np.cumsum(starts)
            open_ = (number == 0) & opening
            extra = []
            for c in sums:
                x = _longs(batch, c)
                total = np.cumsum(x)
                # What stands before each segment's first row in this batch.
                cut = np.concatenate([-totals[c], (total - x)[starts]])
                total = total - cut[number]
                totals[c] = total[-1:]
                extra += [pa.array(total), pa.array(total - x)]
            opening = bool(open_[-1])
            at = tuple(int(_longs(batch.slice(n - 1, 1), c)[0]) for c in segment)
            held = (batch, starts, open_, extra)
        if held:
            final = True
            yield done(*held, None)

    keys = [F.col(c) for c in (*segment, *order)] + [F.col("__tie")]
    # Equal rows are told apart, so that a range can end among them.
    dealt = (kept.withColumn("__tie", F.monotonically_increasing_id())
             .repartitionByRange(_parts(kept.count(), TASK_ROWS), *keys)
             .sortWithinPartitions(*keys).drop("__tie"))
    parts = store(dealt.mapInArrow(local, flags), name)
    discard(kept)
    ends: dict[int, dict] = {}
    for r in parts.where("first OR last").collect():
        task = ends.setdefault(r.task, {})
        if r["first"]:
            task["first"] = r
        if r["last"]:
            task["last"] = r
    carry: dict[int, list[int]] = {}   # sums that come to a task from the ones before
    nexts: dict[int, object] = {}      # the value that follows a task's last row
    before = None
    for task in sorted(ends):
        one = ends[task]
        carry[task] = [0] * len(sums)
        if before is not None:
            row = ends[before]["last"]
            if all(row[c] == one["first"][c] for c in segment):
                carry[task] = [row[f"{c}_sum"] + (carry[before][k] if row.opening else 0)
                               for k, c in enumerate(sums)]
                if following:
                    nexts[before] = one["first"][following]
        before = task

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tasks = batch.column("task").to_numpy(zero_copy_only=False)
            here, which = np.unique(tasks, return_inverse=True)
            opening = batch.column("opening").to_numpy(zero_copy_only=False)
            columns = []
            for field in schema.names:
                column = batch.column(field)
                for k, c in enumerate(sums):
                    if field in (f"{c}_sum", f"{c}_before"):
                        more = np.array([carry[t][k] % (1 << 64) for t in here.tolist()],
                                        np.uint64).view(np.int64)
                        column = pa.array(_longs(batch, field) + np.where(opening, more[which], 0))
                if following and field == "next" and nexts:
                    values = column.to_pylist()
                    for i in np.flatnonzero(batch.column("last").to_numpy(zero_copy_only=False)):
                        values[i] = nexts.get(int(tasks[i]))
                    column = pa.array(values, column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return parts.mapInArrow(joined, schema)


def _chains(a, b, na, nb, there, size):
    """For elements ``(a, b)`` with successors ``(na, nb)`` where ``there``: the head
    of each one's chain among them, its distance from the head, and for heads the
    chain's last element and size (else -1 and 0)."""
    n = len(a)
    names = np.unique(a)
    own = np.searchsorted(names, a) << 34 | b
    code = np.minimum(np.searchsorted(names, na), len(names) - 1)
    wanted = np.where(there & (names[code] == na), code << 34 | nb, -1)
    order = np.argsort(own, kind="stable")
    at = np.minimum(np.searchsorted(own, wanted, sorter=order), n - 1)
    linked = np.flatnonzero(own[order[at]] == wanted)
    up = np.arange(n)
    up[order[at[linked]]] = linked
    far = np.where(up != np.arange(n), size[up], 0)
    while True:
        higher = up[up]
        if (higher == up).all():
            break
        far, up = far + far[up], higher
    tail, total = np.full(n, -1), np.zeros(n, np.int64)
    ends = np.ones(n, bool)
    ends[linked] = False
    ends = np.flatnonzero(ends)
    tail[up[ends]] = ends
    total[up[ends]] = far[ends] + size[ends]
    return up, far, tail, total


def _contract(links: DataFrame) -> DataFrame:
    """Each task's chains: every element with its head ``(ha, hb)`` and distance
    ``far``; heads also with the chain's next element and ``size`` (else 0)."""
    schema = T.StructType(list(links.schema.fields))
    for c in ("ha", "hb", "far"):
        schema.add(c, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        there = batch.column("na").is_valid().to_numpy(zero_copy_only=False)
        a, b, size = (_longs(batch, c) for c in ("a", "b", "size"))
        na, nb = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
        head, far, tail, total = _chains(a, b, na, nb, there, size)
        new = {"na": pa.array(na[tail], mask=~(there[tail] & (tail >= 0))),
               "nb": pa.array(nb[tail], mask=~(there[tail] & (tail >= 0))),
               "size": pa.array(total)}
        columns = [new.get(c, batch.column(c)) for c in batch.schema.names]
        columns += [pa.array(a[head]), pa.array(b[head]), pa.array(far)]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return links.mapInArrow(run, schema)


def _splice(links: DataFrame, turn: int) -> DataFrame:
    """Every element of one coin side takes in its successor of the other side.

    About a quarter of the elements go, whatever the order of the list; what
    meets in the join is one element and its only predecessor.
    """
    coin = F.pmod(F.xxhash64("a", "b", F.lit(turn)), F.lit(2))
    i = links.where(coin == 1).select(
        *[F.col(c).alias(f"i_{c}") for c in ("a", "b", "na", "nb", "size")],
        F.coalesce("na", "a").alias("ka"), F.coalesce("nb", "b").alias("kb"))
    j = links.where(coin == 0).select(*[F.col(c).alias(f"j_{c}") for c in ("a", "b", "na", "nb", "size")])
    both = i.join(j, (F.col("ka") == F.col("j_a")) & (F.col("kb") == F.col("j_b")), "full_outer")

    def row(a, b, na, nb, size, ha, hb, far):
        cells = zip(("a", "b", "na", "nb", "size", "ha", "hb", "far"), (a, b, na, nb, size, ha, hb, far))
        return F.struct(*[F.expr(x).cast("bigint").alias(c) for c, x in cells])

    found = F.when(F.col("i_a").isNull(), F.array(
        row("j_a", "j_b", "j_na", "j_nb", "j_size", "j_a", "j_b", "0"))).when(
        F.col("j_a").isNull(), F.array(
            row("i_a", "i_b", "i_na", "i_nb", "i_size", "i_a", "i_b", "0"))).otherwise(F.array(
                row("i_a", "i_b", "j_na", "j_nb", "i_size + j_size", "i_a", "i_b", "0"),
                row("j_a", "j_b", "null", "null", "0", "i_a", "i_b", "i_size")))
    return both.select(F.inline(found))


def list_ranks(links: DataFrame, name: str = "ranks") -> DataFrame:
    """``links`` without its ``na`` and ``nb``, and each element's ``rank`` from 0.

    ``links`` is one linked list: elements ``(a, b)`` (unique, long; b from 0 to
    2^34) with their successor ``(na, nb)``, null for the last. Other columns go along.

    Tasks contract the chains that lie in their range of (a, b). While that does
    not halve the list, a round of random splicing takes out about a quarter, so the
    work is linear for any order. What is left goes on with fewer tasks and, from
    ``LAST`` elements, to one. Then the ranks go back down the same levels.
    """
    others = [c for c in links.columns if c not in ("a", "b", "na", "nb")]
    now = store(links.withColumn("size", F.lit(1).cast("bigint")), name)
    levels: list[DataFrame] = []
    turn = 0
    while (n := now.count()) > LAST:
        level = store(_contract(now.repartitionByRange(_parts(n, LINKS), "a", "b")), name)
        if not levels:
            discard(now)
        levels.append(level)
        now = level.where("size > 0").select("a", "b", "na", "nb", "size")
        if now.count() > max(n // 2, LAST):
            turn += 1
            levels.append(store(_splice(now, turn), name))
            now = levels[-1].where("size > 0").select("a", "b", "na", "nb", "size")
    top = _contract(now.coalesce(1)).withColumnRenamed("far", "rank")
    if not levels:
        return top.select("a", "b", *others, "rank")
    ranks = top.select("a", "b", "rank")
    for k, level in reversed(list(enumerate(levels))):
        heads = ranks.select(F.col("a").alias("ha"), F.col("b").alias("hb"), F.col("rank").alias("base"))
        ranks = level.join(heads, ["ha", "hb"]).select(
            "a", "b", *(others if k == 0 else []), (F.col("base") + F.col("far")).alias("rank"))
        if k:
            ranks = store(ranks, name)
    return ranks
