"""Proximity graphs over unit vectors in flat neighbour arrays (numpy, per shard).

A graph is an ``int32`` array (points, degree) of neighbour positions, padded
with -1. Many queries are searched in lockstep, so the work is done in arrays.
Distances are ``1 - cosine`` of float32 unit vectors; callers verify what they
report on the original vectors in double precision.
"""

from __future__ import annotations

import numpy as np

EXPAND = 4  # points expanded for each query at a time
QUERIES = 512  # queries searched in lockstep


def unit(vectors: np.ndarray) -> np.ndarray:
    """Float32 rows of length 1."""
    wide = vectors.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _distances(x: np.ndarray, rows: np.ndarray, q: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return 1.0 - np.einsum("ij,ij->i", x[rows], q[owner])


def beam_search(x: np.ndarray, graph: np.ndarray, entry: np.ndarray, q: np.ndarray, width: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``width`` nearest points found for every query, nearest first.

    ``entry``: (queries, k) start positions, -1 for none. Returns positions
    (-1: none), distances and the points seen, as a bitmap (queries, points).
    """
    n, b = len(x), len(q)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # stands for -1
    beam = np.full((b, width), -1, np.int64)
    dist = np.full((b, width), np.inf, np.float32)
    todo = np.zeros((b, width), bool)
    active = np.arange(b)

    def merge(who: np.ndarray, found: np.ndarray) -> None:
        """Add the unseen ones of ``found`` (len(who), k) to the beams."""
        found = np.where(found < 0, n, found)
        new = ~seen[who[:, None], found]
        if found.shape[1] > 1:  # a point that two expanded points share counts once
            order = np.argsort(found, axis=1, kind="stable")
            ranked = np.take_along_axis(found, order, 1)
            again = np.zeros_like(new)
            np.put_along_axis(again, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
            new &= ~again
        row, col = np.nonzero(new)
        points = found[row, col]
        seen[who[row], points] = True
        d = np.full(found.shape, np.inf, np.float32)
        d[row, col] = _distances(x, points, q, who[row])
        every = np.concatenate([dist[who], d], axis=1)
        keep = np.argpartition(every, width - 1, axis=1)[:, :width]
        dist[who] = np.take_along_axis(every, keep, 1)
        beam[who] = np.take_along_axis(np.concatenate([beam[who], found], axis=1), keep, 1)
        todo[who] = np.take_along_axis(
            np.concatenate([todo[who], new], axis=1), keep, 1)

    merge(active, entry)
    while len(active):
        open_dist = np.where(todo[active], dist[active], np.inf)
        k = min(EXPAND, width)
        pick = np.argpartition(open_dist, k - 1, axis=1)[:, :k]
        chosen = np.take_along_axis(open_dist, pick, 1) < np.inf
        some = chosen.any(axis=1)
        active, pick, chosen = active[some], pick[some], chosen[some]
        if not len(active):
            break
        points = np.take_along_axis(beam[active], pick, 1)
        rest = todo[active]
        np.put_along_axis(rest, pick, False, 1)
        todo[active] = rest
        near = graph[np.where(chosen, points, 0)]
        near[~chosen] = -1
        merge(active, near.reshape(len(active), -1))
    order = np.argsort(dist, axis=1, kind="stable")
    dist = np.take_along_axis(dist, order, 1)
    return (np.where(dist < np.inf, np.take_along_axis(beam, order, 1), -1), dist, seen[:, :n])


def prune(x: np.ndarray, nodes: np.ndarray, cand: np.ndarray, degree: int, alpha: float
          ) -> np.ndarray:
    """Robust pruning: up to ``degree`` neighbours of each node out of ``cand``.

    The nearest candidate left is taken; others that are ``alpha`` times nearer
    to it than to the node are dropped. Room left over is filled with the
    nearest dropped ones. ``cand``: (nodes, c) positions, -1 for none.
    """
    out = np.full((len(nodes), degree), -1, np.int32)
    step = max(1, (1 << 22) // max(1, cand.shape[1] * x.shape[1]))
    for at in range(0, len(nodes), step):
        me, c = nodes[at:at + step], cand[at:at + step]
        order = np.argsort(c, axis=1, kind="stable")
        ranked = np.take_along_axis(c, order, 1)
        bad = (ranked < 0) | (ranked == me[:, None])
        bad[:, 1:] |= ranked[:, 1:] == ranked[:, :-1]
        points = np.where(bad, 0, ranked)
        vec = x[points]
        far = 1.0 - np.einsum("bcd,bd->bc", vec, x[me])
        far = np.where(bad, np.inf, far)
        free = far.copy()
        row = np.arange(len(me))
        filled = np.zeros(len(me), np.int64)
        for _ in range(degree):
            best = free.argmin(axis=1)
            ok = free[row, best] < np.inf
            if not ok.any():
                break
            r = row[ok]
            out[at + r, filled[r]] = points[r, best[r]]
            filled[r] += 1
            between = 1.0 - np.einsum("bcd,bd->bc", vec[r], vec[r, best[r]])
            free[r] = np.where(alpha * between <= far[r], np.inf, free[r])
            free[r, best[r]] = np.inf
            far[r, best[r]] = np.inf
        spare = np.argsort(far, axis=1, kind="stable")[:, :degree]
        gap = np.take_along_axis(far, spare, 1)
        for k in range(spare.shape[1]):
            put = (filled < degree) & (gap[:, k] < np.inf)
            out[at + row[put], filled[put]] = points[row[put], spare[put, k]]
            filled[put] += 1
    return out


def build(x: np.ndarray, order: np.ndarray, entry: np.ndarray | None, degree: int, width: int,
          alpha: float) -> np.ndarray:
    """Graph over all points, inserted in ``order`` in growing batches.

    Each batch is searched in the graph so far (from ``entry``, a position per
    point inserted before it, or from the first point) and compared with itself;
    neighbours are pruned robustly, links go both ways, and full lists are
    pruned again.
    """
    graph = np.full((len(x), degree), -1, np.int32)
    done = 0
    while done < len(order):
        batch = order[done:done + (64 if not done else min(1024, max(64, done // 2)))]
        inner = x[batch] @ x[batch].T
        np.fill_diagonal(inner, -np.inf)
        k = min(width, len(batch) - 1)
        cand = (batch[np.argpartition(-inner, k - 1, axis=1)[:, :k]] if k > 0
                else np.full((len(batch), 1), -1))
        if done:
            start = (np.full((len(batch), 1), order[0]) if entry is None
                     else entry[batch][:, None])
            found = [beam_search(x, graph, start[a:a + QUERIES], x[batch[a:a + QUERIES]], width)[0]
                     for a in range(0, len(batch), QUERIES)]
            cand = np.concatenate([cand, np.concatenate(found)], axis=1)
        graph[batch] = prune(x, batch, cand, degree, alpha)
        _link_back(x, graph, batch, degree, alpha)
        done += len(batch)
    return graph


def _link_back(x, graph, batch, degree, alpha) -> None:
    """Add the links of ``batch`` in the other direction."""
    source = np.repeat(batch, graph.shape[1])
    target = graph[batch].ravel()
    source, target = source[target >= 0], target[target >= 0].astype(np.int64)
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    for lo in range(0, len(nodes), 4096):
        part, f, c = nodes[lo:lo + 4096], first[lo:lo + 4096], count[lo:lo + 4096]
        extra = np.full((len(part), int(c.max())), -1, np.int64)
        place = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        extra[np.repeat(np.arange(len(part)), c), place] = source[np.repeat(f, c) + place]
        graph[part] = prune(x, part, np.concatenate([graph[part], extra], axis=1), degree, alpha)
