"""Suffix arrays by induced sorting, in array operations, for shard-sized texts.

``suffix_array`` classifies suffixes (smaller or larger than the next one),
sorts the leftmost-smaller (LMS) substrings by one round of induction, names
them, orders the reduced string of names, and induces the whole array from it.
Induction goes bucket by bucket; what a bucket's entries induce is placed by one
stable counting step, and entries that fall into the same bucket form the next
step, so every suffix is touched once a pass.

The reduced string has up to a third as many names as the text has characters,
too many buckets for array steps; it is ordered by repeatedly pairing names
(each round takes the order of twice as many LMS substrings from the last).
``depth`` ends this early: suffixes equal in so many characters may come in any
order.
"""

from __future__ import annotations

import numpy as np


def smaller_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last one is."""
    n = len(text)
    less = np.ones(n, bool)
    less[:-1] = text[:-1] < text[1:]
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    at = np.where(differs, np.arange(n), n)
    return less[np.minimum.accumulate(at[::-1])[::-1]]


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, edges: np.ndarray,
            larger: np.ndarray) -> np.ndarray:
    """The array induced from the LMS positions in ``lms`` (in order)."""
    n = len(text)
    sa = np.full(n, -1, np.int64)
    sigma = len(edges) - 1
    chars = text[lms]
    count = np.bincount(chars, minlength=sigma)
    order = np.argsort(chars, kind="stable")
    within = np.arange(len(lms)) - np.repeat(np.cumsum(count) - count, count)
    sa[(edges[1:] - count)[chars[order]] + within] = lms[order]
    used = np.flatnonzero(np.diff(edges)).tolist()

    head = edges[:-1].copy()

    def to_heads(items: np.ndarray) -> None:
        pred = items[items > 0] - 1
        pred = pred[~small[pred]]
        if not len(pred):
            return
        c = text[pred]
        o = np.argsort(c, kind="stable")
        pred, c = pred[o], c[o]
        k = np.bincount(c, minlength=sigma)
        first = np.cumsum(k) - k
        sa[head[c] + np.arange(len(c)) - first[c]] = pred
        head[:] += k

    for b in used:
        low = edges[b]
        while low < head[b]:
            high = head[b]
            to_heads(sa[low:high])
            low = high
        if count[b]:
            to_heads(sa[edges[b + 1] - count[b]:edges[b + 1]])

    tail = edges[1:].copy()

    def to_tails(items: np.ndarray) -> None:
        pred = items[items > 0] - 1
        pred = pred[small[pred]]
        if not len(pred):
            return
        c = text[pred]
        o = np.argsort(c, kind="stable")
        pred, c = pred[o], c[o]
        k = np.bincount(c, minlength=sigma)
        first = np.cumsum(k) - k
        sa[tail[c] - 1 - np.arange(len(c)) + first[c]] = pred
        tail[:] -= k

    last = edges[1:] - 1
    for b in reversed(used):
        high = edges[b + 1]
        if text[n - 1] == b:  # the end marker is induced by nothing
            sa[last[b]] = n - 1
            tail[b] -= 1
        while tail[b] < high:
            low = tail[b]
            to_tails(sa[low:high][::-1])
            high = low
        to_tails(sa[edges[b]:edges[b] + larger[b]][::-1])
    return sa


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Number of each LMS substring (by place in ``lms``), equal ones alike."""
    length = np.ones(len(text) + 1, np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    open_ = np.flatnonzero(same)
    at = 0
    while len(open_):
        alike = text[a[open_] + at] == text[b[open_] + at]
        same[open_[~alike]] = False
        open_ = open_[alike]
        at += 1
        open_ = open_[length[a[open_]] > at]
    name = np.zeros(len(text), np.int64)
    name[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return name[lms]


def _order_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of the reduced string, by pairing names. Each name
    stands for two characters at least."""
    rank, step = names, 1
    while True:
        top = int(rank.max())
        if top == len(rank) - 1 or 2 * step > depth:
            return np.argsort(rank)
        key = (rank + 1) * (top + 2)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key)
        step *= 2
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty_like(rank)
        rank[order] = new
        if step >= len(rank):
            return np.argsort(rank)


def suffix_array(text: np.ndarray, depth: int = 1 << 62) -> np.ndarray:
    """Suffix array of small integers that end with a unique smallest one."""
    text = text.astype(np.uint16)
    if len(text) < 2:
        return np.arange(len(text))
    small = smaller_types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    edges = np.concatenate([[0], np.cumsum(np.bincount(text))])
    larger = np.bincount(text[~small], minlength=len(edges) - 1)
    first = _induce(text, small, lms, edges, larger)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]]
    names = _names(text, lms, ordered)
    return _induce(text, small, lms[_order_names(names, depth)], edges, larger)


def permuted_lcp(text: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """In text order: characters (``most`` at most) that each suffix of ``array``
    shares with the one before it there; -1 for the first and for others."""
    text = np.concatenate([text.astype(np.uint16), np.zeros(most + 4, np.uint16)])
    # Four characters in one word at every position.
    word = np.zeros(len(text) - 3, np.uint64)
    for k in range(4):
        word |= text[k:len(text) - 3 + k].astype(np.uint64) << np.uint64(16 * k)
    out = np.full(len(text), -1, np.int32)
    here, before = array[1:], array[:-1]
    length = np.zeros(len(here), np.int32)
    open_ = np.arange(len(here))
    for at in range(0, most, 4):
        x = word[here[open_] + at] ^ word[before[open_] + at]
        equal = x == 0
        part = x[~equal]
        low = np.zeros(len(part), np.int32)
        for k in (1, 2, 3):
            low += part & np.uint64((1 << 16 * k) - 1) == 0
        length[open_[~equal]] = at + low
        open_ = open_[equal]
        length[open_] = at + 4
    out[here] = np.minimum(length, most)
    return out
