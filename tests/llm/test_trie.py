"""Scans, list ranking and the prefix trie against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from wagegrid.llm import scans
from wagegrid.llm.queries_conversations import rebuilt
from wagegrid.llm.shared import store
from wagegrid.llm.trie import prefix_trie, turn_numbers


@pytest.mark.parametrize("rows,task", [(0, 5), (1, 5), (400, 20)])
def test_scan(llm, monkeypatch, rows, task):
    monkeypatch.setattr(scans, "TASK_ROWS", task)
    rng = random.Random(rows + task)
    # Segment 5 holds most of the rows.
    data = [(rng.choice([1, 2, 5, 5, 5, 5, 9]), i if rng.random() > .1 else None,
             rng.randrange(-2**62, 2**62)) for i in range(rows)]
    found = scans.scan(llm.createDataFrame(data, "g bigint, at bigint, v bigint"), ["g"], ["at", "v"],
                       ["v"], "v").collect()
    want, wrap = [], lambda x: (x + 2**63) % 2**64 - 2**63
    for g in {r[0] for r in data}:
        total = 0
        part = sorted((r for r in data if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for k, r in enumerate(part):
            want.append((*r, wrap(total + r[2]), wrap(total), part[k + 1][2] if k + 1 < len(part) else None))
            total += r[2]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


@pytest.mark.parametrize("size,links,last,order", [
    (1, 10, 10, "sorted"), (300, 40, 5, "shuffled"), (300, 1000, 5, "sorted"), (300, 20, 1000, "shuffled")])
def test_list_ranks(llm, monkeypatch, size, links, last, order):
    monkeypatch.setattr(scans, "LINKS", links)
    monkeypatch.setattr(scans, "LAST", last)
    elements = [(i - 50, i % 3) for i in range(size)]
    if order == "shuffled":
        random.Random(size).shuffle(elements)
    rows = [(*e, *(elements[k + 1] if k + 1 < size else (None, None)), k * 10)
            for k, e in enumerate(elements)]
    found = scans.list_ranks(llm.createDataFrame(rows, "a bigint, b bigint, na bigint, nb bigint, x bigint"))
    assert found.columns == ["a", "b", "x", "rank"]
    assert sorted((r.rank, r.a, r.b, r.x) for r in found.collect()) == [
        (k, *e, k * 10) for k, e in enumerate(elements)]


def plain_trie(rows):
    """Nodes by the definition; rows are (conv_id, turn, role, text)."""
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    convs: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", digest(text or ""),
                                            text or ""))
    own = {c: [(r, t) for *_, r, _, t in sorted(turns)] for c, turns in convs.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        made[c] = own.get(base, [])[:h] + own[c][h:]
    members: dict[tuple, list[int]] = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids: dict[tuple, int] = {}
    for path in members:
        if path:
            kids[path[:-1]] = kids.get(path[:-1], 0) + 1
    out = []
    for path, held in members.items():
        below = [p for p in members if p[:len(path)] == path]
        words = [(len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p]
        ends = ",".join(str(c) for c in sorted(held) if len(made[c]) == len(path))
        out.append((min(held), len(path), min(members[path[:-1]]) if path else None, len(held),
                    kids.get(path, 0), sum(p not in kids for p in below), sum(words), digest(ends)))
    return sorted(map(str, out))


def trie(spark, rows):
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr(
        "*", "1 AS depth", "2 AS number", "3 AS f1", "'x' AS next")
    return sorted(str(tuple(r)) for r in prefix_trie(
        *rebuilt(store(turn_numbers(table), "numbered"))).collect())


def odd_conversations():
    rows = []
    for c in (0, 1, 2, 3, 20, 21, 22, 45, 46, -3, -20, -21, 20000, 20001, 24100):
        for turn in range(c % 6):
            rows.append((c, turn if turn else None, ("user", "assistant", None)[turn % 3],
                         ("Hello  there\tfriend", None, "", "same words here " * 3, "a\x0bb")[turn % 5]))
    rows += [(None, 1, "user", "lost"), (3, 1, "user", "again"), (3, 1, "user", "again"),
             (7, 0, "user", "x" * 50_000), (7, 1, None, None)]
    return rows


@pytest.mark.parametrize("task,links,last", [(200_000, 65_536, 16_384), (9, 16, 8)])
def test_trie_equals_brute_force(llm, monkeypatch, task, links, last):
    for name, value in (("TASK_ROWS", task), ("LINKS", links), ("LAST", last)):
        monkeypatch.setattr(scans, name, value)
    rows = odd_conversations()
    assert trie(llm, rows) == plain_trie(rows)


def test_a_long_conversation_and_many_copies(llm, monkeypatch):
    monkeypatch.setattr(scans, "TASK_ROWS", 50)
    monkeypatch.setattr("wagegrid.llm.queries_conversations.SLICE", 16)
    rows = [(40, t, "user", f"turn {t % 7}") for t in range(150)]
    rows += [(c, t, "user", "hello all") for c in range(10_000, 10_100) for t in range(2)]
    assert trie(llm, rows) == plain_trie(rows)


def test_no_conversation(llm):
    assert trie(llm, []) == []
    assert trie(llm, [(None, 1, "user", "a")]) == []


def test_a_conversation_without_turns_is_in_the_root(llm):
    # 38: crc32 % 4 exceeds its turns and conversation 20 is absent.
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone")]
    assert trie(llm, rows) == plain_trie(rows) != []
