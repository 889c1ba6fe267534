"""Latest-record selection, keep-last and the two incremental load rules."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from wagegrid.operators import dedupe, merge
from wagegrid.schemas import EMPLOYEES

D = dt.date


@pytest.fixture(scope="module")
def dup_employees(spark):
    rows = [
        (1, 1, Decimal("100.00"), D(2020, 1, 1), None),   # equal date, lower salary
        (1, 1, Decimal("200.00"), D(2020, 1, 1), None),
        (2, 1, Decimal("100.00"), None, None),            # NULL date vs a real one
        (2, 2, Decimal("300.00"), D(2020, 1, 1), None),
        (3, 1, None, D(2020, 1, 1), None),                 # NULL salary vs a real one
        (3, 2, Decimal("50.00"), D(2020, 1, 1), None),
        (4, 1, Decimal("10.00"), D(2020, 1, 1), None),     # full tie but branch
        (4, 2, Decimal("10.00"), D(2020, 1, 1), None),
    ]
    return spark.createDataFrame(rows, EMPLOYEES)


def test_latest_nulls_first(dup_employees):
    got = {r.employee_id: (r.branch_id, r.salary)
           for r in dedupe.latest_employee(dup_employees, nulls_first=True).collect()}
    assert got == {1: (1, Decimal("200.00")), 2: (1, Decimal("100.00")), 3: (1, None),
                   4: (2, Decimal("10.00"))}


def test_latest_nulls_last(dup_employees):
    got = {r.employee_id: (r.branch_id, r.salary)
           for r in dedupe.latest_employee(dup_employees, nulls_first=False).collect()}
    assert got == {1: (1, Decimal("200.00")), 2: (2, Decimal("300.00")),
                   3: (2, Decimal("50.00")), 4: (2, Decimal("10.00"))}


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, seq long")


def test_keep_last_one_row_per_key(spark):
    df = _batch(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "d", 1), (None, "e", 2)])
    got = sorted((r.k if r.k is not None else -1, r.v)
                 for r in dedupe.keep_last(df, "k", "seq").collect())
    assert got == [(-1, "e"), (1, "b"), (2, "c")]


def test_append_new_keys(spark):
    old = _batch(spark, [(1, "old1", 1), (2, "old2", 1), (None, "oldnull", 1)])
    new = _batch(spark, [(2, "new2", 1), (3, "new3a", 1), (3, "new3b", 2), (None, "newnull", 1)])
    rows = merge.append_new_keys(new, old, ["k"], "seq").collect()
    assert [(r.k, r.v) for r in rows] == [(3, "new3b")]   # NULL key already present
    counts = merge.load_counts(new, old, "k", "seq").collect()[0]
    assert (counts.new_keys, counts.matched_keys) == (1, 2)
    # appending the same batch again adds nothing
    stored = merge.union_all(old, merge.append_new_keys(new, old, "k", "seq"))
    assert merge.append_new_keys(new, stored, "k", "seq").count() == 0


def test_upsert_last_wins_and_is_idempotent(spark):
    old = _batch(spark, [(1, "old1", 1), (2, "old2", 1)])
    new = _batch(spark, [(2, "new2", 1), (3, "new3", 1)])
    once = merge.upsert(old, new, "k", "seq")
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "old1"), (2, "new2"), (3, "new3")]
    twice = merge.upsert(once, new, "k", "seq")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_key_validation(spark):
    old = _batch(spark, [(1, "a", 1)])
    new = spark.createDataFrame([(1, "b")], "other long, v string")
    with pytest.raises(KeyError):
        merge.append_new_keys(new, old, "k", "v")
    with pytest.raises(KeyError):
        merge.upsert(old, new, ["k"])
    assert dedupe.normalize_keys("k") == ["k"]
    assert dedupe.normalize_keys(("a", "b")) == ["a", "b"]
    with pytest.raises(ValueError):
        dedupe.normalize_keys([])


def test_union_and_distinct(spark):
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([(1, "x", 5)], "k long, v string, extra long")
    u = merge.union_all(a, b)
    assert u.columns == ["k", "v", "extra"] and u.count() == 2
    assert merge.distinct_rows(u.drop("extra")).count() == 1
