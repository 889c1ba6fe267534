"""Stored tables: columns, concurrent loads, partitions, retention, compaction, catalog."""

from __future__ import annotations

import os
import random
import uuid
from decimal import Decimal

import pytest

from wagegrid.operators import dedupe, merge, rates
from wagegrid.sources import maintained, tables, versions
from wagegrid.sources.versions import ConcurrentLoadError


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def stored(spark, target):
    return rows(tables.read_table(spark, target))


def test_loads_keep_arriving_columns(spark, scratch):
    """A stored load gives what the lazy operator gives."""
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    wide = spark.createDataFrame([(2, "c", 7), (3, "d", 8)], "k int, v string, w int")
    narrow = spark.createDataFrame([(2,), (4,)], "k int")
    for arriving in (wide, narrow):
        target = scratch("upsert")
        tables.first_load(spark, old, target)
        tables.upsert_load(spark, arriving, target, "k")
        lazy = merge.upsert(old, arriving, "k")
        assert tables.read_table(spark, target).columns == lazy.columns
        assert stored(spark, target) == rows(lazy)
    target = scratch("append")
    tables.first_load(spark, old, target)
    with pytest.raises(KeyError, match="w"):
        tables.append_load(spark, wide, target, "k", "k")
    assert stored(spark, target) == rows(old)
    assert tables.append_load(spark, narrow, target, "k", "k") == 1
    assert stored(spark, target) == ["(1, 'a')", "(2, 'b')", "(4, None)"]


def test_a_new_column_is_null_in_untouched_partitions(spark, scratch):
    target = scratch("upsert")
    tables.first_load(spark, spark.createDataFrame([(1, 1), (2, 1), (None, 1)], "p int, k int"), target, ["p"])
    tables.upsert_load(spark, spark.createDataFrame([(2, 1, "x"), (2, 2, "y")], "p int, k long, w string"),
                       target, ["p", "k"], partition_by=["p"])
    assert stored(spark, target) == ["(1, 1, None)", "(2, 1, 'x')", "(2, 2, 'y')", "(None, 1, None)"]
    assert tables.read_table(spark, target).schema["k"].dataType.simpleString() == "int"


LOADS = {
    "refresh": lambda spark, df, target: tables.full_refresh(spark, df, target, partition_by=["p"]),
    "append": lambda spark, df, target: tables.append_load(spark, df, target, ["p", "k"], "k",
                                                           partition_by=["p"]),
    "upsert": lambda spark, df, target: tables.upsert_load(spark, df, target, ["p", "k"],
                                                           partition_by=["p"])}


@pytest.mark.parametrize("slow,fast", [("refresh", "refresh"), ("upsert", "append"), ("append", "upsert")])
def test_of_two_loads_at_once_one_wins_whole(spark, scratch, monkeypatch, slow, fast):
    """``fast`` runs as a whole while ``slow`` stands between writing and committing."""
    schema, target = "p int, k int, v string", scratch("table")
    frame = lambda tag: spark.createDataFrame(
        [(p, k, tag) for p in (1, 2, None) for k in (1, 2 if tag == "old" else 3)], schema)
    tables.first_load(spark, frame("old"), target, ["p"])
    alone = scratch("alone")
    tables.first_load(spark, frame("old"), alone, ["p"])
    LOADS[fast](spark, frame("fast"), alone)
    commit = versions.commit

    def interleaved(*args, **kwargs):
        monkeypatch.setattr(versions, "commit", commit)
        LOADS[fast](spark, frame("fast"), target)
        return commit(*args, **kwargs)
    monkeypatch.setattr(versions, "commit", interleaved)
    with pytest.raises(ConcurrentLoadError, match="Run this load again"):
        LOADS[slow](spark, frame("slow"), target)
    assert stored(spark, target) == stored(spark, alone)
    LOADS[slow](spark, frame("slow"), target)  # the loser, run again
    LOADS[slow](spark, frame("slow"), alone)
    assert stored(spark, target) == stored(spark, alone)


def test_first_loads_at_once(spark, scratch):
    target = scratch("table")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    one = tables.stage_append(spark, df, target, "k", "k")
    two = tables.stage_append(spark, df.selectExpr("2 AS k", "v"), target, "k", "k")
    two.publish()
    with pytest.raises(ConcurrentLoadError):
        one.publish()
    assert stored(spark, target) == ["(2, 'a')"]


def test_a_commit_is_there_or_not(spark, scratch):
    target = scratch("table")
    df = spark.range(3)
    tables.first_load(spark, df, target)
    at = versions.latest(spark, target)
    with pytest.raises(ConcurrentLoadError):
        versions.commit(spark, target, None, at.schema, (), at.parts)
    assert versions.latest(spark, target) == at
    assert [n for n in os.listdir(f"{target}/_versions") if "draft" in n and not n.endswith(".crc")] == []


@pytest.mark.parametrize("kind,values", [("int", (1, 2)), ("decimal(10,2)", (Decimal("1.50"), Decimal("2.25")))])
def test_failure_between_two_partitions_leaves_every_old_row(spark, scratch, kind, values):
    """The write of one touched partition succeeds, that of another fails."""
    target, schema = scratch("upsert"), f"p {kind}, k int, v string"
    old = spark.createDataFrame([(p, k, "old") for p in (None, *values) for k in (1, 2)], schema)
    tables.first_load(spark, old, target, ["p"])
    new = spark.createDataFrame([(None, 1, "new"), *((p, 1, "new") for p in values)], schema)
    commit, write = versions.commit, tables.write_load

    def half(df, folder, parts, cluster_by=()):
        if folder == target:  # one partition is written, then the driver is lost
            write(df.where(f"p = {values[0]}"), folder, parts, cluster_by)
            raise RuntimeError("lost between two partitions")
        return write(df, folder, parts, cluster_by)
    tables.write_load = half
    try:
        with pytest.raises(RuntimeError):
            tables.upsert_load(spark, new, target, ["p", "k"], partition_by=["p"])
    finally:
        tables.write_load, versions.commit = write, commit
    assert stored(spark, target) == rows(old)
    assert tables.upsert_load(spark, new, target, ["p", "k"], partition_by=["p"]) == 0
    assert stored(spark, target) == rows(merge.upsert(old, new, ["p", "k"]))


def test_readers_keep_their_version(spark, scratch):
    target = scratch("table")
    tables.first_load(spark, spark.range(5), target)
    reader = tables.read_table(spark, target)
    tables.full_refresh(spark, spark.range(2), target)
    assert reader.count() == 5 and tables.read_table(spark, target).count() == 2


def test_retention_is_by_age(spark, scratch):
    target = scratch("table")
    for n in range(1, 5):
        tables.full_refresh(spark, spark.range(n), target)
    pending = tables.stage_append(spark, spark.range(9), target, "id", "id")
    loads = lambda: len([n for n in os.listdir(target) if n.startswith(versions.LOAD)])
    assert versions.clean(spark, target) == [] and loads() == 5  # nothing is a week old
    pending.publish()
    assert len(versions.clean(spark, target, hours=0)) == 3 and loads() == 2
    assert tables.read_table(spark, target).count() == 9
    assert len(versions._numbers(spark, target)) == 2


def test_plain_folders_are_read_and_taken_over(spark, scratch):
    target = scratch("plain")
    spark.range(4).write.parquet(target)
    assert tables.path_exists(spark, target) and tables.read_table(spark, target).count() == 4
    with pytest.raises(ValueError, match="plain folder"):
        tables.append_load(spark, spark.range(2), target, "id", "id")
    assert tables.full_refresh(spark, spark.range(2), target) == 2
    assert tables.read_table(spark, target).count() == 2
    with pytest.raises(ValueError, match="stored by"):
        tables.append_load(spark, spark.range(2), target, "id", "id", partition_by=["id"])


def test_compaction_after_many_appends(spark, scratch):
    target = scratch("daily")
    for day in range(30):
        df = spark.range(day * 10, day * 10 + 10).selectExpr(
            "id", "IF(id % 7 = 0, NULL, CAST(id % 3 AS INT)) AS p", f"'{day}' AS v")
        tables.append_load(spark, df, target, "id", "id", partition_by=["p"])
    before, reader = stored(spark, target), tables.read_table(spark, target)
    assert len(reader.inputFiles()) >= 100
    assert tables.compact(spark, target) >= 100
    files = tables.read_table(spark, target).inputFiles()
    assert len(files) == 4 and stored(spark, target) == before
    assert rows(reader) == before  # a reader of the version before
    assert tables.compact(spark, target) == 0
    tables.append_load(spark, spark.createDataFrame([(999, None, "x")], "id long, p int, v string"), target,
                       "id", "id", partition_by=["p"])
    assert tables.compact(spark, target) == 2  # only the partition that has two files
    assert len(tables.read_table(spark, target).inputFiles()) == 4
    with pytest.raises(ConcurrentLoadError):
        loser = tables.stage_append(spark, spark.createDataFrame([(1000, 1, "y")], "id long, p int, v string"),
                                    target, "id", "id", ["p"])
        tables.append_load(spark, spark.createDataFrame([(1001, 1, "y")], "id long, p int, v string"), target,
                           "id", "id", ["p"])
        loser.publish()


def test_catalog_reader_between_any_two_statements(spark, scratch, monkeypatch):
    name, root = f"wagegrid_shown_{uuid.uuid4().hex[:8]}", scratch("catalog")
    schema = "branch_id int, year int, month int, v double"
    one = spark.createDataFrame([(1, 2020, 1, 1.0), (1, 2020, 2, 1.0), (1, None, 3, 1.0)], schema)
    two = spark.createDataFrame([(2, 2020, 2, 2.0), (2, 2021, 1, 2.0), (2, None, None, 2.0)], schema)
    three = spark.createDataFrame([(1, 2020, 2, 3.0), (2, None, None, 3.0)], schema)
    assert tables.full_refresh_table(spark, one, name, root, partition_by=["year", "month"]) == 3
    seen, sql = [], type(spark).sql

    def watched(self, text, *args, **kwargs):
        out = sql(self, text, *args, **kwargs)
        seen.append(rows(sql(self, f"SELECT * FROM {name}")))
        return out
    monkeypatch.setattr(type(spark), "sql", watched)
    tables.full_refresh_table(spark, two, name, root, partition_by=["year", "month"])
    tables.upsert_load(spark, three, f"{root}/{name}", ["branch_id", "year", "month"],
                       partition_by=["year", "month"])
    tables.show_table(spark, name, f"{root}/{name}")
    monkeypatch.undo()
    merged = rows(merge.upsert(two, three, ["branch_id", "year", "month"]))
    assert seen and all(s in (rows(one), rows(two), merged) for s in seen)
    assert seen[-1] == merged == rows(spark.table(name))
    spark.sql(f"DROP VIEW {name}")
    spark.sql(f"DROP TABLE {name}__files")


def attendance(rng, n, first):
    """Random attendance with NULL keys, dates and times."""
    return [(first + k, rng.choice([1, 1, 1, 2, 3, None]),
             rng.choice([None, *(f"2020-{m:02d}-{d:02d}" for m in (1, 2, 12) for d in (1, 15))]),
             rng.choice([None, 0, 28800, 43200, 61200]), rng.choice([None, 0, 61200, 70000]))
            for k in range(n)]


TS = "timesheet_id long, employee_id long, d string, checkin long, checkout long"


def test_maintained_sums_equal_recomputation(spark, scratch):
    rng, source, target = random.Random(5), scratch("attendance"), scratch("sums")
    for batch in range(5):
        df = spark.createDataFrame(attendance(rng, 40, batch * 30), TS).selectExpr(
            "timesheet_id", "employee_id", "CAST(d AS DATE) AS date", "checkin", "checkout")
        tables.append_load(spark, df, source, "timesheet_id", "timesheet_id")
        if batch == 2:
            tables.compact(spark, source)
        for _ in range(2):  # a second refresh changes nothing
            maintained.refresh_state(spark, source, target, lambda r: rates.attendance_sums(r, "c"),
                                     rates.add_sums, ["year", "month"])
        whole = rates.monthly_attendance(tables.read_table(spark, source), "c")
        assert rows(rates.months_of_sums(tables.read_table(spark, target))) == rows(whole)
    # A source that was replaced is taken in anew.
    tables.full_refresh(spark, df, source)
    maintained.refresh_state(spark, source, target, lambda r: rates.attendance_sums(r, "c"),
                             rates.add_sums, ["year", "month"])
    assert rows(rates.months_of_sums(tables.read_table(spark, target))) == rows(
        rates.monthly_attendance(df, "c"))


@pytest.mark.parametrize("nulls_first", [True, False])
def test_maintained_latest_equals_recomputation(spark, scratch, nulls_first):
    rng, source, target = random.Random(6), scratch("employees"), scratch("latest")

    def latest(df):
        return dedupe.latest_employee(df, nulls_first)
    for batch in range(4):
        data = [(rng.randrange(6), rng.choice([None, 1, 2]), rng.choice([None, Decimal("5.00"), Decimal("7.00")]),
                 rng.choice([None, "2020-01-01", "2021-01-01"])) for _ in range(15)]
        df = spark.createDataFrame(data, "employee_id long, branch_id int, salary decimal(10,2), j string") \
            .selectExpr("employee_id", "branch_id", "salary", "CAST(j AS DATE) AS join_date",
                        "CAST(NULL AS DATE) AS resign_date")
        tables.append_load(spark, df, source, df.columns, "employee_id")
        maintained.refresh_state(spark, source, target, latest,
                                 lambda a, b: latest(a.unionByName(b)))
        assert stored(spark, target) == rows(latest(tables.read_table(spark, source)))


def test_the_difference_is_told_by_whole_loads(spark):
    from pyspark.sql import types as T

    def version(loads, merged=None):
        return versions.Version(1, T.StructType([]), (), tuple((x, "") for x in loads), {}, merged or {})
    parts = maintained.uncovered_parts
    assert parts(version("abc"), ["a", "b"]) == [("c", "")]
    assert parts(version("cd", {"d": ["a", "b"]}), ["a", "b"]) == [("c", "")]
    assert parts(version("ce", {"e": ["d", "x"], "d": ["a", "b"]}), ["a", "b", "x"]) == [("c", "")]
    assert parts(version("cd", {"d": ["a", "b"]}), ["a"]) is None   # rows of both kinds
    assert parts(version("c"), ["a"]) is None                       # a covered load has gone
    assert maintained.covered_loads(version("ce", {"e": ["d", "x"], "d": ["a", "b"]})) == ["a", "b", "c", "x"]


def test_sums_read_no_attendance_history(spark, scratch):
    """The second run's refresh reads the new load's files only."""
    source, target = scratch("attendance"), scratch("sums")
    read = []

    def sums(df):
        read.append(set(df.inputFiles()))
        return rates.attendance_sums(df, "c")
    for first in (0, 100):
        df = spark.createDataFrame(attendance(random.Random(first), 50, first), TS).selectExpr(
            "timesheet_id", "employee_id", "CAST(d AS DATE) AS date", "checkin", "checkout")
        tables.append_load(spark, df, source, "timesheet_id", "timesheet_id")
        maintained.refresh_state(spark, source, target, sums, rates.add_sums, ["year", "month"])
    assert len(read) == 2 and read[1] and not read[0] & read[1]
    assert read[1] <= set(tables.read_table(spark, source).inputFiles())
