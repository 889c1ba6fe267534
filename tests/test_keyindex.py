"""Key lookups through the index, the join with hot keys, headers read by tasks."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from wagegrid.operators.spread import hot_keys, left_join_spread
from wagegrid.sources import csv as csv_io
from wagegrid.sources import keyindex, tables, versions

ROWS = "k long, name string, day date, v string"


def frame(spark, lo, hi, tag):
    return spark.range(lo, hi).selectExpr(
        "IF(id % 50 = 49, NULL, id) AS k", "concat('n', id % 10) AS name",
        "IF(id % 7 = 0, NULL, date_add(DATE'2020-01-01', CAST(id % 400 AS INT))) AS day", f"'{tag}' AS v")


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("keys,parts", [(["k"], None), (["day", "k"], ["name"]), (["name", "k"], ["name"])])
def test_indexed_append_equals_the_plain_one(spark, scratch, keys, parts):
    plain, target, index = scratch("plain"), scratch("indexed"), scratch("index")
    for n, (lo, hi) in enumerate([(0, 120), (100, 160), (0, 30), (500, 520)]):
        new = frame(spark, lo, hi, n)
        tables.append_load(spark, new, plain, keys, "v", parts)
        keyindex.append_indexed(spark, new, target, keys, "v", index, parts).publish()
        if n == 1:
            tables.compact(spark, target)
        assert rows(tables.read_table(spark, target)) == rows(tables.read_table(spark, plain))


def test_files_read_fall_with_the_share_of_files_hit(spark, scratch, monkeypatch):
    target, index = scratch("table"), scratch("index")
    for n in range(10):
        keyindex.append_indexed(spark, frame(spark, n * 100, n * 100 + 100, n).coalesce(1), target, "k", "v",
                                index).publish()
    asked = []
    found = keyindex.candidate_files
    monkeypatch.setattr(keyindex, "candidate_files", lambda *a: asked.append(found(*a)) or asked[-1])
    whole = len(tables.read_table(spark, target).inputFiles())
    for lo, hi, most in ((2000, 2040, 0), (310, 340, 1), (150, 350, 3)):
        new = frame(spark, lo, hi, "x").where("k IS NOT NULL")
        staged = keyindex.append_indexed(spark, new, target, "k", "v", index)
        assert len(asked[-1]) == most < whole
        assert staged.count == (40 if lo == 2000 else 0)
    # A key that no file holds lies inside a file's range: the filter tells.
    inside = spark.createDataFrame([(149, "n", None, "x")], ROWS)  # NULL there
    keyindex.append_indexed(spark, inside, target, "k", "v", index).publish()
    assert tables.read_table(spark, target).where("k = 149").count() == 1


def test_a_false_positive_changes_nothing(spark, scratch, monkeypatch):
    target, index = scratch("table"), scratch("index")
    for n in range(3):
        keyindex.append_indexed(spark, frame(spark, n * 100, n * 100 + 60, n), target, "k", "v", index).publish()
    new = frame(spark, 40, 140, "x")
    want = rows(keyindex.append_indexed(spark, new, target, "k", "v", index).rows)
    monkeypatch.setattr(keyindex, "candidate_files",
                        lambda s, *a: tables.read_table(s, target).inputFiles())
    assert rows(keyindex.append_indexed(spark, new, target, "k", "v", index).rows) == want


def test_index_rows_are_written_once_and_go_with_their_load(spark, scratch):
    target, index = scratch("table"), scratch("index")
    for n in range(3):
        keyindex.append_indexed(spark, frame(spark, n * 100, n * 100 + 60, n), target, "k", "v", index).publish()
    keyindex.refresh_index(spark, target, index, "k")
    first = versions.latest(spark, index)
    assert {f.partition("=")[2] for _, f in first.parts} == versions.latest(spark, target).loads()
    keyindex.refresh_index(spark, target, index, "k")
    assert versions.latest(spark, index) == first
    tables.full_refresh(spark, frame(spark, 0, 10, "y"), target)
    keyindex.refresh_index(spark, target, index, "k")
    assert {f.partition("=")[2] for _, f in versions.latest(spark, index).parts} == \
        versions.latest(spark, target).loads()


def test_hot_keys_are_spread(spark):
    """A third of the rows has one key, a fifth none: no task gets over three times the
    median, without adaptive skew handling, and the result is the plain join's."""
    left = spark.range(30_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN -5 WHEN id % 5 = 0 THEN NULL ELSE id % 4001 END AS k")
    right = spark.range(4500).selectExpr("IF(id % 900 = 0, -5, id) AS k", "id AS r")
    assert dict(hot_keys(left, "k", 8)).keys() == {-5}
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = left_join_spread(left, right, "k")
        read = joined.select("id", F.spark_partition_id().alias("p")).distinct().groupBy("p").count().collect()
        counts = sorted(r["count"] for r in read)
        assert len(counts) == 8 and counts[-1] <= 3 * counts[4]
        plain = left.join(right, "k", "left")
        together = sorted(r["count"] for r in plain.select("id", F.spark_partition_id().alias("p")).distinct()
                          .groupBy("p").count().collect())
        assert together[-1] > 3 * together[4]
        assert joined.columns == plain.columns and rows(joined) == rows(plain)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_join_without_hot_keys_or_rows(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k long, x string")
    right = spark.createDataFrame([(1, "r"), (1, "s"), (None, "t")], "k long, y string")
    assert rows(left_join_spread(left, right, "k")) == rows(left.join(right, "k", "left"))
    assert rows(left_join_spread(left.where("false"), right, "k")) == []
    assert rows(left_join_spread(left, right.where("false"), "k")) == rows(
        left.join(right.where("false"), "k", "left"))


def test_headers_are_read_by_tasks(spark, scratch, monkeypatch):
    folder = scratch("many")
    os.makedirs(folder)
    orders = [["timesheet_id", "employee_id", "date", "checkin", "checkout"],
              ["checkout", "date", "timesheet_id", "checkin", "employee_id"],
              ["date", "extra", "employee_id", "checkin", "checkout", "timesheet_id"]]
    for n in range(600):
        values = {"timesheet_id": n, "employee_id": n % 9, "date": "2020-01-02", "checkin": "08:00:00",
                  "checkout": "17:00:00", "extra": '"a,b"'}
        order = orders[n % 3]
        with open(f"{folder}/day {n}.csv", "w") as f:
            f.write(",".join(order) + "\n" + ",".join(str(values[c]) for c in order) + "\n")
    open(f"{folder}/empty.csv", "w").close()

    def opened(*_):
        raise AssertionError("the driver opened a file")
    monkeypatch.setattr(versions, "lines", opened)
    heads = csv_io._headers(spark, folder)
    assert sorted(heads) == sorted(map(tuple, orders)) and sum(map(len, heads.values())) == 600
    got = csv_io.read_timesheets_csv(spark, folder, by_name=True).collect()
    assert sorted(r.timesheet_id for r in got) == list(range(600))
    assert all(r.employee_id == r.timesheet_id % 9 and r.checkout == "17:00:00" for r in got)
