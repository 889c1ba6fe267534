"""Boundary times crossed check-in x check-out, per policy, against the model."""

from __future__ import annotations

import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from model import duration, fill, prorate
from wagegrid.functions import time_literal
from wagegrid.operators.rates import shift_hours

BOUNDARIES = [None, 0, 28799, 28800, 28801, 43199, 43200, 43201, 61199, 61200, 61201, 86399]
SCHEMA = T.StructType([
    T.StructField("timesheet_id", T.LongType()),
    T.StructField("employee_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("checkin", T.LongType()),
    T.StructField("checkout", T.LongType()),
])


@pytest.fixture(scope="module")
def grid(spark):
    import datetime as dt
    rows = [(i, 1, dt.date(2020, 1, 1), ci, co)
            for i, (ci, co) in enumerate(itertools.product(BOUNDARIES, BOUNDARIES))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("policy", ["a", "b", "c"])
def test_fill_and_duration_match_model(grid, policy):
    out = shift_hours(grid, policy).select(
        "checkin", "checkout", "checkin_new", "checkout_new", "work_seconds").collect()
    assert len(out) == len(BOUNDARIES) ** 2
    for r in out:
        new_ci, new_co = fill(r.checkin, r.checkout, policy)
        assert (r.checkin_new, r.checkout_new) == (new_ci, new_co), (policy, r)
        assert r.work_seconds == duration(new_ci, new_co, policy), (policy, r)


def _one(grid, policy, ci, co):
    r = shift_hours(grid, policy).filter(
        F.col("checkin").eqNullSafe(ci) & F.col("checkout").eqNullSafe(co)).collect()
    assert len(r) == 1
    return r[0]


def test_hand_written_cases(grid):
    # A: missing check-in with check-out exactly 08:00 stays NULL, and the
    # chosen branch (out < 17:00) then gives a NULL duration.
    r = _one(grid, "a", None, 28800)
    assert r.checkin_new is None and r.work_seconds is None
    # A: both missing -> 9 h; both exactly 17:00 -> 9 h.
    assert _one(grid, "a", None, None).work_seconds == 32400
    assert _one(grid, "a", 61200, 61200).work_seconds == 32400
    # A: 08:00 -> 17:00 is 9 h; a check-out after midnight gives a negative span.
    assert _one(grid, "a", 28800, 61200).work_seconds == 32400
    assert _one(grid, "a", 61199, 0).work_seconds == -61199
    # B: afternoon fills never fire; a morning check-in fills 17:00.
    assert _one(grid, "b", None, 61201).checkin_new is None
    assert _one(grid, "b", 28800, None).checkout_new == 61200
    # C: any missing time after the fill -> 9 h; noon check-in counts backwards.
    assert _one(grid, "c", None, 61201).work_seconds == 32400
    assert _one(grid, "c", 43200, 61200).work_seconds == 43200 - 61200
    # C: midnight check-in, afternoon check-out -> forward span.
    assert _one(grid, "c", 0, 61201).work_seconds == 61201


def test_time_literal():
    assert time_literal("08:00:00") == 28800
    assert time_literal("17:00:00") == 61200
    with pytest.raises(ValueError):
        time_literal("24:00:00")


@pytest.mark.parametrize("days,expected", [(1, Decimal("0.05")), (11, Decimal("0.50")),
                                           (21, Decimal("0.95")), (22, Decimal("1.00"))])
def test_proration_model(days, expected):
    assert prorate(days, 100) == expected * 100
    assert prorate(23, 100) == 100


def test_proration_expression(spark):
    from wagegrid.functions import prorated_salary
    df = spark.createDataFrame([(d,) for d in range(1, 40)], "total_day long") \
        .withColumn("salary", F.lit(Decimal("2200000.00")).cast("decimal(10,2)"))
    got = {r.total_day: r.p for r in df.select("total_day", prorated_salary().alias("p")).collect()}
    for d, p in got.items():
        assert p == prorate(d, Decimal("2200000.00")), d


def test_text_times(spark):
    from wagegrid.functions import parse_time
    df = spark.createDataFrame([("8:05:00",), ("08:05:00",), ("xx",), ("",), (None,),
                                ("23:59:59",), ("25:00:00",)], "t string")
    got = [r.s for r in df.select(parse_time("t", coerce=True).alias("s")).collect()]
    assert got == [29100, 29100, None, None, None, 86399, None]
    with pytest.raises(Exception):
        df.filter("t = 'xx'").select(parse_time("t").alias("s")).collect()
