"""Physical plan properties that matter at scale, read from ``explain``."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from wagegrid.operators.rates import branch_rates
from wagegrid.sources import testdata


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return testdata.load_tables(spark, SF_SMALL)


@pytest.mark.parametrize("policy", ["a", "b", "c"])
def test_no_python_and_partial_aggregation(tables, policy):
    ts, emp = tables
    df = branch_rates(ts, emp, policy)
    df.collect()  # final adaptive plan
    plan = plan_text(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert node not in plan
    # attendance is pre-aggregated map-side before its shuffle
    assert "partial_count" in plan and "partial_sum" in plan
    assert "partial_avg" in plan
    # column pruning and pushdown reach the events scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("policy", ["b", "c"])
def test_latest_record_is_cut_before_the_shuffle(tables, policy):
    ts, emp = tables
    df = branch_rates(ts, emp, policy)
    df.collect()
    plan = plan_text(df)
    # top-1 per employee runs partially before the exchange (hot keys shrink map-side)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["branch_id", "year", "month", "salary_per_hour"]
    assert df.count() > 0


def test_bounded_batch_keys_are_broadcast_and_stored_table_not_shuffled(spark, tables):
    from wagegrid.operators.merge import latest_keyed
    from wagegrid.sources.tables import rows_with_new_keys
    ts, _ = tables
    stored = ts.filter("timesheet_id % 3 = 0")
    batch, cols = latest_keyed(ts.filter("timesheet_id % 2 = 0"), ["timesheet_id"], "timesheet_id")
    small = rows_with_new_keys(batch, 1000, stored, ["timesheet_id"], cols)
    small.collect()
    plan = plan_text(small)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    # the stored key scan feeds the semi join directly, with no shuffle between
    lines = plan.split("\n")
    semi = next(i for i, l in enumerate(lines) if "LeftSemi" in l)
    scan = next(i for i in range(semi, len(lines)) if "FileScan" in lines[i])
    assert not any("Exchange" in lines[i] for i in range(semi, scan))
    big = rows_with_new_keys(batch, 10**9, stored, ["timesheet_id"], cols)
    assert big.count() == small.count()
