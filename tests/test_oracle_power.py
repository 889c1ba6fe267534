"""The registered oracles can fail: a broken operator turns its row red."""

from __future__ import annotations

import pytest
from conftest import SF_CHECK
from oracle_harness import compare
from pyspark.sql import functions as F

from wagegrid.operators import dedupe, merge, rates
from wagegrid.plans import oracle, queries
from wagegrid.sources import keyindex, maintained, tables, versions


def _first_load_dedupes(patch):
    good = tables.first_load
    patch.setattr(tables, "first_load", lambda spark, new, target, partition_by=None: good(
        spark, new.dropDuplicates(["timesheet_id"]), target, partition_by))


def _append_keeps_duplicates(patch):
    patch.setattr(merge, "latest_keyed", lambda new, keys, seq: merge.with_key_columns(new, keys))


def _keep_last_by_key(patch):
    patch.setattr(dedupe, "keep_last", lambda df, keys, seq: dedupe.top_per_key(
        df, keys, ["timesheet_id DESC"]))


def _union_fills_missing(patch):
    good = merge.union_all
    patch.setattr(merge, "union_all", lambda a, b: good(a, b).fillna(0))


def _distinct_does_nothing(patch):
    patch.setattr(merge, "distinct_rows", lambda df: df)


def _null_branch_dropped(patch):
    good = rates.payroll_employees
    patch.setattr(rates, "payroll_employees", lambda e, p: good(e, p).where("branch_id IS NOT NULL"))


def _null_date_dropped(patch):
    good = rates.monthly_attendance
    patch.setattr(rates, "monthly_attendance", lambda t, p: good(t.where("date IS NOT NULL"), p))


def _zero_hours_give_zero(patch):
    good = rates.hourly_rate_sql
    patch.setattr(rates, "hourly_rate_sql", lambda *a: f"coalesce({good(*a)}, 0.0D)")


def _hour_24_accepted(patch):
    from wagegrid.functions.timeofday import parse_time_sql
    patch.setattr(queries, "parse_time", lambda text, coerce=False: F.expr(
        parse_time_sql(text, coerce).replace("<= 23", "<= 24")))


def _resign_date_lost(patch):
    good = dedupe.latest_employee
    patch.setattr(dedupe, "latest_employee", lambda e, nulls_first: good(e, nulls_first).withColumn(
        "resign_date", F.lit(None).cast("date")))


def _null_partition_lost(patch):
    good = tables._touched

    def lost(*args):
        near = good(*args)
        near.stored = near.stored.where("date IS NOT NULL")
        return near
    patch.setattr(tables, "_touched", lost)


def _new_column_lost(patch):
    good = tables.merged_with_flag
    patch.setattr(tables, "merged_with_flag", lambda stored, *args: good(stored, *args).drop(
        *({"checkout"} - set(stored.columns))))


def _stored_loads_counted_again(patch):
    patch.setattr(maintained, "uncovered_parts", lambda source, covered: list(source.parts))


def _compaction_loses_a_load(patch):
    good = versions.read
    patch.setattr(tables.versions, "read", lambda spark, root, at, parts=None, **more: good(
        spark, root, at, parts if parts is None else list(parts)[1:], **more))


def _index_misses_files(patch):
    patch.setattr(keyindex, "candidate_files", lambda *args: [])


def _append_keeps_stored_duplicates(patch):
    patch.setattr(tables, "latest_keyed", lambda new, keys, seq: merge.with_key_columns(new, keys))


BROKEN = [
    ("incremental_first_load", _first_load_dedupes), ("append_new_keys", _append_keeps_duplicates),
    ("keep_last", _keep_last_by_key), ("union_all_sources", _union_fills_missing),
    ("distinct_rates", _distinct_does_nothing), ("gross_hours_a", _null_branch_dropped),
    ("gross_hours_b", _null_date_dropped), ("employee_rate_a", _zero_hours_give_zero),
    ("employee_rate_b", _zero_hours_give_zero), ("employee_rate_c", _zero_hours_give_zero),
    ("parse_time_coerce", _hour_24_accepted), ("dedupe_employees_nulls_last", _resign_date_lost),
    ("upsert_partitioned", _null_partition_lost), ("upsert_new_column", _new_column_lost),
    ("append_absent_column", _append_keeps_stored_duplicates),
    ("maintained_attendance", _stored_loads_counted_again),
    ("compact_appends", _compaction_loses_a_load), ("append_indexed", _index_misses_files),
]


@pytest.mark.parametrize("name,damage", BROKEN, ids=[f"{n}-{d.__name__[1:]}" for n, d in BROKEN])
def test_broken_operator_is_noticed(spark, monkeypatch, name, damage):
    damage(monkeypatch)
    result = compare(spark, name, queries.queries()[name], oracle.oracle_sql()[name], SF_CHECK)
    assert result["status"] not in ("ok", "rows-only"), result
