"""CSV scans and sinks, staged loads and the two batch jobs, on disk."""

from __future__ import annotations

import datetime as dt
import itertools
import os
import shutil
from decimal import Decimal

import pytest

from wagegrid.operators.rates import branch_rates
from wagegrid.plans import jobs
from wagegrid.schemas import EMPLOYEES, RESULT
from wagegrid.sources import csv as csv_io
from wagegrid.sources import tables, versions

D = dt.date


def write_text(folder: str, name: str, text: str) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


EMP_CSV = ('"employe_id","branch_id","salary","join_date","resign_date"\n'
           "1,3,6100000,2017-03-04,\n"
           "9,1,9900000,2016-05-06,2021-07-08\n"
           "77,1,5200000,2019-09-10,2021-11-12\n"
           "77,1,8300000,2019-09-10,2021-11-12\n")

TS_CSV = ("timesheet_id,employee_id,date,checkin,checkout\n"
          "1,1,2020-01-02,08:00:00,17:00:00\n"
          "2,9,2020-01-02,8:05:00,\n"
          "3,77,2020-01-02,,17:30:00\n")


def test_positional_scan_skips_misspelt_header(spark, scratch):
    folder = scratch("emp")
    write_text(folder, "employees.csv", EMP_CSV)
    df = csv_io.read_employees_csv(spark, folder)
    assert df.columns == EMPLOYEES.fieldNames()
    rows = df.orderBy("employee_id", "salary").collect()
    assert len(rows) == 4 and rows[0].resign_date is None
    assert rows[1].resign_date == D(2021, 7, 8)


def test_named_scan_repairs_header(spark, scratch):
    folder = scratch("emp")
    write_text(folder, "employees.csv", EMP_CSV)
    df = csv_io.read_employees_csv(spark, folder, by_name=True)
    assert df.columns == EMPLOYEES.fieldNames()
    assert df.filter("employee_id = 77").count() == 2


def test_malformed_row_fails_the_scan(spark, scratch):
    folder = scratch("bad")
    write_text(folder, "employees.csv", EMP_CSV + "x,1,abc,2020-01-01,\n")
    with pytest.raises(Exception):
        csv_io.read_employees_csv(spark, folder).collect()


def test_text_times_by_policy(spark, scratch):
    folder = scratch("ts")
    write_text(folder, "timesheets.csv", TS_CSV)
    ts = csv_io.read_timesheets_csv(spark, folder)
    emp = spark.createDataFrame([(e, 1, Decimal("2200000.00"), D(2019, 1, 1), None)
                                 for e in (1, 9, 77)], EMPLOYEES)
    from wagegrid.operators.rates import shift_hours
    got = {r.timesheet_id: r.work_seconds for r in shift_hours(ts, "c").collect()}
    assert got == {1: 32400, 2: 61200 - 29100, 3: 32400}
    assert branch_rates(ts, emp, "a").count() == 1


def test_csv_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, None)], "a long, b long, c string")
    path = scratch("csv")
    csv_io.write_csv(df, path)
    back = spark.read.schema("a long, b long, c string").option("header", True).csv(path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_full_refresh_replaces_and_failed_stage_keeps_old(spark, scratch):
    target = scratch("result")
    first = spark.createDataFrame([(1, 2020, 1, 10.005), (2, 2020, 1, 20.0)],
                                  "branch_id int, year int, month int, salary_per_hour double")
    assert tables.full_refresh(spark, first, target, RESULT) == 2
    stored = tables.read_table(spark, target).collect()
    assert {r.salary_per_hour for r in stored} == {Decimal("10.01"), Decimal("20.00")}
    second = first.filter("branch_id = 1")
    for _ in range(3):
        assert tables.full_refresh(spark, second, target, RESULT) == 1
    assert tables.read_table(spark, target).count() == 1
    # A value that overflows DECIMAL(10,2) fails while it is written: target intact.
    bad = spark.createDataFrame([(3, 2020, 1, 1e12)], first.schema)
    with pytest.raises(Exception):
        tables.full_refresh(spark, bad, target, RESULT)
    assert tables.read_table(spark, target).count() == 1


def test_upsert_load_rewrites_touched_partitions_only(spark, scratch):
    target = scratch("upsert")
    schema = "branch_id int, year int, month int, salary_per_hour double"
    first = spark.createDataFrame([(1, 2020, 1, 1.0), (1, 2020, 2, 2.0)], schema)
    assert tables.upsert_load(spark, first, target, ["branch_id", "year", "month"],
                              partition_by=["year", "month"]) == 2
    second = spark.createDataFrame([(1, 2020, 2, 3.0), (2, 2020, 2, 4.0)], schema)
    assert tables.upsert_load(spark, second, target, ["branch_id", "year", "month"],
                              partition_by=["year", "month"]) == 1
    got = sorted((r.branch_id, r.month, r.salary_per_hour)
                 for r in tables.read_table(spark, target).collect())
    assert got == [(1, 1, 1.0), (1, 2, 3.0), (2, 2, 4.0)]
    # the untouched month is still the first load's
    at = versions.latest(spark, target)
    assert {folder for load, folder in at.parts if load == at.parts[0][0]} != {
        folder for _, folder in at.parts} and len(at.loads()) == 2


def test_upsert_takes_every_arriving_row_and_leaves_other_partitions(spark, scratch):
    from conftest import SF_SMALL
    from wagegrid.plans import queries
    from wagegrid.sources import testdata

    new = testdata.new_batch(testdata.ordered_timesheets(spark, SF_SMALL))
    want = {r.timesheet_id for r in new.select("timesheet_id").distinct().collect()}
    whole = queries.queries()["upsert_partitioned_whole"](spark, SF_SMALL)
    assert want <= {r.timesheet_id for r in whole.select("timesheet_id").collect()}

    target, schema = scratch("upsert"), "p int, k int, v string"
    tables.first_load(spark, spark.createDataFrame([(p, 1, "old") for p in (1, 2, None)], schema),
                      target, ["p"])
    files = lambda: set(tables.read_table(spark, target).inputFiles())
    before = files()
    tables.upsert_load(spark, spark.createDataFrame([(2, 1, "new"), (2, 3, "new")], schema), target,
                       ["p", "k"], partition_by=["p"])
    kept = {f for f in before if "/p=2/" not in f}
    assert len(kept) == 2 and kept <= files() and len(files()) == 3
    assert sorted((r.p or 0, r.k, r.v) for r in tables.read_table(spark, target).collect()) == [
        (0, 1, "old"), (1, 1, "old"), (2, 1, "new"), (2, 3, "new")]


@pytest.mark.parametrize("kind,values", [
    ("int", (1, 2)), ("date", (D(2020, 1, 1), D(2020, 1, 2))), ("string", ("a'b", "c=d")),
    ("decimal(10,2)", (Decimal("1.50"), Decimal("2.25")))])
def test_upsert_keeps_rows_of_null_and_any_partition(spark, scratch, kind, values):
    """Stored rows of a touched partition survive, whatever its value."""
    target, schema = scratch("upsert"), f"p {kind}, k int, v string"
    rows = [(p, k, "old") for p in (None, *values) for k in (1, 2)]
    assert tables.upsert_load(spark, spark.createDataFrame(rows, schema), target, ["p", "k"],
                              partition_by=["p"]) == 6
    new = spark.createDataFrame([(None, 1, "new"), (values[0], 1, "new"), (values[0], 3, "new")], schema)
    assert tables.upsert_load(spark, new, target, ["p", "k"], partition_by=["p"]) == 1
    stored = tables.read_table(spark, target)
    assert stored.schema["p"].dataType.simpleString() == kind
    got = {(r.p, r.k): r.v for r in stored.collect()}
    assert len(got) == 7
    assert {key for key, v in got.items() if v == "new"} == {
        (None, 1), (values[0], 1), (values[0], 3)}


def test_upsert_evaluates_the_arriving_rows_once(spark, scratch):
    target, seen = scratch("upsert"), spark.sparkContext.accumulator(0)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.upsert_load(spark, first, target, "k")

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    new = first.mapInArrow(count, first.schema)
    assert tables.upsert_load(spark, new, target, "k") == 0
    assert seen.value == 2


def test_failure_before_the_switch_keeps_the_old_rows(spark, scratch, monkeypatch):
    target = scratch("refresh")
    df = spark.createDataFrame([(1, 2020, 1, 1.0)], "branch_id int, year int, month int, salary_per_hour double")
    tables.full_refresh(spark, df, target, RESULT, ["year", "month"])
    commit = versions.commit

    def lost(*args):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(versions, "commit", lost)
    with pytest.raises(RuntimeError):
        tables.full_refresh(spark, df.union(df), target, RESULT, ["year", "month"])
    assert tables.read_table(spark, target).count() == 1
    monkeypatch.setattr(versions, "commit", commit)
    assert tables.full_refresh(spark, df.union(df), target, RESULT, ["year", "month"]) == 2
    assert tables.read_table(spark, target).count() == 2


def test_a_first_version_counts_only_once_published(spark, scratch):
    target = scratch("staged")
    df = spark.createDataFrame([(1, D(2020, 1, 1)), (2, None)], "k int, date date")
    lost = tables.stage_append(spark, df, target, "k", "k", ["date"])
    assert lost.first and not tables.path_exists(spark, target)
    again = tables.stage_append(spark, df, target, "k", "k", ["date"])
    assert again.first and again.publish() == 2
    assert tables.read_table(spark, target).count() == 2


def test_partitioned_writes_leave_few_files(spark, scratch):
    target = scratch("files")
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "date_add(DATE'2020-01-01', CAST(id % 20 AS INT)) AS date")
    tables.first_load(spark, df, target, ["date"])
    files = tables.read_table(spark, target).inputFiles()
    assert len(files) <= 2 * 20


def test_named_scan_binds_each_file_by_its_header(spark, scratch):
    folder = scratch("mixed")
    write_text(folder, "a.csv", "timesheet_id,employee_id,date,checkin,checkout\n1,5,2020-01-02,08:00:00,17:00:00\n")
    write_text(folder, "b.csv", "checkout,checkin,date,extra,employee_id,timesheet_id\n"
                                "18:00:00,09:00:00,2020-01-03,x,6,2\n")
    write_text(folder, "empty.csv", "")
    got = {r.timesheet_id: (r.employee_id, r.checkin, r.checkout) for r in
           csv_io.read_timesheets_csv(spark, folder, by_name=True, arrival=True).collect()}
    assert got == {1: (5, "08:00:00", "17:00:00"), 2: (6, "09:00:00", "18:00:00")}
    write_text(folder, "c.csv", "timesheet_id,employee_id,date,checkin\n3,5,2020-01-02,08:00:00\n")
    with pytest.raises(KeyError):
        csv_io.read_timesheets_csv(spark, folder, by_name=True)


def test_jobs_refuse_policies_they_do_not_load(spark, scratch, capsys):
    for policy in ("c", "d"):
        with pytest.raises(ValueError):
            jobs.full_refresh_job(spark, "e", "t", "w", policy=policy)
    for policy in ("a", "b"):
        with pytest.raises(ValueError):
            jobs.incremental_job(spark, "e", "t", "w", policy=policy)
    with pytest.raises(SystemExit):
        jobs.main(["incremental", "--employees", "e", "--timesheets", "t", "--warehouse", "w",
                   "--policy", "a"])
    assert "accepts the policies c, d" in capsys.readouterr().err


def test_append_load_twice_adds_nothing(spark, scratch):
    target = scratch("append")
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k long, v string, s long")
    assert tables.append_load(spark, df, target, "k", "s") == 3       # first load keeps all
    assert tables.append_load(spark, df, target, "k", "s") == 0
    more = spark.createDataFrame([(3, "d", 1)], df.schema)
    assert tables.append_load(spark, more, target, "k", "s") == 1
    assert tables.read_table(spark, target).count() == 4


def test_catalog_table_ensure_and_probe(spark, scratch):
    name = "wagegrid_probe_" + os.path.basename(scratch("x")).replace("-", "_")
    assert not tables.table_exists(spark, name)
    tables.ensure_table(spark, name, RESULT, location=scratch("loc"))
    assert tables.table_exists(spark, name)
    tables.ensure_table(spark, name, RESULT)  # idempotent
    spark.sql(f"DROP TABLE {name}")


def test_jobs_end_to_end(spark, scratch):
    folder_e, folder_t = scratch("e"), scratch("t")
    write_text(folder_e, "employees.csv", EMP_CSV)
    write_text(folder_t, "timesheets.csv", TS_CSV)
    wh = scratch("wh")
    counts = jobs.full_refresh_job(spark, folder_e, folder_t, wh, result_csv=scratch("out"))
    assert counts == {"timesheets": 3, "employees": 4, "result": 2}
    wh2 = scratch("wh")
    c1 = jobs.incremental_job(spark, folder_e, folder_t, wh2)
    assert c1 == {"employees": 4, "timesheets": 3, "result": 2}
    c2 = jobs.incremental_job(spark, folder_e, folder_t, wh2)
    assert c2 == {"employees": 0, "timesheets": 0, "result": 0}


def test_incremental_job_equals_full_recompute(spark, scratch):
    """Second run appends attendance and changes employee records; the
    month-scoped recompute must equal recomputing everything."""
    from conftest import SF_SMALL
    from pyspark.sql import functions as F
    from wagegrid.sources import testdata

    ts, emp = testdata.load_tables(spark, SF_SMALL)
    wh = scratch("wh")

    def emp_csv(df):
        path = scratch("emp")
        csv_io.write_csv(df.withColumnRenamed("employee_id", "employe_id"), path)
        return path

    def ts_csv(df):
        path = scratch("ts")
        csv_io.write_csv(testdata.timesheets_text(df), path)
        return path

    first_emp = emp.filter("employee_id % 2 = 0")
    # run 2: the other employees arrive, and some known ones get a newer record
    newer = emp.filter("employee_id % 6 = 0").withColumn(
        "join_date", F.date_add("join_date", 400)).withColumn("branch_id", F.lit(99))
    jobs.incremental_job(spark, emp_csv(first_emp), ts_csv(testdata.old_batch(ts)), wh)
    c2 = jobs.incremental_job(spark, emp_csv(emp.unionByName(newer)),
                              ts_csv(testdata.new_batch(ts)), wh)
    assert c2["employees"] > 0 and c2["timesheets"] > 0

    stored = tables.read_table(spark, f"{wh}/salary_per_hours_c")
    full = branch_rates(tables.read_table(spark, f"{wh}/timesheets_python"),
                        tables.read_table(spark, f"{wh}/employees_python"), "c")

    def rows(df):
        return sorted((r.branch_id, r.year, r.month, round(r.salary_per_hour, 6))
                      for r in df.collect())
    # What a full recomputation after each run plus upsert would store:
    # run 2's rows, and run 1's rows whose key run 2 no longer produces.
    run1 = rows(branch_rates(testdata.old_batch(ts), first_emp, "c"))
    run2 = rows(full)
    keys2 = {r[:3] for r in run2}
    assert rows(stored) == sorted(run2 + [r for r in run1 if r[:3] not in keys2])


def test_incremental_job_policy_d_appends_new_result_keys_only(spark, scratch):
    folder_e, folder_t = scratch("e"), scratch("t")
    write_text(folder_e, "employees.csv", EMP_CSV)
    write_text(folder_t, "timesheets.csv", TS_CSV)
    wh = scratch("wh")
    assert jobs.incremental_job(spark, folder_e, folder_t, wh, policy="d")["result"] == 2
    first = {(r.branch_id, r.month): r.salary_per_hour
             for r in tables.read_table(spark, f"{wh}/salary_per_hours_d").collect()}
    more = scratch("t2")
    write_text(more, "timesheets.csv", "timesheet_id,employee_id,date,checkin,checkout\n"
                                       "4,1,2020-01-03,08:00:00,18:00:00\n"
                                       "5,1,2020-02-03,08:00:00,17:00:00\n")
    c = jobs.incremental_job(spark, folder_e, more, wh, policy="d")
    assert c["timesheets"] == 2 and c["result"] == 1        # only (3, 2020, 2) is new
    stored = {(r.branch_id, r.month): r.salary_per_hour
              for r in tables.read_table(spark, f"{wh}/salary_per_hours_d").collect()}
    assert set(stored) == {(3, 1), (1, 1), (3, 2)}
    # (3, 2020-01) got a longer shift in run 2, but an append never updates
    assert stored[(3, 1)] == first[(3, 1)]
    wh_c = scratch("wh")
    jobs.incremental_job(spark, folder_e, folder_t, wh_c, policy="c")
    jobs.incremental_job(spark, folder_e, more, wh_c, policy="c")
    upserted = {(r.branch_id, r.month): r.salary_per_hour
                for r in tables.read_table(spark, f"{wh_c}/salary_per_hours_c").collect()}
    assert upserted[(3, 1)] != first[(3, 1)]                # the upsert does update


def test_missing_checks_with_coerced_checkin(spark):
    from wagegrid.operators import quality
    df = spark.createDataFrame([(1, "xx", "17:00:00"), (2, None, "17:00:00"), (3, "08:00:00", None),
                                (4, "xx", None)], "timesheet_id long, checkin string, checkout string")
    assert quality.missing_either(df).count() == 3
    assert quality.missing_either(df, coerce_checkin=True).count() == 4
    assert quality.missing_both(df).count() == 0
    assert quality.missing_both(df, coerce_checkin=True).count() == 1
    flags = quality.missing_flags(df, coerce_checkin=True).first()
    assert (flags.missing_either, flags.missing_both) == (4, 1)
    assert quality.missing_flags(df).first().missing_either == 3
    staff = spark.createDataFrame([(1,)], "employee_id long")
    report = {r.table_name: r for r in quality.quality_report(df, staff, coerce_checkin=True).collect()}
    assert (report["timesheets"].missing_either, report["timesheets"].missing_both) == (4, 1)


def test_job_command_line(spark, scratch, capsys):
    import json
    folder_e, folder_t = scratch("e"), scratch("t")
    write_text(folder_e, "employees.csv", EMP_CSV)
    write_text(folder_t, "timesheets.csv", TS_CSV)
    jobs.main(["full-refresh", "--employees", folder_e, "--timesheets", folder_t,
               "--warehouse", scratch("wh"), "--policy", "b"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"timesheets": 3, "employees": 4, "result": 2}


def test_incremental_job_rerun_after_failure_completes(spark, scratch, monkeypatch):
    """Crash before or after each commit (two sources, two states, the result): running
    the job again must give the same tables as an uninterrupted run."""
    folder_e, folder_t = scratch("e"), scratch("t")
    write_text(folder_e, "employees.csv", EMP_CSV)
    write_text(folder_t, "timesheets.csv", TS_CSV)
    more_e, more_t = scratch("e2"), scratch("t2")
    write_text(more_e, "employees.csv", EMP_CSV + "9,4,14000000,2021-01-01,\n")
    write_text(more_t, "timesheets.csv", "timesheet_id,employee_id,date,checkin,checkout\n"
                                         "4,1,2020-01-03,08:00:00,18:00:00\n"
                                         "5,9,2020-02-03,08:00:00,17:00:00\n")
    commit = versions.commit
    first = scratch("wh")
    jobs.incremental_job(spark, folder_e, folder_t, first)

    def run_all(wh, crash_at=0, after=False):
        shutil.copytree(first, wh)  # after the first run
        if crash_at:
            calls = itertools.count(1)

            def flaky(*args, **kwargs):
                n = next(calls)  # this call's number: two threads commit side by side
                if n == crash_at and not after:
                    raise RuntimeError("driver lost")
                made = commit(*args, **kwargs)
                if n == crash_at:
                    raise RuntimeError("driver lost")
                return made
            monkeypatch.setattr(versions, "commit", flaky)
            with pytest.raises(RuntimeError):
                jobs.incremental_job(spark, more_e, more_t, wh)
            monkeypatch.setattr(versions, "commit", commit)
        jobs.incremental_job(spark, more_e, more_t, wh)
        names = ("salary_per_hours_c", "timesheets_python", "employees_python",
                 "attendance_sums_c", "employees_latest_c")
        return {n: sorted(map(str, tables.read_table(spark, f"{wh}/{n}").collect())) for n in names}

    whole = run_all(scratch("wh"))
    for crash_at, after in ((1, True), (2, False), (2, True), (3, False), (4, True), (5, False)):
        assert run_all(scratch("wh"), crash_at, after) == whole


def test_run_sql_with_views_and_parameters(spark):
    df = spark.createDataFrame([(1, 2020, 1, 5.0), (2, 2020, 2, 7.0)],
                               "branch_id int, year int, month int, salary_per_hour double")
    out = tables.run_sql(spark, "SELECT branch_id FROM rates_view WHERE month = :m",
                         {"rates_view": df}, {"m": 2})
    assert [r.branch_id for r in out.collect()] == [2]


def test_full_refresh_job_on_catalog_tables(spark, scratch):
    folder_e, folder_t = scratch("e"), scratch("t")
    write_text(folder_e, "employees.csv", EMP_CSV)
    write_text(folder_t, "timesheets.csv", TS_CSV)
    root = scratch("catalog")
    for _ in range(2):  # the second run replaces all three tables
        counts = jobs.full_refresh_job(spark, folder_e, folder_t, root, catalog=True)
        assert counts == {"timesheets": 3, "employees": 4, "result": 2}
    assert spark.table("salary_per_hours_a").count() == 2
    for t in ("timesheets", "employees", "salary_per_hours_a"):
        spark.sql(f"DROP VIEW {t}")
        spark.sql(f"DROP TABLE {t}__files")


def test_incremental_job_on_catalog_tables(spark, scratch):
    folder_e, folder_t, more = scratch("e"), scratch("t"), scratch("t2")
    write_text(folder_e, "employees.csv", EMP_CSV)
    write_text(folder_t, "timesheets.csv", TS_CSV)
    write_text(more, "timesheets.csv", "timesheet_id,employee_id,date,checkin,checkout\n"
                                       "4,1,2020-02-03,08:00:00,18:00:00\n5,9,,08:00:00,17:00:00\n")
    wh, names = scratch("wh"), ("timesheets_python", "employees_python", "salary_per_hours_c")
    try:
        jobs.incremental_job(spark, folder_e, folder_t, wh, catalog=True)
        assert [spark.table(n).count() for n in names] == [3, 4, 2]
        jobs.incremental_job(spark, folder_e, more, wh, catalog=True)
        assert [spark.table(n).count() for n in names] == [5, 4, 3]
        for n in names:
            assert sorted(map(str, spark.table(n).collect())) == sorted(
                map(str, tables.read_table(spark, f"{wh}/{n}").collect()))
    finally:
        for n in names:
            spark.sql(f"DROP VIEW IF EXISTS {n}")
            spark.sql(f"DROP TABLE IF EXISTS {n}__files")
