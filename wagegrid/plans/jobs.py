"""The two batch jobs (Q5 full refresh, Q6 incremental) as one Spark
application each: extract -> transform -> load, no file hop between steps.

Run from a scheduler with e.g.::

    python -m wagegrid.plans.jobs full-refresh \
        --employees s3://.../employees.csv --timesheets s3://.../timesheets/ \
        --warehouse s3://.../warehouse [--result-csv s3://.../out]

(or ``spark-submit wagegrid_job.py ...`` with the package on ``--py-files``).

Stored tables live below ``warehouse``; the result is partitioned by
(year, month). Staging goes to ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.dedupe import latest_employee
from ..operators.rates import (add_sums, attendance_sums, branch_rates, branch_rates_of_months,
                               months_of_sums)
from ..policies import POLICIES, Policy, get_policy
from ..schemas import EMPLOYEES, RESULT, RESULT_KEYS, TIMESHEETS
from ..sources.csv import read_employees_csv, read_timesheets_csv, write_csv
from ..sources import versions
from ..sources.maintained import covered_loads, refresh_state, uncovered_parts
from ..sources.tables import (append_load, cast_to_schema, full_refresh, full_refresh_table,
                              read_table, show_table, stage_append, upsert_load)
from ..sources.versions import Version
from ..functions.timeofday import parse_time

PARTITIONS = ("year", "month")


def _times_as_seconds(ts: DataFrame) -> DataFrame:
    """Strict parse of text times, as a typed TIME column would do on load."""
    return ts.withColumn("checkin", parse_time("checkin")) \
             .withColumn("checkout", parse_time("checkout"))


# The loads each job implements; a policy with another load is refused.
JOB_LOADS = {"full-refresh": ("full_refresh",), "incremental": ("upsert", "append_new_keys")}


def job_policies(job: str) -> list[str]:
    """Names of the policies that ``job`` accepts."""
    return [name for name, p in sorted(POLICIES.items()) if p.load in JOB_LOADS[job]]


def _policy_for(policy: str, job: str) -> Policy:
    p = get_policy(policy)
    if p.load not in JOB_LOADS[job]:
        raise ValueError(f"the {job} job does not load as policy {p.name!r} asks ({p.load}); "
                         f"policies: {', '.join(job_policies(job))}")
    return p


def full_refresh_job(spark: SparkSession, employees_csv: str, timesheets_csv: str,
                     warehouse: str, result_csv: str | None = None,
                     policy: str = "a", catalog: bool = False) -> dict[str, int]:
    """Q5: positional typed scans, full refresh of both sources, transform,
    optional CSV of the result, full refresh of the DECIMAL(10,2) result.

    The three tables are stored below ``warehouse`` (``timesheets``, ``employees``,
    ``salary_per_hours_<policy>``), each replaced by committing a new version. With
    ``catalog`` they are catalog views of the same names, too.
    """
    p = _policy_for(policy, "full-refresh")
    wh = warehouse.rstrip("/")
    emp = read_employees_csv(spark, employees_csv)
    ts = _times_as_seconds(read_timesheets_csv(spark, timesheets_csv))
    result_name = f"salary_per_hours_{p.name}"
    if catalog:
        counts = {
            "timesheets": full_refresh_table(spark, ts, "timesheets", wh, TIMESHEETS),
            "employees": full_refresh_table(spark, emp, "employees", wh, EMPLOYEES),
        }
        result = branch_rates(spark.table("timesheets"), spark.table("employees"), p)
    else:
        counts = {
            "timesheets": full_refresh(spark, ts, f"{wh}/timesheets", TIMESHEETS),
            "employees": full_refresh(spark, emp, f"{wh}/employees", EMPLOYEES),
        }
        result = branch_rates(read_table(spark, f"{wh}/timesheets"),
                              read_table(spark, f"{wh}/employees"), p)
    if catalog:
        counts["result"] = full_refresh_table(spark, result, result_name, wh, RESULT,
                                              partition_by=PARTITIONS)
        stored = spark.table(result_name)
    else:
        counts["result"] = full_refresh(spark, result, f"{wh}/{result_name}", RESULT,
                                        partition_by=PARTITIONS)
        stored = read_table(spark, f"{wh}/{result_name}")
    if result_csv:  # from the loaded table: the pay chain runs once
        write_csv(stored.select(*RESULT.fieldNames()).orderBy(*RESULT_KEYS), result_csv)
    return counts


RESULT_DOUBLE = T.StructType([
    T.StructField("branch_id", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("salary_per_hour", T.DoubleType()),
])


def _month_filter(months: list[tuple[int, int]]) -> str:
    """Predicate on the (year, month) partition columns (prunes whole folders)."""
    return "(year, month) IN (" + ", ".join(f"({y}, {m})" for y, m in sorted(months)) + ")"


def affected_months(new_timesheets: DataFrame | None, new_employees: DataFrame | None,
                    sums: DataFrame) -> list[tuple[int, int]]:
    """(year, month) whose result can change after an append.

    A branch-month result depends only on that month's attendance and on the
    employee records, so it changes when attendance rows were appended to it,
    or when an employee with attendance in it got a new record (which can
    change the latest record, or make unmatched attendance match). The
    second set is looked up in the maintained ``sums`` instead of the attendance.
    The months are bounded by the calendar, so they are taken to the driver.
    """
    found = []
    if new_timesheets is not None:
        found.append(new_timesheets.selectExpr("CAST(year(date) AS INT) AS year",
                                               "CAST(month(date) AS INT) AS month"))
    if new_employees is not None:
        found.append(sums.join(new_employees.select("employee_id").dropDuplicates(), "employee_id",
                               "left_semi").select("year", "month"))
    if not found:
        return []
    return [(r.year, r.month) for r in reduce(DataFrame.unionByName, found)
            .filter("year IS NOT NULL").dropDuplicates().collect()]


def incremental_job(spark: SparkSession, employees_csv: str, timesheets_csv: str,
                    warehouse: str, result_csv: str | None = None,
                    policy: str = "c", catalog: bool = False) -> dict[str, int]:
    """Q6: scans by header name, append-new-keys extract of both sources,
    transform, then keyed upsert (C) or append of new keys (D) of the result.

    Besides the sources and the result two states are maintained, each from the
    loads that came since (see ``sources.maintained``): sums of attendance per
    employee and month (``attendance_sums_<policy>``, by year and month), and the
    latest record per employee (``employees_latest_<policy>``). The result of the
    months an append can change (see ``affected_months``) comes from these two;
    the attendance history is read for the key lookup only. It equals a full
    recomputation.

    The result's version notes the source loads it reflects. A run that fails
    anywhere is completed by simply running it again, and an append that another
    job has made is taken in by the next run.

    With ``catalog`` the stored tables are also catalog views of the same names
    (``timesheets_python``, ``employees_python``, ``salary_per_hours_<policy>``):
    after the load they show the current versions.

    Arrival order inside the CSV files (for keep-last) is taken from the file
    metadata and the row position, see ``sources.csv.arrival_order``.
    """
    p = _policy_for(policy, "incremental")
    wh = warehouse.rstrip("/")
    timesheets, employees = f"{wh}/timesheets_python", f"{wh}/employees_python"
    sums, latest = f"{wh}/attendance_sums_{p.name}", f"{wh}/employees_latest_{p.name}"

    def take_employees() -> tuple[int, Version]:
        rows = read_employees_csv(spark, employees_csv, by_name=True, arrival=True)
        n = stage_append(spark, rows, employees, ["employee_id", "branch_id"], "__arrival").publish()
        return n, refresh_state(spark, employees, latest, lambda rows: _latest(rows, p),
                                lambda stored, more: _latest(stored.unionByName(more), p))

    def take_timesheets() -> tuple[int, Version]:
        rows = read_timesheets_csv(spark, timesheets_csv, by_name=True, arrival=True)
        n = stage_append(spark, rows, timesheets, ["timesheet_id"], "__arrival",
                         cluster_by=("date", "timesheet_id")).publish()
        return n, refresh_state(spark, timesheets, sums, lambda rows: attendance_sums(rows, p),
                                add_sums, PARTITIONS)

    # Neither needs the other, so their Spark jobs run side by side.
    with ThreadPoolExecutor(2) as pool:
        both = [pool.submit(take) for take in (take_employees, take_timesheets)]
    (n_employees, emp_now), (n_timesheets, ts_now) = [x.result() for x in both]
    counts = {"employees": n_employees, "timesheets": n_timesheets}

    target = f"{wh}/salary_per_hours_{p.name}"
    scope, have = read_table(spark, sums), versions.latest(spark, target)
    if have:
        noted = [uncovered_parts(now, have.notes[name]) if name in have.notes else None
                 for name, now in (("timesheets", ts_now), ("employees", emp_now))]
        if None not in noted:  # else the loads cannot tell what is new: everything
            new_ts, new_emp = [versions.read(spark, path, now, parts) if parts else None
                               for path, now, parts in zip((timesheets, employees),
                                                           (ts_now, emp_now), noted)]
            months = affected_months(new_ts, new_emp, scope)
            scope = scope.filter(_month_filter(months)) if months else None

    if scope is None:
        counts["result"] = 0
    else:
        result = cast_to_schema(branch_rates_of_months(
            months_of_sums(scope), read_table(spark, latest), p), RESULT_DOUBLE)
        notes = {"timesheets": covered_loads(ts_now), "employees": covered_loads(emp_now)}
        if p.load == "upsert":
            counts["result"] = upsert_load(spark, result, target, list(RESULT_KEYS),
                                           partition_by=PARTITIONS, notes=notes)
        else:
            counts["result"] = append_load(spark, result, target, list(RESULT_KEYS),
                                           list(RESULT_KEYS), partition_by=PARTITIONS, notes=notes)
    if catalog:
        for name in (f"salary_per_hours_{p.name}", "timesheets_python", "employees_python"):
            show_table(spark, name, f"{wh}/{name}")
    if result_csv:
        # the complete current result, untouched months included
        write_csv(read_table(spark, target).select(*RESULT_DOUBLE.fieldNames())
                  .orderBy(*RESULT_KEYS), result_csv)
    return counts


def _latest(employees: DataFrame, p: Policy) -> DataFrame:
    return latest_employee(employees.filter("employee_id IS NOT NULL"),
                           nulls_first=p.latest_employee == "nulls_first")


def main(argv: list[str] | None = None) -> None:
    from ..config import checkpoint_dir, session

    ap = argparse.ArgumentParser(prog="wagegrid.plans.jobs")
    ap.add_argument("job", choices=["full-refresh", "incremental"])
    ap.add_argument("--employees", required=True)
    ap.add_argument("--timesheets", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--result-csv")
    ap.add_argument("--policy", choices=["a", "b", "c", "d"])
    ap.add_argument("--catalog", action="store_true",
                    help="keep the stored tables as catalog tables, too")
    a = ap.parse_args(argv)
    if a.policy and a.policy not in job_policies(a.job):
        ap.error(f"{a.job} accepts the policies {', '.join(job_policies(a.job))}")
    spark = session()
    checkpoint_dir(spark)  # fail early when no shared folder is configured
    if a.job == "full-refresh":
        out = full_refresh_job(spark, a.employees, a.timesheets, a.warehouse,
                               a.result_csv, a.policy or "a", catalog=a.catalog)
    else:
        out = incremental_job(spark, a.employees, a.timesheets, a.warehouse,
                              a.result_csv, a.policy or "c", catalog=a.catalog)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
