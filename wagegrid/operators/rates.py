"""Pay per worked hour by branch and month (J1, A1-A3, F1-F7 composed).

The workload joins every attendance row to the employee table and then
aggregates per (employee, branch, year, month). At scale that moves every
attendance row through a join. Here the attendance side is aggregated first
per (employee, year, month) -- partial aggregation runs map-side, so a hot
employee collapses to one row per input partition before any shuffle -- and
only the monthly totals are joined to an employee side with one row per
(employee, branch).

This is exact, not an approximation:

* With the latest-record policies the employee side has one row per id, so
  join-then-aggregate equals aggregate-then-join.
* With the raw employee table (policy A) an employee listed ``k`` times in a
  branch multiplies that branch's day count and hour sum by ``k`` and takes
  the minimum salary of those ``k`` rows; the employee side is aggregated to
  (employee_id, branch_id, copies, min salary) and the totals are multiplied.

Durations are summed as BIGINT seconds, so totals do not depend on partition
order; hours are computed once, after the sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pay import (hourly_rate_sql, month_sql, prorated_salary_sql, round_half_up_sql,
                             year_sql)
from ..functions.shift import fill_checkin_sql, fill_checkout_sql, shift_seconds_sql
from ..functions.timeofday import parse_time_sql, seconds_to_hours_sql
from ..policies import Policy, get_policy
from .dedupe import latest_employee


SUM_KEYS = ("employee_id", "year", "month")


def _time_operand(df: DataFrame, name: str, coerce: bool) -> tuple[str, str]:
    """(seconds SQL, raw-missing SQL) for a time column given as text or seconds."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return (parse_time_sql(f"`{name}`", coerce), f"(`{name}` IS NULL OR `{name}` = '')")
    return f"CAST(`{name}` AS BIGINT)", f"`{name}` IS NULL"


def shift_hours(timesheets: DataFrame, policy: Policy | str) -> DataFrame:
    """Per-day rows with filled times and worked seconds.

    Adds ``checkin_new``, ``checkout_new`` (seconds of day) and
    ``work_seconds`` (BIGINT, may be NULL or negative under the rules).
    """
    p = get_policy(policy)
    ci, ci_missing = _time_operand(timesheets, "checkin", p.coerce_times)
    co, co_missing = _time_operand(timesheets, "checkout", p.coerce_times)
    helpers = []
    if isinstance(timesheets.schema["checkin"].dataType, T.StringType) or \
            isinstance(timesheets.schema["checkout"].dataType, T.StringType):
        # parse text once; the rules then refer to the parsed columns
        timesheets = timesheets.selectExpr("*", f"{ci} AS __ci", f"{co} AS __co",
                                           f"{ci_missing} AS __ci_missing",
                                           f"{co_missing} AS __co_missing")
        ci, co, ci_missing, co_missing = "__ci", "__co", "__ci_missing", "__co_missing"
        helpers = [ci, co, ci_missing, co_missing]
    filled = timesheets.selectExpr(
        "*",
        f"{fill_checkin_sql(ci, co, p.fill, ci_missing)} AS checkin_new",
        f"{fill_checkout_sql(ci, co, p.fill, co_missing)} AS checkout_new")
    return filled.selectExpr(
        *[f"`{c}`" for c in filled.columns if c not in helpers],
        f"{shift_seconds_sql('checkin_new', 'checkout_new', p.duration)} AS work_seconds")


def attendance_sums(timesheets: DataFrame, policy: Policy | str) -> DataFrame:
    """(employee_id, year, month, days, work_seconds, counted): sums that add up.

    A row with a NULL employee_id can never match an employee and is dropped
    at the scan. ``days`` counts rows, not distinct dates (as the workload
    does), ``counted`` those whose work_seconds is not NULL.
    """
    p = get_policy(policy)
    cond = "employee_id IS NOT NULL" + (" AND date IS NOT NULL" if p.drop_null_keys else "")
    return (shift_hours(timesheets.filter(cond), p)
            .selectExpr("employee_id", f"{year_sql('date')} AS year",
                        f"{month_sql('date')} AS month", "work_seconds")
            .groupBy(*SUM_KEYS)
            .agg(F.count(F.lit(1)).alias("days"),
                 F.coalesce(F.sum("work_seconds"), F.lit(0)).alias("work_seconds"),
                 F.count("work_seconds").alias("counted")))


def add_sums(sums: DataFrame, more: DataFrame) -> DataFrame:
    """Two results of ``attendance_sums`` over different rows as one."""
    return sums.unionByName(more).groupBy(*SUM_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("days", "work_seconds", "counted")])


def months_of_sums(sums: DataFrame) -> DataFrame:
    """The monthly totals that ``attendance_sums`` stand for: ``work_seconds`` is
    NULL when every day of the month is NULL."""
    return sums.selectExpr(*SUM_KEYS, "days", "IF(counted = 0, NULL, work_seconds) AS work_seconds")


def monthly_attendance(timesheets: DataFrame, policy: Policy | str) -> DataFrame:
    """(employee_id, year, month, days, work_seconds) per employee and month."""
    return months_of_sums(attendance_sums(timesheets, policy))


def payroll_employees(employees: DataFrame, policy: Policy | str) -> DataFrame:
    """(employee_id, branch_id, salary, copies): the employee side of the join.

    Latest-record policies pick one record per id *before* the salary filter
    (a latest record without salary drops the employee); the raw policy keeps
    every record and counts the copies per (employee_id, branch_id).
    """
    p = get_policy(policy)
    resign = "resign_date" if "resign_date" in employees.columns else \
        "CAST(NULL AS DATE) AS resign_date"
    emp = employees.selectExpr("employee_id", "branch_id", "salary", "join_date", resign) \
        .filter("employee_id IS NOT NULL")
    if p.latest_employee is not None:
        emp = latest_employee(emp, nulls_first=(p.latest_employee == "nulls_first"))
    keep = "salary IS NOT NULL"
    if p.drop_zero_salary:
        keep += " AND salary <> 0"
    if p.drop_null_keys:
        keep += " AND branch_id IS NOT NULL"
    emp = emp.filter(keep)
    if p.latest_employee is not None:
        return emp.selectExpr("employee_id", "branch_id", "salary", "1L AS copies")
    return (emp.groupBy("employee_id", "branch_id")
            .agg(F.min("salary").alias("salary"), F.count(F.lit(1)).alias("copies")))


def gross_hours(timesheets: DataFrame, employees: DataFrame, policy: Policy | str) -> DataFrame:
    """A1: total_day, total_hours, salary per (employee, branch, year, month).

    The left join plus salary filter of the workload is an inner join (the
    filter rejects the NULLs the outer side would add).
    """
    return _gross(monthly_attendance(timesheets, policy), payroll_employees(employees, policy))


def _gross(monthly: DataFrame, staff: DataFrame) -> DataFrame:
    return monthly.join(staff, "employee_id", "inner").selectExpr(
        "employee_id", "branch_id", "year", "month",
        "days * copies AS total_day",
        f"{seconds_to_hours_sql('work_seconds * copies')} AS total_hours",
        "salary")


def employee_rates(timesheets: DataFrame, employees: DataFrame, policy: Policy | str) -> DataFrame:
    """F5 + F6: prorated salary and pay per hour per employee and month."""
    return _rates(gross_hours(timesheets, employees, policy))


def _rates(gross: DataFrame) -> DataFrame:
    return (gross.selectExpr("*", f"{prorated_salary_sql('total_day', 'salary')} AS prorated_salary")
             .selectExpr("*", f"{hourly_rate_sql('prorated_salary', 'total_hours')} "
                              "AS salary_per_hour"))


def branch_rates(timesheets: DataFrame, employees: DataFrame, policy: Policy | str) -> DataFrame:
    """A3 (+F7, O1/O4): unweighted mean of employee rates per branch and month.

    ``salary_per_hour`` is DECIMAL(20,2) for the policy that rounds in the
    query and an unrounded DOUBLE otherwise.
    """
    return _branch_means(employee_rates(timesheets, employees, policy), get_policy(policy))


def branch_rates_of_months(monthly: DataFrame, employees: DataFrame,
                           policy: Policy | str) -> DataFrame:
    """``branch_rates`` from monthly totals instead of attendance rows."""
    return _branch_means(_rates(_gross(monthly, payroll_employees(employees, policy))),
                         get_policy(policy))


def _branch_means(rates: DataFrame, p: Policy) -> DataFrame:
    out = rates.groupBy("branch_id", "year", "month").agg(
        F.avg("salary_per_hour").alias("salary_per_hour"))
    value = round_half_up_sql("salary_per_hour", 2) if p.rounding == "query" else "salary_per_hour"
    out = out.selectExpr("CAST(branch_id AS INT) AS branch_id", "year", "month",
                         f"{value} AS salary_per_hour")
    if p.order_by:
        # ASC places NULLs last, as the SQL engine of the workload does.
        out = out.orderBy(*[F.col(c).asc_nulls_last() for c in p.order_by])
    return out

