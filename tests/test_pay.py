"""Hand goldens and properties of the pay-per-hour chain."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wagegrid.operators.rates import branch_rates, employee_rates, gross_hours
from wagegrid.schemas import EMPLOYEES, TIMESHEETS

D = dt.date


def frames(spark, ts_rows, emp_rows):
    return spark.createDataFrame(ts_rows, TIMESHEETS), spark.createDataFrame(emp_rows, EMPLOYEES)


def one_shift(days, ci=28800, co=61200, emp=1, start=1):
    return [(start + i, emp, D(2020, 3, 1 + i), ci, co) for i in range(days)]


@pytest.mark.parametrize("policy", ["a", "b", "c"])
def test_golden_single_day(spark, policy):
    ts, emp = frames(spark, one_shift(1), [(1, 7, Decimal("2200000.00"), D(2019, 1, 1), None)])
    r = employee_rates(ts, emp, policy).collect()[0]
    assert r.total_day == 1 and r.total_hours == 9.0
    assert r.prorated_salary == Decimal("110000.0000")
    assert round(r.salary_per_hour, 2) == 12222.22
    out = branch_rates(ts, emp, policy).collect()[0]
    assert (out.branch_id, out.year, out.month) == (7, 2020, 3)
    assert round(float(out.salary_per_hour), 2) == 12222.22


@pytest.mark.parametrize("days", [22, 23])
def test_full_salary_from_22_days(spark, days):
    ts, emp = frames(spark, one_shift(days), [(1, 1, Decimal("2200000.00"), D(2019, 1, 1), None)])
    r = employee_rates(ts, emp, "a").collect()[0]
    assert r.prorated_salary == Decimal("2200000.0000")


def test_raw_duplicates_double_days_in_a(spark):
    emp = [(1, 1, Decimal("4321000.00"), D(2019, 5, 6), D(2021, 2, 3)),
           (1, 1, Decimal("8765000.00"), D(2019, 5, 6), D(2021, 2, 3))]
    ts, e = frames(spark, one_shift(3), emp)
    a = gross_hours(ts, e, "a").collect()[0]
    assert (a.total_day, a.total_hours, a.salary) == (6, 54.0, Decimal("4321000.00"))
    for p in ("b", "c"):
        g = gross_hours(ts, e, p).collect()[0]
        assert (g.total_day, g.total_hours, g.salary) == (3, 27.0, Decimal("8765000.00"))


def test_zero_and_null_hours_give_null_rate(spark):
    # Employee 1: in 08:00 out 08:00 -> 0 h (zero division -> NULL rate).
    # Employee 2 (rule A): out missing, in exactly 08:00 -> NULL duration.
    ts_rows = [(1, 1, D(2020, 1, 2), 28800, 28800), (2, 2, D(2020, 1, 2), 28800, None)]
    emp_rows = [(1, 5, Decimal("1000.00"), D(2019, 1, 1), None),
                (2, 5, Decimal("1000.00"), D(2019, 1, 1), None)]
    ts, emp = frames(spark, ts_rows, emp_rows)
    rates = {r.employee_id: r for r in employee_rates(ts, emp, "a").collect()}
    assert rates[1].total_hours == 0.0 and rates[1].salary_per_hour is None
    assert rates[2].total_hours is None and rates[2].salary_per_hour is None
    out = branch_rates(ts, emp, "a").collect()
    assert len(out) == 1 and out[0].salary_per_hour is None


def test_salary_zero_and_null_keys(spark):
    ts_rows = [(1, 1, D(2020, 1, 2), 28800, 61200), (2, 2, D(2020, 1, 2), 28800, 61200),
               (3, 3, None, 28800, 61200)]
    emp_rows = [(1, 5, Decimal("0.00"), D(2019, 1, 1), None),
                (2, None, Decimal("1000.00"), D(2019, 1, 1), None),
                (3, 5, Decimal("1000.00"), D(2019, 1, 1), None)]
    ts, emp = frames(spark, ts_rows, emp_rows)
    a = {(r.branch_id, r.year) for r in branch_rates(ts, emp, "a").collect()}
    assert a == {(5, 2020), (None, 2020), (5, None)}
    c = branch_rates(ts, emp, "c").collect()
    assert c == []


def test_latest_record_without_salary_drops_employee_in_b(spark):
    emp = [(1, 1, None, D(2021, 1, 1), None), (1, 1, Decimal("5000.00"), D(2020, 1, 1), None)]
    ts, e = frames(spark, one_shift(2), emp)
    assert gross_hours(ts, e, "b").count() == 0
    assert gross_hours(ts, e, "c").count() == 0
    assert gross_hours(ts, e, "a").collect()[0].salary == Decimal("5000.00")


clean_employee = st.tuples(st.integers(0, 3), st.integers(1, 500).map(lambda k: k * 10000))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(clean_employee, st.integers(1, 28)), min_size=1, max_size=6))
def test_policies_agree_on_clean_data(spark, staff):
    """Unique employees, non-zero salaries, 08:00 -> 17:00: A = B = C."""
    emp_rows, ts_rows, tid = [], [], 1
    for eid, ((branch, salary), days) in enumerate(staff, start=1):
        emp_rows.append((eid, branch, Decimal(salary), D(2019, 1, 1), None))
        ts_rows += one_shift(days, emp=eid, start=tid)
        tid += days
    ts, emp = frames(spark, ts_rows, emp_rows)
    results = []
    for p in ("a", "b", "c"):
        rows = branch_rates(ts, emp, p).collect()
        results.append({(r.branch_id, r.year, r.month): float(r.salary_per_hour) for r in rows})
    assert results[0].keys() == results[1].keys() == results[2].keys()
    for k, a in results[0].items():
        # A is rounded to 2 places in the query, B and C are not.
        assert abs(results[1][k] - results[2][k]) < 1e-6
        assert abs(a - results[1][k]) <= 0.005 + 1e-9


def test_negative_hours_give_negative_rate_and_count_in_the_mean(spark):
    # Rule A: in 16:59:59, out 00:00:00 -> out - in = -61199 s; the rate is
    # negative and still averaged with the other employee of the branch.
    ts_rows = [(1, 1, D(2020, 1, 2), 61199, 0), (2, 2, D(2020, 1, 2), 28800, 61200)]
    emp_rows = [(1, 5, Decimal("2200000.00"), D(2019, 1, 1), None),
                (2, 5, Decimal("2200000.00"), D(2019, 1, 1), None)]
    ts, emp = frames(spark, ts_rows, emp_rows)
    rates = {r.employee_id: r.salary_per_hour for r in employee_rates(ts, emp, "a").collect()}
    assert rates[1] == pytest.approx(110000 / (-61199 / 3600))
    assert rates[2] == pytest.approx(110000 / 9)
    out = branch_rates(ts, emp, "a").collect()[0]
    want = Decimal(str(round((rates[1] + rates[2]) / 2, 2)))
    assert out.salary_per_hour == want
