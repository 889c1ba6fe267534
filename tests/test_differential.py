"""Random small tables: Spark's plan (aggregate, then join) against the
oracle SQL (join every row, then aggregate) run by DuckDB on the same rows."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle_harness import canon_rows
from wagegrid.functions.pay import round_double_sql
from wagegrid.operators.rates import branch_rates
from wagegrid.plans.oracle import policy_ctes
from wagegrid.schemas import EMPLOYEES, TIMESHEETS

TIMES = [0, 28799, 28800, 28801, 43199, 43200, 43201, 61199, 61200, 61201, 86399]
DATES = [dt.date(2020, 1, 31), dt.date(2020, 2, 1), dt.date(2020, 2, 29), dt.date(2021, 2, 1)]

time_value = st.one_of(st.none(), st.sampled_from(TIMES), st.integers(0, 86399))
timesheet = st.tuples(st.one_of(st.none(), st.integers(1, 5)),            # employee_id
                      st.one_of(st.none(), st.sampled_from(DATES)),      # date
                      time_value, time_value)
employee = st.tuples(st.integers(1, 5),
                     st.one_of(st.none(), st.integers(1, 2)),             # branch_id
                     st.one_of(st.none(), st.just(Decimal("0.00")),
                               st.integers(1, 90).map(lambda k: Decimal(k * 100000))),
                     st.one_of(st.none(), st.sampled_from(DATES)))        # join_date

ARROW_TS = pa.schema([("timesheet_id", pa.int64()), ("employee_id", pa.int64()),
                      ("date", pa.date32()), ("checkin", pa.int64()), ("checkout", pa.int64())])
ARROW_EMP = pa.schema([("employee_id", pa.int64()), ("branch_id", pa.int32()),
                       ("salary", pa.decimal128(10, 2)), ("join_date", pa.date32()),
                       ("resign_date", pa.date32())])


def oracle(policy: str, ts_rows, emp_rows):
    con = duckdb.connect()
    con.register("timesheets", pa.Table.from_pylist(
        [dict(zip(ARROW_TS.names, r)) for r in ts_rows], schema=ARROW_TS))
    con.register("employees", pa.Table.from_pylist(
        [dict(zip(ARROW_EMP.names, r)) for r in emp_rows], schema=ARROW_EMP))
    if policy == "a":
        value = "CAST(ROUND(CAST(AVG(salary_per_hour) AS DECIMAL(38,10)), 2) AS DECIMAL(20,2))"
    else:
        value = "(ROUND(AVG(salary_per_hour), 6) + 0.0)"
    sql = ("WITH " + policy_ctes(policy).lstrip(",\n")
           + f"SELECT CAST(branch_id AS INTEGER) AS branch_id, year, month, {value} AS salary_per_hour "
             "FROM rates GROUP BY branch_id, year, month")
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


@pytest.mark.parametrize("policy", ["a", "b", "c"])
@settings(max_examples=int(os.environ.get("DIFF_EXAMPLES", "12")), deadline=None, suppress_health_check=list(HealthCheck))
@given(ts=st.lists(timesheet, min_size=1, max_size=30), emp=st.lists(employee, min_size=1, max_size=8))
def test_branch_rates_equal_join_then_aggregate(spark, policy, ts, emp):
    ts_rows = [(i + 1, *r) for i, r in enumerate(ts)]
    emp_rows = [(*r, None) for r in emp]
    out = branch_rates(spark.createDataFrame(ts_rows, TIMESHEETS),
                       spark.createDataFrame(emp_rows, EMPLOYEES), policy)
    if policy != "a":
        out = out.selectExpr("branch_id", "year", "month",
                             f"{round_double_sql('salary_per_hour')} AS salary_per_hour")
    got = canon_rows(out.columns, [tuple(r) for r in out.collect()])
    want = canon_rows(*oracle(policy, ts_rows, emp_rows))
    assert got == want


key_row = st.tuples(st.one_of(st.none(), st.integers(1, 6)), st.integers(0, 9))


@settings(max_examples=int(os.environ.get("DIFF_EXAMPLES", "12")), deadline=None,
          suppress_health_check=list(HealthCheck))
@given(old=st.lists(key_row, max_size=12), new=st.lists(key_row, min_size=1, max_size=12))
def test_append_and_upsert_equal_sql(spark, old, new):
    """NULL keys, duplicate keys inside a batch; seq orders arrival."""
    from wagegrid.operators.merge import append_new_keys, upsert
    old_rows = [(k, v, i) for i, (k, v) in enumerate(old)]
    new_rows = [(k, v, i) for i, (k, v) in enumerate(new)]
    schema = "k long, v long, seq long"
    o = spark.createDataFrame(old_rows, schema)
    n = spark.createDataFrame(new_rows, schema)
    con = duckdb.connect()
    arrow = pa.schema([("k", pa.int64()), ("v", pa.int64()), ("seq", pa.int64())])
    con.register("old_t", pa.Table.from_pylist([dict(zip(arrow.names, r)) for r in old_rows], schema=arrow))
    con.register("new_t", pa.Table.from_pylist([dict(zip(arrow.names, r)) for r in new_rows], schema=arrow))
    append_sql = """
      SELECT n.k, n.v, n.seq
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY seq DESC) rn FROM new_t) n
      WHERE n.rn = 1 AND NOT EXISTS (SELECT 1 FROM old_t o WHERE o.k IS NOT DISTINCT FROM n.k)"""
    upsert_sql = """
      SELECT k, v, seq FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY src DESC, seq DESC) rn
        FROM (SELECT *, 0 AS src FROM old_t UNION ALL SELECT *, 1 AS src FROM new_t))
      WHERE rn = 1"""
    for df, sql in [(append_new_keys(n, o, "k", "seq"), append_sql), (upsert(o, n, "k", "seq"), upsert_sql)]:
        res = con.execute(sql)
        want = canon_rows([d[0] for d in res.description], res.fetchall())
        got = canon_rows(df.columns, [tuple(r) for r in df.collect()])
        assert got == want, sql
