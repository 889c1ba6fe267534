"""Employee and attendance tables derived from the shared test tables.

The driver's test data has no payroll tables, so ``employees`` is derived
from ``customer`` and ``timesheets`` from ``events`` with plain arithmetic
(FIXTURES.md §2). Every customer is an employee and every event an attendance
row; the modulo rules only shape the values (duplicate records and keys,
missing and boundary times, NULL keys, months without hours, attendance
density), so the derived tables grow linearly with the scale factor.
``oracle_views()`` is the same derivation as SQL text for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeofday import format_time_sql, seconds_of_day_sql

DATE_BASE = "2018-01-01"

# Declared types of the source columns the views use (no footer inference;
# only these columns are read).
SOURCE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def employees_from(customer: DataFrame) -> DataFrame:
    """employees(employee_id, branch_id, salary, join_date, resign_date)."""
    # Some ids occur in no attendance row: those are negative.
    who = "CASE WHEN c_custkey % 13 = 7 THEN -c_custkey ELSE c_custkey END AS employee_id"
    branch = "CASE WHEN c_custkey % 19 = 4 THEN NULL ELSE c_nationkey END AS branch_id"
    join_date = f"date_add(DATE'{DATE_BASE}', CAST(c_custkey * 7 % 1000 AS INT))"
    resign = f"CASE WHEN c_custkey % 6 = 0 THEN date_add({join_date}, 400) END AS resign_date"
    first = customer.selectExpr(
        who, branch,
        "CAST(CASE WHEN c_custkey % 17 = 3 THEN NULL WHEN c_custkey % 29 = 5 THEN 0.0D "
        "ELSE round(abs(c_acctbal) * 1000 + 1000000, 0) END AS DECIMAL(10,2)) AS salary",
        f"{join_date} AS join_date", resign)
    copies = customer.filter("c_custkey % 11 = 2").selectExpr(
        who, branch,
        "CAST(round(abs(c_acctbal) * 1000 + 3000000, 0) AS DECIMAL(10,2)) AS salary",
        f"CASE WHEN c_custkey % 4 = 0 THEN CAST(NULL AS DATE) ELSE {join_date} END AS join_date",
        resign)
    return first.unionByName(copies)


def timesheets_with_order(events: DataFrame) -> DataFrame:
    """timesheets plus ``arrival``, an order that differs from that of the keys.

    One row in 50 repeats the key of the row before it and arrives earlier.
    """
    s = seconds_of_day_sql("ts")
    return events.selectExpr(
        "CASE WHEN event_id % 50 = 1 THEN event_id - 1 ELSE event_id END AS timesheet_id",
        "CASE WHEN event_id % 101 = 5 THEN NULL ELSE user_id END AS employee_id",
        "CASE WHEN event_id % 103 = 7 THEN NULL ELSE "
        "date_add(to_date(ts), CAST(31 * (event_id % (1 + user_id % 5)) AS INT)) END AS date",
        # Employees whose every day has no length: months of zero hours.
        "CAST(CASE WHEN user_id % 97 = 3 THEN 36000 "
        "WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 61200 "
        "WHEN event_id % 31 = 0 THEN 0 WHEN event_id % 37 = 0 THEN 43200 "
        f"ELSE {s} END AS BIGINT) AS checkin",
        "CAST(CASE WHEN user_id % 97 = 3 THEN 36000 "
        "WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 28800 "
        "WHEN event_id % 41 = 0 THEN 61200 WHEN event_id % 43 = 0 THEN 0 "
        f"ELSE ({s} + 28800 + event_id * 7919 % 7200) % 86400 END AS BIGINT) AS checkout",
        "CASE WHEN event_id % 2 = 0 THEN event_id ELSE -event_id END AS arrival")


def timesheets_from(events: DataFrame) -> DataFrame:
    """timesheets(timesheet_id, employee_id, date, checkin, checkout), times in seconds."""
    return timesheets_with_order(events).drop("arrival")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees_from(read_table(spark, sf_dir, "customer"))


def timesheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timesheets_from(read_table(spark, sf_dir, "events"))


def ordered_timesheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attendance table with its ``arrival`` order."""
    return timesheets_with_order(read_table(spark, sf_dir, "events"))


def load_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(timesheets, employees) for a test-data folder."""
    return timesheets(spark, sf_dir), employees(spark, sf_dir)


def timesheets_text(ts: DataFrame, pad_hour: bool = True) -> DataFrame:
    """The attendance table with times as ``HH:MM:SS`` text (as read from CSV)."""
    return ts.selectExpr("timesheet_id", "employee_id", "date",
                         f"{format_time_sql('checkin', pad_hour)} AS checkin",
                         f"{format_time_sql('checkout', pad_hour)} AS checkout")


def timesheets_text_odd(ts: DataFrame) -> DataFrame:
    """Times as text of which some are malformed, empty or not padded."""
    def odd(c: str, n: int, empty: bool) -> str:
        blank = f"WHEN timesheet_id % {n} = 5 THEN '' " if empty else ""
        bare = (f"format_string('%d:%d:%d', CAST(floor({c} / 3600) AS INT), "
                f"CAST(floor(({c} % 3600) / 60) AS INT), CAST({c} % 60 AS INT))")
        return (f"CASE WHEN timesheet_id % {n} = 3 THEN 'xx' {blank}"
                f"WHEN timesheet_id % {n} = 7 THEN '24:00:00' "
                f"WHEN timesheet_id % {n} = 9 AND {c} IS NOT NULL THEN {bare} "
                f"ELSE {format_time_sql(c)} END AS {c}")
    return ts.selectExpr("timesheet_id", "employee_id", "date", odd("checkin", 47, True),
                         odd("checkout", 53, False))


# Incremental batches over the attendance table: the stored and the arriving
# batch hold two thirds of the keys each, all together, one third in both; the
# arriving check-ins are moved by one minute. Both contain repeated keys.
def old_batch(ts: DataFrame) -> DataFrame:
    return ts.filter("timesheet_id % 3 <> 1")


def new_batch(ts: DataFrame) -> DataFrame:
    return ts.filter("timesheet_id % 3 <> 0").withColumn(
        "checkin", F.expr("(checkin + 60) % 86400"))


# -- the same derivation as SQL text (DuckDB oracle) --------------------------

EMPLOYEES_SQL = """
customers AS (
  SELECT *, CASE WHEN c_custkey % 13 = 7 THEN -c_custkey ELSE c_custkey END AS employee_id,
         CASE WHEN c_custkey % 19 = 4 THEN NULL ELSE c_nationkey END AS branch_id,
         DATE '2018-01-01' + CAST(c_custkey * 7 % 1000 AS INTEGER) AS joined
  FROM customer
),
employees AS (
  SELECT employee_id, branch_id,
         CAST(CASE WHEN c_custkey % 17 = 3 THEN NULL
                   WHEN c_custkey % 29 = 5 THEN 0
                   ELSE round(abs(c_acctbal) * 1000 + 1000000, 0) END AS DECIMAL(10,2)) AS salary,
         joined AS join_date,
         CASE WHEN c_custkey % 6 = 0 THEN joined + 400 END AS resign_date
  FROM customers
  UNION ALL
  SELECT employee_id, branch_id,
         CAST(round(abs(c_acctbal) * 1000 + 3000000, 0) AS DECIMAL(10,2)),
         CASE WHEN c_custkey % 4 = 0 THEN CAST(NULL AS DATE) ELSE joined END,
         CASE WHEN c_custkey % 6 = 0 THEN joined + 400 END
  FROM customers WHERE c_custkey % 11 = 2
)"""

TIMESHEETS_SQL = """
ev AS (
  SELECT event_id, user_id, ts,
         CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS s
  FROM events
),
timesheets_seq AS (
  SELECT CASE WHEN event_id % 50 = 1 THEN event_id - 1 ELSE event_id END AS timesheet_id,
         CASE WHEN event_id % 101 = 5 THEN NULL ELSE user_id END AS employee_id,
         CASE WHEN event_id % 103 = 7 THEN NULL
              ELSE CAST(ts AS DATE) + CAST(31 * (event_id % (1 + user_id % 5)) AS INTEGER) END AS date,
         CAST(CASE WHEN user_id % 97 = 3 THEN 36000
                   WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 61200
                   WHEN event_id % 31 = 0 THEN 0 WHEN event_id % 37 = 0 THEN 43200
                   ELSE s END AS BIGINT) AS checkin,
         CAST(CASE WHEN user_id % 97 = 3 THEN 36000
                   WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 28800
                   WHEN event_id % 41 = 0 THEN 61200 WHEN event_id % 43 = 0 THEN 0
                   ELSE (s + 28800 + event_id * 7919 % 7200) % 86400 END AS BIGINT) AS checkout,
         CASE WHEN event_id % 2 = 0 THEN event_id ELSE -event_id END AS arrival,
         event_id
  FROM ev
),
timesheets AS (SELECT timesheet_id, employee_id, date, checkin, checkout FROM timesheets_seq)"""

# ``arrival`` orders the frames, ``event_id`` the rows of the CSV files.
BATCHES_SQL = """
old_seq AS (SELECT * FROM timesheets_seq WHERE timesheet_id % 3 <> 1),
new_seq AS (
  SELECT * REPLACE ((checkin + 60) % 86400 AS checkin)
  FROM timesheets_seq WHERE timesheet_id % 3 <> 0),
old_batch AS (SELECT * EXCLUDE (event_id) FROM old_seq),
new_batch AS (SELECT * EXCLUDE (event_id) FROM new_seq)"""

_HMS = "format('{:02d}:{:02d}:{:02d}', %s // 3600, (%s %% 3600) // 60, %s %% 60)"


def _odd_sql(c: str, n: int, empty: bool) -> str:
    blank = f"WHEN timesheet_id % {n} = 5 THEN '' " if empty else ""
    padded, bare = _HMS % (c, c, c), (_HMS % (c, c, c)).replace("02d", "d")
    return (f"CASE WHEN timesheet_id % {n} = 3 THEN 'xx' {blank}"
            f"WHEN timesheet_id % {n} = 7 THEN '24:00:00' "
            f"WHEN timesheet_id % {n} = 9 AND {c} IS NOT NULL THEN {bare} "
            f"WHEN {c} IS NOT NULL THEN {padded} END AS {c}")


# Text times, what a tolerant reading makes of them, and whether the text is
# absent (only absent times are filled).
ODD_SQL = f"""
timesheets_odd AS (
  SELECT timesheet_id, employee_id, date, {_odd_sql("checkin", 47, True)},
         {_odd_sql("checkout", 53, False)},
         CASE WHEN timesheet_id % 47 IN (3, 5, 7) THEN NULL ELSE checkin END AS checkin_value,
         CASE WHEN timesheet_id % 53 IN (3, 7) THEN NULL ELSE checkout END AS checkout_value,
         CASE WHEN timesheet_id % 47 IN (3, 7) THEN false
              ELSE timesheet_id % 47 = 5 OR checkin IS NULL END AS checkin_absent,
         CASE WHEN timesheet_id % 53 IN (3, 7) THEN false ELSE checkout IS NULL END AS checkout_absent
  FROM timesheets)"""


def oracle_views(*extra: str, batches: bool = False, odd: bool = False) -> str:
    """``WITH`` clause defining employees, timesheets (and extra CTEs)."""
    parts = [EMPLOYEES_SQL, TIMESHEETS_SQL]
    if batches:
        parts.append(BATCHES_SQL)
    if odd:
        parts.append(ODD_SQL)
    parts.extend(extra)
    return "WITH " + ",".join(parts) + "\n"
