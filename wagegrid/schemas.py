"""Declared schemas and the fixed values the pay-rate rules depend on.

Times of day are carried as BIGINT seconds since midnight (Spark has no
usable TIME type); dates are DATE; salaries DECIMAL(10,2).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the workload's rules for right results) -------
# Shift landmarks as seconds of day: 08:00:00, 12:00:00, 17:00:00.
MORNING_START = 8 * 3600      # 28800
NOON = 12 * 3600              # 43200
EVENING_END = 17 * 3600       # 61200
# Duration used when no rule applies: 9.0 hours.
DEFAULT_SHIFT_SECONDS = 9 * 3600  # 32400
# Working days per month used for proration: 22; more than 22 days pays the
# full salary, otherwise round(days / 22.0, 2) * salary.
WORKING_DAYS = 22
# Header as spelled in the employee file, and its repaired name.
MISSPELT_EMPLOYEE_ID = "employe_id"
EMPLOYEE_ID = "employee_id"
# ----------------------------------------------------------------------------

SALARY_TYPE = T.DecimalType(10, 2)

# Employee master data, positional order of the file.
EMPLOYEES = T.StructType([
    T.StructField("employee_id", T.LongType(), True),
    T.StructField("branch_id", T.IntegerType(), True),
    T.StructField("salary", SALARY_TYPE, True),
    T.StructField("join_date", T.DateType(), True),
    T.StructField("resign_date", T.DateType(), True),
])

# Attendance as read from text: times stay strings and are parsed at use.
TIMESHEETS_TEXT = T.StructType([
    T.StructField("timesheet_id", T.LongType(), True),
    T.StructField("employee_id", T.LongType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("checkin", T.StringType(), True),
    T.StructField("checkout", T.StringType(), True),
])

# Attendance with times as seconds of day (the working representation).
TIMESHEETS = T.StructType([
    T.StructField("timesheet_id", T.LongType(), True),
    T.StructField("employee_id", T.LongType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("checkin", T.LongType(), True),
    T.StructField("checkout", T.LongType(), True),
])

# Result table of the pay-rate job; (branch_id, year, month) is its key.
RESULT_KEYS = ("branch_id", "year", "month")
RESULT = T.StructType([
    T.StructField("branch_id", T.IntegerType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("salary_per_hour", SALARY_TYPE, True),
])


def ddl(schema: T.StructType) -> str:
    """Column list in DDL form, e.g. for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
