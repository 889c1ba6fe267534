"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the whole test tables of ``sf_dir`` (through the derived
employee and attendance views, ``sources.testdata``) and returns a
DataFrame whose column names equal those of the matching oracle SQL.
Unrounded DOUBLE results are reported at 6 places so that summation order
cannot change them. Queries that exercise sinks write below the shared
checkpoint folder and return the re-read table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from ..functions.pay import round_double
from ..functions.timeofday import parse_time, seconds_of_day
from ..operators import dedupe, merge, quality, rates
from ..operators.spread import left_join_spread
from ..schemas import EMPLOYEES, RESULT
from ..sources import csv as csv_io
from ..sources import keyindex, maintained, tables, testdata
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return register


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _tables(spark: SparkSession, sf_dir: str):
    return testdata.load_tables(spark, sf_dir)


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, round_double(c))
    return df


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


# -- Q1-Q3: pay per hour by branch and month -----------------------------------

@query("branch_rate_a")
def branch_rate_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 (flagship): rule set A, DECIMAL rounded to 2 places, ordered."""
    ts, emp = _tables(spark, sf_dir)
    return rates.branch_rates(ts, emp, "a")


@query("branch_rate_b")
def branch_rate_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: rule set B (latest employee record, NULLs first; unrounded)."""
    ts, emp = _tables(spark, sf_dir)
    return _rounded(rates.branch_rates(ts, emp, "b"), "salary_per_hour")


@query("branch_rate_c")
def branch_rate_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: rule set C = D (NULLs last, zero salaries and NULL keys dropped)."""
    ts, emp = _tables(spark, sf_dir)
    return _rounded(rates.branch_rates(ts, emp, "c"), "salary_per_hour")


# -- per-step queries (F1-F6, A1, J1, W1/W2) -----------------------------------

def _fill(spark: SparkSession, sf_dir: str, policy: str, text: bool = False) -> DataFrame:
    ts, _ = _tables(spark, sf_dir)
    if text:
        ts = testdata.timesheets_text_odd(ts)
    return (rates.shift_hours(ts, policy)
            .select("timesheet_id", "employee_id", "date", "checkin_new", "checkout_new"))


@query("fill_times_a")
def fill_times_a(spark, sf_dir):
    return _fill(spark, sf_dir, "a")


@query("fill_times_b")
def fill_times_b(spark, sf_dir):
    return _fill(spark, sf_dir, "b")


@query("fill_times_c")
def fill_times_c(spark, sf_dir):
    """Rule set C reads times as text (some malformed), parsed with coercion."""
    return _fill(spark, sf_dir, "c", text=True)


def _shift(spark: SparkSession, sf_dir: str, policy: str, text: bool = False) -> DataFrame:
    ts, _ = _tables(spark, sf_dir)
    if text:
        ts = testdata.timesheets_text_odd(ts)
    return _rounded(
        rates.shift_hours(ts, policy).select(
            "timesheet_id", "employee_id", "date", "work_seconds",
            F.expr("work_seconds / 3600.0D").alias("total_hours")),
        "total_hours")


@query("shift_hours_a")
def shift_hours_a(spark, sf_dir):
    return _shift(spark, sf_dir, "a")


@query("shift_hours_b")
def shift_hours_b(spark, sf_dir):
    return _shift(spark, sf_dir, "b")


@query("shift_hours_c")
def shift_hours_c(spark, sf_dir):
    return _shift(spark, sf_dir, "c", text=True)


def _gross(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    ts, emp = _tables(spark, sf_dir)
    return _rounded(rates.gross_hours(ts, emp, policy), "total_hours")


@query("gross_hours_a")
def gross_hours_a(spark, sf_dir):
    return _gross(spark, sf_dir, "a")


@query("gross_hours_b")
def gross_hours_b(spark, sf_dir):
    return _gross(spark, sf_dir, "b")


@query("gross_hours_c")
def gross_hours_c(spark, sf_dir):
    return _gross(spark, sf_dir, "c")


@query("prorated_salary")
def prorated_salary_q(spark, sf_dir):
    ts, emp = _tables(spark, sf_dir)
    return rates.employee_rates(ts, emp, "a").select(
        "employee_id", "branch_id", "year", "month", "total_day", "salary", "prorated_salary")


def _employee_rate(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    ts, emp = _tables(spark, sf_dir)
    return _rounded(rates.employee_rates(ts, emp, policy), "total_hours", "salary_per_hour")


@query("employee_rate_a")
def employee_rate_a(spark, sf_dir):
    return _employee_rate(spark, sf_dir, "a")


@query("employee_rate_b")
def employee_rate_b(spark, sf_dir):
    return _employee_rate(spark, sf_dir, "b")


@query("employee_rate_c")
def employee_rate_c(spark, sf_dir):
    return _employee_rate(spark, sf_dir, "c")


@query("dedupe_employees_nulls_first")
def dedupe_employees_nulls_first(spark, sf_dir):
    """Latest record per employee, NULL dates/salaries first."""
    return dedupe.latest_employee(testdata.employees(spark, sf_dir), nulls_first=True)


@query("dedupe_employees_nulls_last")
def dedupe_employees_nulls_last(spark, sf_dir):
    """Latest record per employee, NULL dates/salaries last."""
    return dedupe.latest_employee(testdata.employees(spark, sf_dir), nulls_first=False)


def _join_left(ts: DataFrame, emp: DataFrame) -> DataFrame:
    return (left_join_spread(ts, emp.select("employee_id", "branch_id", "salary"), "employee_id")
            .select("timesheet_id", "employee_id", "date", "branch_id", "salary"))


@query("join_left_raw")
def join_left_raw(spark, sf_dir):
    """J1 against the raw employee table (a duplicated id doubles its rows)."""
    ts, emp = _tables(spark, sf_dir)
    return _join_left(ts, emp)


@query("join_left_deduped")
def join_left_deduped(spark, sf_dir):
    """J1 against the latest employee records."""
    ts, emp = _tables(spark, sf_dir)
    return _join_left(ts, dedupe.latest_employee(emp, nulls_first=True))


# -- quality checks (A4-A6, P2, P3, P8, P9, O3) ----------------------------------

@query("dup_check_timesheets")
def dup_check_timesheets(spark, sf_dir):
    ts, _ = _tables(spark, sf_dir)
    return quality.duplicate_check(ts, "timesheet_id", "raw_timesheet_id", "unique_timesheet_id")


@query("dup_check_employees")
def dup_check_employees(spark, sf_dir):
    emp = testdata.employees(spark, sf_dir)
    return quality.duplicate_check(emp, "employee_id", "raw_total_employee",
                                   "unique_total_employee")


@query("checkin_range")
def checkin_range(spark, sf_dir):
    ts, _ = _tables(spark, sf_dir)
    return quality.checkin_range(ts)


@query("missing_either")
def missing_either(spark, sf_dir):
    ts, _ = _tables(spark, sf_dir)
    return quality.missing_either(ts)


@query("missing_either_top5")
def missing_either_top5(spark, sf_dir):
    ts, _ = _tables(spark, sf_dir)
    return quality.first_rows(quality.missing_either(ts), ["timesheet_id"], 5)


@query("missing_both")
def missing_both(spark, sf_dir):
    ts, _ = _tables(spark, sf_dir)
    return quality.missing_both(ts)


@query("missing_flags")
def missing_flags(spark, sf_dir):
    ts, _ = _tables(spark, sf_dir)
    return quality.missing_flags(ts)


@query("quality_report")
def quality_report(spark, sf_dir):
    ts, emp = _tables(spark, sf_dir)
    return quality.quality_report(ts, emp)


def _odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.timesheets_text_odd(testdata.timesheets(spark, sf_dir))


@query("missing_either_text")
def missing_either_text(spark, sf_dir):
    """P2 over text times: a check-in that does not parse counts as missing."""
    return quality.missing_either(_odd(spark, sf_dir), coerce_checkin=True)


@query("missing_both_text")
def missing_both_text(spark, sf_dir):
    return quality.missing_both(_odd(spark, sf_dir), coerce_checkin=True)


@query("missing_flags_text")
def missing_flags_text(spark, sf_dir):
    return quality.missing_flags(_odd(spark, sf_dir), coerce_checkin=True)


@query("quality_report_text")
def quality_report_text(spark, sf_dir):
    return quality.quality_report(_odd(spark, sf_dir), testdata.employees(spark, sf_dir),
                                  coerce_checkin=True)


@query("describe_timesheets")
def describe_timesheets(spark, sf_dir):
    """A6 over the raw attendance columns."""
    ts, _ = _tables(spark, sf_dir)
    out = quality.describe(ts, ["timesheet_id", "employee_id", "checkin", "checkout"])
    return _rounded(out, *quality.DESCRIBE_STATS[1:])


@query("describe_rates")
def describe_rates(spark, sf_dir):
    """A6 over the rule-set-B result (as the notebook validates it)."""
    ts, emp = _tables(spark, sf_dir)
    result = rates.branch_rates(ts, emp, "b")
    out = quality.describe(result, ["branch_id", "year", "month", "salary_per_hour"])
    return _rounded(out, *quality.DESCRIBE_STATS[1:])


@query("sort_employees")
def sort_employees(spark, sf_dir):
    """O2: employees by join_date DESC, salary DESC (NULLs last).

    employee_id and branch_id are appended as tie-breakers: rows with equal
    sort keys could otherwise not be split across range partitions, so a
    date shared by a third of all rows would land in one task.
    """
    emp = testdata.employees(spark, sf_dir)
    return emp.orderBy(F.col("join_date").desc_nulls_last(), F.col("salary").desc_nulls_last(),
                       "employee_id", "branch_id")


# -- set operations and incremental loads (U1-U3, W3, S9, S13, S14, S16) ----------

def _batches(spark: SparkSession, sf_dir: str):
    ts = testdata.ordered_timesheets(spark, sf_dir)
    return testdata.old_batch(ts), testdata.new_batch(ts)


@query("union_all_sources")
def union_all_sources(spark, sf_dir):
    """Each side lacks a column of the other."""
    old, new = _batches(spark, sf_dir)
    return merge.union_all(old.drop("date"), new.drop("checkout"))


@query("distinct_rates")
def distinct_rates(spark, sf_dir):
    """Whole-row distinct of the rule-set-B result stacked on itself."""
    result = branch_rate_b(spark, sf_dir)
    return merge.distinct_rows(merge.union_all(result, result))


@query("keep_last")
def keep_last(spark, sf_dir):
    """Last attendance row per employee in arrival order."""
    return dedupe.keep_last(testdata.ordered_timesheets(spark, sf_dir), "employee_id", "arrival")


@query("append_new_keys")
def append_new_keys(spark, sf_dir):
    old, new = _batches(spark, sf_dir)
    return merge.append_new_keys(new, old, "timesheet_id", "arrival")


@query("append_key_list")
def append_key_list(spark, sf_dir):
    """A list of one key gives what the scalar key gives."""
    old, new = _batches(spark, sf_dir)
    return merge.append_new_keys(new, old, ["timesheet_id"], ["arrival"])


@query("key_check_flags")
def key_check_flags(spark, sf_dir):
    """Which keys can be validated over the two batches, and the values that
    each batch has of them."""
    old, new = _batches(spark, sf_dir)
    old, new = old.drop("date"), new.drop("checkout")

    def check(key: str) -> DataFrame:
        try:
            merge.validate_keys(new, old, key)
            valid = True
        except KeyError:
            valid = False

        def values(side: DataFrame, name: str) -> DataFrame:
            n = F.count_distinct(key) if key in side.columns else F.lit(None).cast("bigint")
            return side.agg(F.lit(key).alias("key"), F.lit(valid).alias("valid"), n.alias(name))
        return values(old, "stored_values").join(values(new, "arriving_values"), ["key", "valid"])
    return reduce(DataFrame.unionByName, [
        check(k) for k in ("timesheet_id", "employee_id", "date", "checkout")])


@query("ensure_table_schema")
def ensure_table_schema(spark, sf_dir):
    """Rows loaded into a table that was created from the declared schema."""
    name, place = f"wagegrid_ensured_{uuid.uuid4().hex}", _scratch(spark, "ensured")
    tables.ensure_table(spark, name, RESULT, location=place)
    tables.ensure_table(spark, name, RESULT)  # a second call changes nothing
    ts, emp = _tables(spark, sf_dir)
    tables.cast_to_schema(rates.branch_rates(ts, emp, "a"), RESULT).write.insertInto(name)
    stored = spark.table(name)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema.fields)
    out = spark.read.schema(stored.schema).parquet(place).withColumn("columns", F.lit(kinds))
    spark.sql(f"DROP TABLE {name}")  # external: the rows stay for the result
    return out


@query("table_exists_flags")
def table_exists_flags(spark, sf_dir):
    """The probes before and after a load, with the rows it stored."""
    emp, target = testdata.employees(spark, sf_dir), _scratch(spark, "probed")
    name = f"wagegrid_probed_{uuid.uuid4().hex}"
    before = tables.path_exists(spark, target), tables.table_exists(spark, name)
    tables.first_load(spark, emp, target)
    tables.ensure_table(spark, name, EMPLOYEES, location=tables.table_folder(spark, target))
    after = tables.path_exists(spark, target), tables.table_exists(spark, name)
    spark.sql(f"DROP TABLE {name}")
    flags = dict(zip(("folder_before", "table_before", "folder_after", "table_after"),
                     before + after))
    return tables.read_table(spark, target).agg(
        *[F.lit(v).alias(k) for k, v in flags.items()], F.count("*").alias("n_rows"))


@query("upsert_partitioned")
def upsert_partitioned(spark, sf_dir):
    """S14 into a table partitioned by date, in two loads: arriving rows without a
    date (one partition is rewritten, the others stay as they are), then the rest."""
    old, new = _batches(spark, sf_dir)
    target, keys = _scratch(spark, "upserted"), ["date", "timesheet_id"]
    tables.first_load(spark, dedupe.keep_last(old, keys, "arrival"), target, ["date"])
    for rows in (new.where("date IS NULL"), new.where("date IS NOT NULL")):
        tables.upsert_load(spark, rows, target, keys, "arrival", partition_by=["date"])
    return tables.read_table(spark, target).select(*old.columns)


@query("upsert_partitioned_whole")
def upsert_partitioned_whole(spark, sf_dir):
    """S14 into a table partitioned by date: every arriving row."""
    old, new = _batches(spark, sf_dir)
    target, keys = _scratch(spark, "upserted"), ["date", "timesheet_id"]
    tables.first_load(spark, dedupe.keep_last(old, keys, "arrival"), target, ["date"])
    tables.upsert_load(spark, new, target, keys, "arrival", partition_by=["date"])
    return tables.read_table(spark, target).select(*old.columns)


@query("upsert_keep_last")
def upsert_keep_last(spark, sf_dir):
    old, new = _batches(spark, sf_dir)
    return merge.upsert(old, new, "timesheet_id", "arrival")


@query("load_counts")
def load_counts(spark, sf_dir):
    old, new = _batches(spark, sf_dir)
    return merge.load_counts(new, old, "timesheet_id", "arrival")


@query("incremental_first_load")
def incremental_first_load(spark, sf_dir):
    """The first load stores all attendance as it is, repeated keys too."""
    target = _scratch(spark, "first-load")
    tables.first_load(spark, testdata.ordered_timesheets(spark, sf_dir), target)
    return tables.read_table(spark, target)


@query("upsert_new_column")
def upsert_new_column(spark, sf_dir):
    """The arriving rows bring a column the stored table lacks."""
    old, new = _batches(spark, sf_dir)
    target = _scratch(spark, "upserted")
    tables.first_load(spark, old.drop("checkout"), target)
    tables.upsert_load(spark, new, target, "timesheet_id", "arrival")
    return tables.read_table(spark, target)


@query("append_absent_column")
def append_absent_column(spark, sf_dir):
    """The arriving rows lack a column that is stored."""
    old, new = _batches(spark, sf_dir)
    target = _scratch(spark, "appended")
    tables.first_load(spark, old, target)
    tables.append_load(spark, new.drop("checkout"), target, "timesheet_id", "arrival")
    return tables.read_table(spark, target)


@query("maintained_attendance")
def maintained_attendance(spark, sf_dir):
    """A1 as maintained sums: after the arriving batch only its rows are added."""
    source, target = _scratch(spark, "attendance"), _scratch(spark, "sums")
    for batch in _batches(spark, sf_dir):
        tables.append_load(spark, batch, source, "timesheet_id", "arrival")
        maintained.refresh_state(spark, source, target,
                                 lambda rows: rates.attendance_sums(rows, "c"), rates.add_sums,
                                 jobs.PARTITIONS)
    return tables.read_table(spark, target)


def _maintained_latest(spark: SparkSession, sf_dir: str, nulls_first: bool) -> DataFrame:
    """Employee records in two deliveries, the latest record kept after each."""
    source, target = _scratch(spark, "employees"), _scratch(spark, "latest")
    emp = testdata.employees(spark, sf_dir)
    early = "coalesce(salary, 0) < 3000000"

    def latest(rows: DataFrame) -> DataFrame:
        return dedupe.latest_employee(rows, nulls_first)
    for batch in (emp.where(early), emp.where(f"NOT ({early})")):
        tables.append_load(spark, batch, source, emp.columns, "employee_id")
        maintained.refresh_state(spark, source, target, latest,
                                 lambda stored, more: latest(stored.unionByName(more)))
    return tables.read_table(spark, target)


@query("maintained_latest_nulls_first")
def maintained_latest_nulls_first(spark, sf_dir):
    """W1 as a maintained table."""
    return _maintained_latest(spark, sf_dir, nulls_first=True)


@query("maintained_latest_nulls_last")
def maintained_latest_nulls_last(spark, sf_dir):
    """W2 as a maintained table."""
    return _maintained_latest(spark, sf_dir, nulls_first=False)


@query("append_indexed")
def append_indexed(spark, sf_dir):
    """S13/J3 with the key index: only files that may hold an arriving key are scanned."""
    target, index = _scratch(spark, "appended"), _scratch(spark, "appended-keys")
    for batch in _batches(spark, sf_dir):
        keyindex.append_indexed(spark, batch, target, "timesheet_id", "arrival", index,
                                cluster_by=["date", "timesheet_id"]).publish()
    return tables.read_table(spark, target)


@query("compact_appends")
def compact_appends(spark, sf_dir):
    """S13 + S6: a first load and two appends, whose small files are then merged."""
    ts, target = testdata.ordered_timesheets(spark, sf_dir), _scratch(spark, "compacted")
    for k in range(3):
        tables.append_load(spark, ts.where(f"pmod(timesheet_id, 3) = {k}"), target, "timesheet_id",
                           "arrival")
    tables.compact(spark, target, cluster_by=["date", "timesheet_id"])
    return tables.read_table(spark, target)


@query("catalog_refresh")
def catalog_refresh(spark, sf_dir):
    """S10 for a catalog table: refreshed twice, read through its view."""
    ts, emp = _tables(spark, sf_dir)
    name, root = f"wagegrid_refreshed_{uuid.uuid4().hex}", _scratch(spark, "catalog")
    for policy in ("b", "a"):
        tables.full_refresh_table(spark, rates.branch_rates(ts, emp, policy), name, root, RESULT,
                                  partition_by=jobs.PARTITIONS)
    shown, _ = tables.stage(spark, spark.table(name), "catalog-read")
    spark.sql(f"DROP VIEW {name}")
    spark.sql(f"DROP TABLE {name}__files")
    return shown


# -- scans, sinks and loads (S1-S3, S6, S10-S12, P1) -------------------------------

def _employees_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the employee view as CSV with the misspelt header; return its folder."""
    path = _scratch(spark, "employees-csv")
    emp = testdata.employees(spark, sf_dir).withColumnRenamed("employee_id", "employe_id")
    csv_io.write_csv(emp, path)
    return path


def _timesheets_csv(spark: SparkSession, sf_dir: str) -> str:
    path = _scratch(spark, "timesheets-csv")
    ts, _ = _tables(spark, sf_dir)
    csv_io.write_csv(testdata.timesheets_text(ts), path)
    return path


@query("scan_employees")
def scan_employees(spark, sf_dir):
    """Positional typed CSV scan (the header, misspelt or not, is skipped)."""
    return csv_io.read_employees_csv(spark, _employees_csv(spark, sf_dir))


@query("scan_timesheets")
def scan_timesheets(spark, sf_dir):
    """S1 + F8: positional scan, text times parsed strictly to seconds."""
    df = csv_io.read_timesheets_csv(spark, _timesheets_csv(spark, sf_dir))
    return df.withColumn("checkin", parse_time("checkin")) \
             .withColumn("checkout", parse_time("checkout"))


@query("rename_header")
def rename_header(spark, sf_dir):
    """S2 + S3: scan by header name with ``employe_id`` repaired."""
    return csv_io.read_employees_csv(spark, _employees_csv(spark, sf_dir), by_name=True)


@query("scan_named_mixed_order")
def scan_named_mixed_order(spark, sf_dir):
    """S2 over files whose headers name the columns in different orders."""
    ts, _ = _tables(spark, sf_dir)
    path = _scratch(spark, "mixed-csv")
    text = testdata.timesheets_text(ts)
    order = ["checkout", "date", "timesheet_id", "checkin", "employee_id"]
    csv_io.write_csv(text.where("timesheet_id % 2 = 0"), f"{path}/a")
    csv_io.write_csv(text.where("timesheet_id % 2 = 1").select(*order), f"{path}/b")
    return csv_io.read_timesheets_csv(spark, f"{path}/*", by_name=True)


@query("time_to_seconds")
def time_to_seconds(spark, sf_dir):
    """seconds of day of every event timestamp."""
    ev = testdata.read_table(spark, sf_dir, "events")
    return ev.select("event_id", seconds_of_day("ts").alias("seconds"))


@query("parse_time_coerce")
def parse_time_coerce(spark, sf_dir):
    """tolerant parse of times of which some are malformed or not padded."""
    return _odd(spark, sf_dir).select("timesheet_id",
                       parse_time("checkin", coerce=True).alias("checkin"),
                       parse_time("checkout", coerce=True).alias("checkout"))


@query("load_cast_decimal")
def load_cast_decimal(spark, sf_dir):
    """The unrounded rule-set-B result cast to the DECIMAL(10,2) table type."""
    ts, emp = _tables(spark, sf_dir)
    return tables.cast_to_schema(rates.branch_rates(ts, emp, "b"), RESULT)


@query("full_refresh")
def full_refresh(spark, sf_dir):
    """Stage, validate and publish the rule-set-A result; read back."""
    ts, emp = _tables(spark, sf_dir)
    target = _scratch(spark, "salary-per-hours")
    tables.full_refresh(spark, rates.branch_rates(ts, emp, "a"), target, RESULT,
                        partition_by=jobs.PARTITIONS)
    return tables.read_table(spark, target).select(*RESULT.fieldNames())


@query("final_select")
def final_select(spark, sf_dir):
    """Read-back of the loaded result table with a SQL text."""
    return tables.run_sql(
        spark, "SELECT year, month, branch_id, salary_per_hour FROM salary_per_hours_b",
        {"salary_per_hours_b": load_cast_decimal(spark, sf_dir)})


# -- jobs (Q5, Q6) on CSV files written from the test tables ------------------------

@query("job_full_refresh")
def job_full_refresh(spark, sf_dir):
    """Q5 end to end: CSV -> staged sources -> rule set A -> DECIMAL(10,2) table."""
    wh = _scratch(spark, "warehouse")
    emp_csv, ts_csv = _employees_csv(spark, sf_dir), _timesheets_csv(spark, sf_dir)
    jobs.full_refresh_job(spark, emp_csv, ts_csv, wh)
    for path in (emp_csv, ts_csv):
        tables.discard(spark, path)
    return tables.read_table(spark, f"{wh}/salary_per_hours_a").select(*RESULT.fieldNames())


def _two_runs(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    ts, _ = _tables(spark, sf_dir)
    wh = _scratch(spark, "warehouse")
    emp_csv = _employees_csv(spark, sf_dir)
    for batch in (testdata.old_batch(ts), testdata.new_batch(ts)):
        path = _scratch(spark, "timesheets-batch")
        csv_io.write_csv(testdata.timesheets_text(batch), path)
        jobs.incremental_job(spark, emp_csv, path, wh, policy=policy)
        tables.discard(spark, path)
    tables.discard(spark, emp_csv)
    out = tables.read_table(spark, f"{wh}/salary_per_hours_{policy}")
    return _rounded(out.select(*jobs.RESULT_DOUBLE.fieldNames()), "salary_per_hour")


@query("job_incremental")
def job_incremental(spark, sf_dir):
    """Q6 end to end, two runs: the stored batch, then the arriving batch
    (append of new keys to the sources, rule set C, keyed upsert of the result)."""
    return _two_runs(spark, sf_dir, "c")


@query("job_incremental_d")
def job_incremental_d(spark, sf_dir):
    """Q6 with the notebook's load: result rows are appended by new key only,
    so the second run adds branch-months and never updates stored ones."""
    return _two_runs(spark, sf_dir, "d")


# -- streaming extract (S13 driven by file arrival) --------------------------------

@query("stream_ingest_timesheets")
def stream_ingest_timesheets(spark, sf_dir):
    """The stored batch, then the arriving batch, delivered as files to a
    landing folder and loaded by the availableNow stream (append new keys)."""
    from ..schemas import TIMESHEETS_TEXT
    from ..streaming import ingest

    ts, _ = _tables(spark, sf_dir)
    landing, target = _scratch(spark, "landing"), _scratch(spark, "timesheets-stream")
    checkpoint = _scratch(spark, "stream-checkpoint")
    for batch in (testdata.old_batch(ts), testdata.new_batch(ts)):
        testdata.timesheets_text(batch).write.mode("append").option("header", True).csv(landing)
        ingest(spark, landing, TIMESHEETS_TEXT, target, "timesheet_id",
               checkpoint=checkpoint).awaitTermination()
    out = tables.read_table(spark, target)
    return out.select("timesheet_id", "employee_id", "date",
                      parse_time("checkin").alias("checkin"),
                      parse_time("checkout").alias("checkout"))
