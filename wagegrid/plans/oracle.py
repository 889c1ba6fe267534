"""Independent DuckDB SQL for every registered query.

The oracle follows the workload's own order (join every attendance row, then
aggregate), uses integer arithmetic for the proration ratio and NULLIF for
zero hours, so it checks the Spark plans (which aggregate before the join)
rather than repeating them. Tables ``customer`` and ``events`` are views in
the checker; ``employees`` and ``timesheets`` come from ``oracle_views``.
"""

from __future__ import annotations

from ..sources.testdata import oracle_views

_FILL = {
    "morning": (
        "CASE WHEN checkin IS NULL AND checkout > 28800 THEN 28800 "
        "WHEN checkin IS NULL AND checkout < 28800 THEN 61200 ELSE checkin END",
        "CASE WHEN checkout IS NULL AND checkin > 28800 THEN 61200 "
        "WHEN checkout IS NULL AND checkin < 28800 THEN 28800 ELSE checkout END",
    ),
    "noon": (
        "CASE WHEN checkin IS NULL AND checkout > 0 AND checkout < 43200 THEN 61200 ELSE checkin END",
        "CASE WHEN checkout IS NULL AND checkin > 0 AND checkin < 43200 THEN 61200 ELSE checkout END",
    ),
}

_DURATION = {
    "evening": "CASE WHEN ci < 61200 THEN co - ci WHEN ci > 61200 THEN ci - co "
               "WHEN co < 61200 THEN ci - co WHEN co > 61200 THEN co - ci ELSE 32400 END",
    "noon": "CASE WHEN ci > 0 AND ci < 43200 THEN co - ci "
            "WHEN co > 0 AND co < 43200 THEN ci - co ELSE 32400 END",
    "noon_default": "CASE WHEN ci IS NULL OR co IS NULL THEN 32400 "
                    "WHEN ci > 0 AND ci < 43200 THEN co - ci WHEN ci >= 43200 THEN ci - co "
                    "WHEN co > 43200 THEN co - ci WHEN co > 0 AND co < 43200 THEN ci - co "
                    "ELSE 32400 END",
}

# (fill, duration, employee order, salary filter, drop NULL keys)
_POLICY = {
    "a": ("morning", "evening", None, "salary IS NOT NULL", False),
    "b": ("noon", "noon", "NULLS FIRST", "salary IS NOT NULL", False),
    "c": ("noon", "noon_default", "NULLS LAST", "salary IS NOT NULL AND salary <> 0", True),
}


def employee_cte(order: str | None, name: str = "staff") -> str:
    if order is None:
        return f"{name} AS (SELECT * FROM employees)"
    return f"""{name} AS (
  SELECT employee_id, branch_id, salary, join_date, resign_date FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY
        join_date DESC {order}, salary DESC {order}, branch_id DESC {order},
        resign_date DESC {order}) AS rn
    FROM employees) WHERE rn = 1)"""


def policy_ctes(policy: str, source: str = "timesheets", prefix: str = "") -> str:
    """CTEs filled, shifts, staff, gross, rates (names prefixed by ``prefix``)
    for one policy, to follow ``oracle_views``."""
    fill, duration, order, salary_ok, drop_null = _POLICY[policy]
    ci, co = _FILL[fill]
    duration = _DURATION[duration]
    null_keys = ("AND t.employee_id IS NOT NULL AND t.date IS NOT NULL "
                 "AND s.branch_id IS NOT NULL") if drop_null else ""
    return f""",
{prefix}filled AS (
  SELECT timesheet_id, employee_id, date, checkin, checkout,
         {ci} AS ci, {co} AS co FROM {source}),
{prefix}shifts AS (SELECT *, CAST({duration} AS BIGINT) AS work_seconds FROM {prefix}filled),
{employee_cte(order, prefix + "staff")},
{prefix}gross AS (
  SELECT t.employee_id, s.branch_id,
         CAST(year(t.date) AS INTEGER) AS year, CAST(month(t.date) AS INTEGER) AS month,
         COUNT(t.employee_id) AS total_day,
         CAST(SUM(t.work_seconds) AS DOUBLE) / 3600.0 AS total_hours,
         MIN(s.salary) AS salary
  FROM {prefix}shifts t LEFT JOIN {prefix}staff s ON t.employee_id = s.employee_id
  WHERE s.{salary_ok} {null_keys}
  GROUP BY t.employee_id, s.branch_id, year(t.date), month(t.date)),
{prefix}rates AS (
  SELECT *, CAST(prorated_salary AS DOUBLE) / NULLIF(total_hours, 0) AS salary_per_hour
  FROM (SELECT *, CASE WHEN total_day > 22 THEN CAST(salary AS DECIMAL(24,4))
                       ELSE CAST(CAST((total_day * 100 + 11) // 22 AS DECIMAL(18,0))
                                 * CAST(0.01 AS DECIMAL(3,2)) * salary AS DECIMAL(24,4))
                  END AS prorated_salary FROM {prefix}gross))
"""


def with_policy(policy: str, body: str, batches: bool = False, source: str = "timesheets",
                extra: str = "") -> str:
    return oracle_views(batches=batches).rstrip() + extra + policy_ctes(policy, source) + body


def branch_rate_sql(policy: str) -> str:
    if policy == "a":
        value = ("CAST(ROUND(CAST(AVG(salary_per_hour) AS DECIMAL(38,10)), 2) "
                 "AS DECIMAL(20,2))")
    else:
        value = "(ROUND(AVG(salary_per_hour), 6) + 0.0)"
    return with_policy(policy, f"""
SELECT CAST(branch_id AS INTEGER) AS branch_id, year, month, {value} AS salary_per_hour
FROM rates GROUP BY branch_id, year, month
ORDER BY branch_id NULLS LAST, year NULLS LAST, month NULLS LAST
""")


_BODY = {
    "missing_flags": """
SELECT missing_either, missing_both, missing_either > 0 AS has_missing_either,
       missing_both > 0 AS has_missing_both
FROM (SELECT COUNT(*) FILTER (WHERE checkin IS NULL OR checkout IS NULL) AS missing_either,
             COUNT(*) FILTER (WHERE checkin IS NULL AND checkout IS NULL) AS missing_both
      FROM timesheets)""",
    "quality_report": """
SELECT *, raw_ids > unique_ids AS has_duplicates FROM (
  SELECT 'timesheets' AS table_name, COUNT(timesheet_id) AS raw_ids,
         COUNT(DISTINCT timesheet_id) AS unique_ids,
         COUNT(*) FILTER (WHERE checkin IS NULL OR checkout IS NULL) AS missing_either,
         COUNT(*) FILTER (WHERE checkin IS NULL AND checkout IS NULL) AS missing_both,
         MIN(checkin) AS min_checkin, MAX(checkin) AS max_checkin
  FROM timesheets
  UNION ALL
  SELECT 'employees', COUNT(employee_id), COUNT(DISTINCT employee_id),
         CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM employees)""",
}


def _odd(body: str, extra: str = "") -> str:
    return oracle_views(odd=True).rstrip() + extra + "\n" + body


def _padded(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL THEN format('{{:02d}}:{{:02d}}:{{:02d}}', {c} // 3600, "
            f"({c} % 3600) // 60, {c} % 60) END AS {c}")


def _views(body: str, batches: bool = False, extra: str = "") -> str:
    return oracle_views(batches=batches).rstrip() + extra + "\n" + body


_RESULT_A = "CAST(ROUND(CAST(AVG(salary_per_hour) AS DECIMAL(38,10)), 2) AS DECIMAL({p},2))"

_KEEP_LAST_NEW = """,
latest_new AS (
  SELECT timesheet_id, employee_id, date, checkin, checkout{more} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY timesheet_id
                                 ORDER BY {order} DESC) AS rn
    FROM new_seq) WHERE rn = 1)"""

_LATEST_NEW = _KEEP_LAST_NEW.format(order="arrival", more=", arrival")

# What two CSV deliveries leave: rows of a file are in event order.
_FINAL_TS = _KEEP_LAST_NEW.format(order="event_id", more="") + """,
first_ts AS (SELECT timesheet_id, employee_id, date, checkin, checkout FROM old_seq),
final_ts AS (
  SELECT * FROM first_ts
  UNION ALL
  SELECT * FROM latest_new n
  WHERE NOT EXISTS (SELECT 1 FROM old_batch o
                    WHERE o.timesheet_id IS NOT DISTINCT FROM n.timesheet_id))"""


def _describe_body(table: str, columns: tuple[str, ...]) -> str:
    parts = []
    for c in columns:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({x}) AS \"count\", (ROUND(AVG({x}), 6) + 0.0) AS mean, "
            f"(ROUND(STDDEV_SAMP({x}), 6) + 0.0) AS std, (ROUND(MIN({x}), 6) + 0.0) AS \"min\", "
            f"(ROUND(QUANTILE_CONT({x}, 0.25), 6) + 0.0) AS p25, (ROUND(QUANTILE_CONT({x}, 0.5), 6) + 0.0) AS p50, "
            f"(ROUND(QUANTILE_CONT({x}, 0.75), 6) + 0.0) AS p75, (ROUND(MAX({x}), 6) + 0.0) AS \"max\" FROM {table}")
    return "\nUNION ALL\n".join(parts)


def _describe_sql() -> str:
    result = (",\nresult AS (SELECT branch_id, year, month, AVG(salary_per_hour) AS salary_per_hour\n"
              "           FROM rates GROUP BY branch_id, year, month)\n")
    return with_policy("b", result + _describe_body(
        "result", ("branch_id", "year", "month", "salary_per_hour")))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {
        "branch_rate_a": branch_rate_sql("a"),
        "branch_rate_b": branch_rate_sql("b"),
        "branch_rate_c": branch_rate_sql("c"),
    }
    for p in ("a", "b", "c"):
        q[f"fill_times_{p}"] = with_policy(p, """
SELECT timesheet_id, employee_id, date, ci AS checkin_new, co AS checkout_new FROM filled""")
        q[f"shift_hours_{p}"] = with_policy(p, """
SELECT timesheet_id, employee_id, date, work_seconds,
       (ROUND(CAST(work_seconds AS DOUBLE) / 3600.0, 6) + 0.0) AS total_hours FROM shifts""")
        q[f"gross_hours_{p}"] = with_policy(p, """
SELECT employee_id, branch_id, year, month, total_day, (ROUND(total_hours, 6) + 0.0) AS total_hours,
       salary FROM gross""")
        q[f"employee_rate_{p}"] = with_policy(p, """
SELECT employee_id, branch_id, year, month, total_day, (ROUND(total_hours, 6) + 0.0) AS total_hours,
       salary, prorated_salary, (ROUND(salary_per_hour, 6) + 0.0) AS salary_per_hour FROM rates""")
    # Rule set C over text times: only absent times are filled.
    odd_c = f""",
filled AS (
  SELECT timesheet_id, employee_id, date,
    CASE WHEN checkin_absent AND checkout_value > 0 AND checkout_value < 43200 THEN 61200
         ELSE checkin_value END AS ci,
    CASE WHEN checkout_absent AND checkin_value > 0 AND checkin_value < 43200 THEN 61200
         ELSE checkout_value END AS co FROM timesheets_odd),
shifts AS (SELECT *, CAST({_DURATION["noon_default"]} AS BIGINT) AS work_seconds FROM filled)"""
    q["fill_times_c"] = _odd("SELECT timesheet_id, employee_id, date, ci AS checkin_new, "
                             "co AS checkout_new FROM filled", extra=odd_c)
    q["shift_hours_c"] = _odd("""
SELECT timesheet_id, employee_id, date, work_seconds,
       (ROUND(CAST(work_seconds AS DOUBLE) / 3600.0, 6) + 0.0) AS total_hours FROM shifts""", extra=odd_c)
    q["prorated_salary"] = with_policy("a", """
SELECT employee_id, branch_id, year, month, total_day, salary, prorated_salary FROM rates""")
    q["dedupe_employees_nulls_first"] = _views(
        "SELECT * FROM staff", extra=",\n" + employee_cte("NULLS FIRST"))
    q["dedupe_employees_nulls_last"] = _views(
        "SELECT * FROM staff", extra=",\n" + employee_cte("NULLS LAST"))
    join = """SELECT t.timesheet_id, t.employee_id, t.date, e.branch_id, e.salary
FROM timesheets t LEFT JOIN {emp} e ON t.employee_id = e.employee_id"""
    q["join_left_raw"] = _views(join.format(emp="employees"))
    q["join_left_deduped"] = _views(join.format(emp="staff"),
                                    extra=",\n" + employee_cte("NULLS FIRST"))

    # quality checks
    q["dup_check_timesheets"] = _views("""
SELECT COUNT(timesheet_id) AS raw_timesheet_id, COUNT(DISTINCT timesheet_id) AS unique_timesheet_id,
       COUNT(timesheet_id) > COUNT(DISTINCT timesheet_id) AS has_duplicates FROM timesheets""")
    q["dup_check_employees"] = _views("""
SELECT COUNT(employee_id) AS raw_total_employee, COUNT(DISTINCT employee_id) AS unique_total_employee,
       COUNT(employee_id) > COUNT(DISTINCT employee_id) AS has_duplicates FROM employees""")
    q["checkin_range"] = _views(
        "SELECT MAX(checkin) AS max_checkin, MIN(checkin) AS min_checkin FROM timesheets")
    q["missing_either"] = _views(
        "SELECT * FROM timesheets WHERE checkin IS NULL OR checkout IS NULL")
    q["missing_either_top5"] = _views(
        "SELECT * FROM timesheets WHERE checkin IS NULL OR checkout IS NULL "
        "ORDER BY timesheet_id NULLS LAST LIMIT 5")
    q["missing_both"] = _views(
        "SELECT * FROM timesheets WHERE checkin IS NULL AND checkout IS NULL")
    q["missing_flags"] = _views(_BODY["missing_flags"])
    q["quality_report"] = _views(_BODY["quality_report"])
    q["describe_rates"] = _describe_sql()
    q["describe_timesheets"] = _views(_describe_body(
        "timesheets", ("timesheet_id", "employee_id", "checkin", "checkout")))
    q["sort_employees"] = _views(
        "SELECT * FROM employees ORDER BY join_date DESC NULLS LAST, salary DESC NULLS LAST")

    # set operations and incremental loads
    q["union_all_sources"] = _views(
        "SELECT * EXCLUDE (date) FROM old_batch UNION ALL BY NAME "
        "SELECT * EXCLUDE (checkout) FROM new_batch", batches=True)
    q["distinct_rates"] = with_policy("b", """
SELECT DISTINCT * FROM (
  SELECT CAST(branch_id AS INTEGER) AS branch_id, year, month,
         (ROUND(AVG(salary_per_hour), 6) + 0.0) AS salary_per_hour
  FROM rates GROUP BY branch_id, year, month)""")
    q["keep_last"] = _views("""
SELECT timesheet_id, employee_id, date, checkin, checkout, arrival FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY arrival DESC) AS rn
  FROM timesheets_seq) WHERE rn = 1""")
    q["append_new_keys"] = _views("""
SELECT * FROM latest_new n
WHERE NOT EXISTS (SELECT 1 FROM old_batch o WHERE o.timesheet_id IS NOT DISTINCT FROM n.timesheet_id)""",
                                  batches=True, extra=_LATEST_NEW)
    q["upsert_keep_last"] = _views("""
SELECT timesheet_id, employee_id, date, checkin, checkout, arrival FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY timesheet_id ORDER BY src DESC, arrival DESC) AS rn
  FROM (SELECT *, 0 AS src FROM old_batch UNION ALL SELECT *, 1 AS src FROM new_batch))
WHERE rn = 1""", batches=True)
    q["append_key_list"] = q["append_new_keys"]
    q["upsert_partitioned"] = _views("""
SELECT timesheet_id, employee_id, date, checkin, checkout, arrival FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY date, timesheet_id ORDER BY src DESC, arrival DESC) AS rn
  FROM (SELECT *, 0 AS src FROM old_batch UNION ALL SELECT *, 1 AS src FROM new_batch))
WHERE rn = 1""", batches=True)
    q["upsert_partitioned_whole"] = q["upsert_partitioned"]
    q["upsert_new_column"] = q["upsert_keep_last"].replace(
        "SELECT *, 0 AS src FROM old_batch",
        "SELECT * REPLACE (CAST(NULL AS BIGINT) AS checkout), 0 AS src FROM old_batch")
    append = """
SELECT * FROM old_batch UNION ALL
SELECT * REPLACE ({checkout} AS checkout) FROM latest_new n
WHERE NOT EXISTS (SELECT 1 FROM old_batch o WHERE o.timesheet_id IS NOT DISTINCT FROM n.timesheet_id)"""
    q["append_absent_column"] = _views(append.format(checkout="CAST(NULL AS BIGINT)"), batches=True,
                                       extra=_LATEST_NEW)
    q["append_indexed"] = _views(append.format(checkout="checkout"), batches=True, extra=_LATEST_NEW)
    q["maintained_attendance"] = with_policy("c", """
SELECT employee_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       COUNT(*) AS days, CAST(coalesce(SUM(work_seconds), 0) AS BIGINT) AS work_seconds,
       COUNT(work_seconds) AS counted
FROM shifts WHERE employee_id IS NOT NULL AND date IS NOT NULL
GROUP BY employee_id, year(date), month(date)""", batches=True, source="appended",
        extra=_LATEST_NEW + ",\nappended AS (" + append.format(checkout="checkout") + ")")
    for name in ("nulls_first", "nulls_last"):
        q[f"maintained_latest_{name}"] = q[f"dedupe_employees_{name}"]
    q["compact_appends"] = _views("""
SELECT timesheet_id, employee_id, date, checkin, checkout, arrival FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY timesheet_id ORDER BY arrival DESC) AS rn FROM timesheets_seq)
WHERE timesheet_id % 3 = 0 OR rn = 1""")
    q["key_check_flags"] = _views("""
SELECT 'timesheet_id' AS key, true AS valid, (SELECT COUNT(DISTINCT timesheet_id) FROM old_batch) AS stored_values,
       (SELECT COUNT(DISTINCT timesheet_id) FROM new_batch) AS arriving_values
UNION ALL SELECT 'employee_id', true, (SELECT COUNT(DISTINCT employee_id) FROM old_batch),
                 (SELECT COUNT(DISTINCT employee_id) FROM new_batch)
UNION ALL SELECT 'date', false, NULL, (SELECT COUNT(DISTINCT date) FROM new_batch)
UNION ALL SELECT 'checkout', false, (SELECT COUNT(DISTINCT checkout) FROM old_batch), NULL""", batches=True)
    q["table_exists_flags"] = _views("""
SELECT false AS folder_before, false AS table_before, true AS folder_after, true AS table_after,
       COUNT(*) AS n_rows FROM employees""")
    q["load_counts"] = _views("""
SELECT COUNT(*) FILTER (WHERE NOT hit) AS new_keys, COUNT(*) FILTER (WHERE hit) AS matched_keys
FROM (SELECT EXISTS (SELECT 1 FROM old_batch o
                     WHERE o.timesheet_id IS NOT DISTINCT FROM n.timesheet_id) AS hit
      FROM latest_new n)""", batches=True, extra=_LATEST_NEW)
    q["incremental_first_load"] = _views("SELECT * EXCLUDE (event_id) FROM timesheets_seq")

    # scans, sinks and loads
    q["scan_employees"] = _views("SELECT * FROM employees")
    q["rename_header"] = _views("SELECT * FROM employees")
    q["scan_timesheets"] = _views("SELECT * FROM timesheets")
    q["time_to_seconds"] = ("SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) "
                            "AS BIGINT) AS seconds FROM events")
    q["parse_time_coerce"] = _odd("SELECT timesheet_id, checkin_value AS checkin, "
                                  "checkout_value AS checkout FROM timesheets_odd")
    q["scan_named_mixed_order"] = _odd(f"""
SELECT timesheet_id, employee_id, date, {_padded("checkin")}, {_padded("checkout")} FROM timesheets""")
    text = "SELECT timesheet_id, employee_id, date, checkin, checkout FROM timesheets_odd WHERE "
    q["missing_either_text"] = _odd(text + "checkin_value IS NULL OR checkout IS NULL")
    q["missing_both_text"] = _odd(text + "checkin_value IS NULL AND checkout IS NULL")
    to_text = ("timesheets_value AS (SELECT timesheet_id, checkin_value AS checkin, checkout "
               "FROM timesheets_odd)")
    for name in ("missing_flags", "quality_report"):
        q[f"{name}_text"] = _odd(_BODY[name].replace("FROM timesheets", "FROM timesheets_value"),
                                 extra=",\n" + to_text)
    cast_b = with_policy("b", """
SELECT CAST(branch_id AS INTEGER) AS branch_id, year, month,
       CAST(AVG(salary_per_hour) AS DECIMAL(10,2)) AS salary_per_hour
FROM rates GROUP BY branch_id, year, month""")
    q["load_cast_decimal"] = cast_b
    q["final_select"] = cast_b.replace(
        "SELECT CAST(branch_id AS INTEGER) AS branch_id, year, month,",
        "SELECT year, month, CAST(branch_id AS INTEGER) AS branch_id,")
    result_a = with_policy("a", f"""
SELECT CAST(branch_id AS INTEGER) AS branch_id, year, month, {_RESULT_A.format(p=10)} AS salary_per_hour
FROM rates GROUP BY branch_id, year, month""")
    q["full_refresh"] = result_a
    q["ensure_table_schema"] = f"""SELECT *, 'branch_id int, year int, month int, salary_per_hour decimal(10,2)' AS columns
FROM ({result_a})"""
    q["job_full_refresh"] = result_a
    q["catalog_refresh"] = result_a
    q["job_incremental"] = with_policy("c", """
SELECT CAST(branch_id AS INTEGER) AS branch_id, year, month,
       (ROUND(AVG(salary_per_hour), 6) + 0.0) AS salary_per_hour
FROM rates GROUP BY branch_id, year, month""", batches=True, source="final_ts", extra=_FINAL_TS)
    q["stream_ingest_timesheets"] = _views("SELECT * FROM final_ts", batches=True,
                                           extra=_FINAL_TS)
    per_branch = """{p}result AS (
  SELECT CAST(branch_id AS INTEGER) AS branch_id, year, month,
         (ROUND(AVG(salary_per_hour), 6) + 0.0) AS salary_per_hour
  FROM {p}rates GROUP BY branch_id, year, month)"""
    q["job_incremental_d"] = (
        oracle_views(batches=True).rstrip() + _FINAL_TS
        + policy_ctes("c", "first_ts", "r1_") + ",\n" + per_branch.format(p="r1_")
        + policy_ctes("c", "final_ts", "r2_") + ",\n" + per_branch.format(p="r2_") + """
SELECT * FROM r1_result
UNION ALL
SELECT * FROM r2_result n
WHERE NOT EXISTS (SELECT 1 FROM r1_result o WHERE o.branch_id IS NOT DISTINCT FROM n.branch_id
                  AND o.year IS NOT DISTINCT FROM n.year AND o.month IS NOT DISTINCT FROM n.month)""")
    return q
