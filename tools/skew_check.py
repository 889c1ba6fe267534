"""Measure how a hot employee spreads over tasks.

Builds the attendance view from ``events`` with a third of all rows moved to
one employee (and a third of the employee records duplicated onto one id),
runs the pay-rate chain of each policy with sort-merge joins forced, and
reads per-task shuffle metrics from Spark's event log. For comparison it
also runs the textbook plan that joins raw attendance rows before
aggregating. Prints one JSON object per plan: the most shuffled records any
single task read, and the size of the largest shuffle.

    python tools/skew_check.py LOCAL_FOLDER [/root/testdata/sf0.1]

LOCAL_FOLDER takes the skewed inputs and event logs of this local run.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from wagegrid.config import session  # noqa: E402
from wagegrid.operators.rates import branch_rates, shift_hours  # noqa: E402
from wagegrid.sources import testdata  # noqa: E402

HOT = 1


def write_skewed_inputs(spark, sf_dir, parts, out_dir):
    """events/customer with a third of the rows moved to one id, as
    ``parts`` Parquet files each (so the scans have ``parts`` splits)."""
    events = testdata.read_table(spark, sf_dir, "events")
    events = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT))
                               .otherwise(F.col("user_id")))
    customer = testdata.read_table(spark, sf_dir, "customer")
    customer = customer.withColumn("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.lit(HOT))
                                   .otherwise(F.col("c_custkey")))
    events.repartition(parts).write.parquet(f"{out_dir}/events.parquet")
    customer.repartition(parts).write.parquet(f"{out_dir}/customer.parquet")
    return testdata.timesheets_from(spark.read.parquet(f"{out_dir}/events.parquet")).count()


def join_first(ts, emp, policy):
    """The textbook order: join every attendance row, then aggregate."""
    t = shift_hours(ts, policy)
    e = emp.filter("salary IS NOT NULL").select("employee_id", "branch_id", "salary")
    return (t.join(e, "employee_id")
            .groupBy("employee_id", "branch_id", F.year("date").alias("year"),
                     F.month("date").alias("month"))
            .agg(F.count(F.lit(1)).alias("days"), F.sum("work_seconds").alias("s")))


def task_shares(log_dir):
    """Per stage: (max records read by one task / all records read by the stage)."""
    stages = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if recs:
                    stages.setdefault((ev["Stage ID"], ev["Stage Attempt ID"]), []).append(recs)
    return {k: (max(v), sum(v), len(v)) for k, v in stages.items()}


def main():
    folder = os.path.abspath(sys.argv[1])
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    parts = 8
    results = []
    prep = session(master=f"local[{parts}]", app="skew-prepare", shuffle_partitions=parts)
    data_dir = os.path.join(folder, f"skewed-{uuid.uuid4().hex}")
    log_dirs = [os.path.join(folder, f"eventlog-{uuid.uuid4().hex}") for _ in range(4)]
    rows = write_skewed_inputs(prep, sf_dir, parts, data_dir)
    prep.stop()
    for label, build in [("branch_rates_a", lambda t, e: branch_rates(t, e, "a")),
                         ("branch_rates_b", lambda t, e: branch_rates(t, e, "b")),
                         ("branch_rates_c", lambda t, e: branch_rates(t, e, "c")),
                         ("join_then_aggregate", lambda t, e: join_first(t, e, "b"))]:
        log_dir = log_dirs.pop()
        os.makedirs(log_dir, exist_ok=True)  # local event logs of this diagnostic run
        spark = session(master=f"local[{parts}]", app=f"skew-{label}", shuffle_partitions=parts,
                        conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                              "spark.eventLog.compress": "false",
                              "spark.eventLog.rolling.enabled": "false",
                              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                              "spark.sql.adaptive.skewJoin.enabled": "false",
                              "spark.sql.adaptive.coalescePartitions.enabled": "false"})
        ts, emp = testdata.load_tables(spark, data_dir)
        build(ts, emp).write.format("noop").mode("overwrite").save()
        spark.stop()
        stages = task_shares(log_dir)
        largest = max(stages.values(), key=lambda v: v[1])
        results.append({
            "plan": label,
            "attendance_rows": rows,
            "hot_employee_rows": rows // 3,
            "max_records_one_task_read": max(v[0] for v in stages.values()),
            "largest_shuffle_records": largest[1],
            "largest_shuffle_max_task": largest[0],
        })
    for r in results:
        print(json.dumps(r))


if __name__ == "__main__":
    main()
