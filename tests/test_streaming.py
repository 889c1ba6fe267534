"""The availableNow file stream: one micro-batch per delivered file,
appends only new keys, and a re-run consumes nothing twice."""

from __future__ import annotations

from wagegrid.schemas import TIMESHEETS_TEXT
from wagegrid.sources import tables
from wagegrid.streaming import ingest

HEADER = "timesheet_id,employee_id,date,checkin,checkout\n"


def deliver(folder, name, body):
    import os
    import time
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + body)
    time.sleep(0.05)  # distinct modification times


def run(spark, landing, target, ckpt):
    q = ingest(spark, landing, TIMESHEETS_TEXT, target, "timesheet_id", checkpoint=ckpt,
               max_files_per_trigger=1)
    q.awaitTermination()
    return [p["numInputRows"] for p in q.recentProgress]


def test_stream_appends_new_keys_once(spark, scratch):
    landing, target, ckpt = scratch("landing"), scratch("table"), scratch("ckpt")
    deliver(landing, "day1.csv", "1,1,2020-01-02,08:00:00,17:00:00\n"
                                 "2,1,2020-01-03,08:00:00,17:00:00\n")
    deliver(landing, "day2.csv", "2,1,2020-01-03,09:00:00,17:00:00\n"
                                 "3,1,2020-01-04,08:00:00,\n"
                                 "3,1,2020-01-04,08:30:00,\n")
    assert run(spark, landing, target, ckpt) == [2, 3]
    rows = {r.timesheet_id: r.checkin for r in tables.read_table(spark, target).collect()}
    # id 2 was stored first and is never updated; id 3 keeps its last row
    assert rows == {1: "08:00:00", 2: "08:00:00", 3: "08:30:00"}
    # nothing new: the checkpoint skips consumed files
    assert sum(run(spark, landing, target, ckpt)) == 0
    deliver(landing, "day3.csv", "3,1,2020-01-04,10:00:00,\n4,1,2020-01-05,08:00:00,17:00:00\n")
    assert run(spark, landing, target, ckpt) == [2]
    assert tables.read_table(spark, target).count() == 4


def test_similar_targets_have_their_own_checkpoints(spark, scratch):
    """Two tables over one landing folder are both loaded, all files in a batch."""
    landing, base = scratch("landing"), scratch("x" * 60)
    deliver(landing, "day1.csv", "1,1,2020-01-02,08:00:00,17:00:00\n")
    deliver(landing, "day2.csv", "2,1,2020-01-03,08:00:00,17:00:00\n")
    for target in (f"{base}/a/b", f"{base}/a_b", f"{base}/a/b"):
        q = ingest(spark, landing, TIMESHEETS_TEXT, target, "timesheet_id")
        q.awaitTermination()
        assert tables.read_table(spark, target).count() == 2
