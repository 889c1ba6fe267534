"""Session defaults never override what the submitter set."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from wagegrid.config import SQL_DEFAULTS, checkpoint_dir, scratch_path, session


def test_defaults_apply_only_where_unset(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64m")
    try:
        assert session() is spark            # same session, settings kept
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.set(key, before)
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        assert spark.conf.get(k) is not None
    assert "spark.sql.autoBroadcastJoinThreshold" in SQL_DEFAULTS


def test_scratch_paths_live_below_the_checkpoint_folder(spark):
    base = checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/x-")


@pytest.mark.parametrize("master,registered", [("local[4]", True), ("spark://host:7077", False), ("yarn", False)])
def test_a_cluster_must_name_its_shared_folder(master, registered):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None,
                              setCheckpointDir=made.append)
    conf = SimpleNamespace(get=lambda key, *default: default[0] if default else "/warehouse/")
    session_ = SimpleNamespace(sparkContext=context, conf=conf)
    if registered:
        assert checkpoint_dir(session_) == "/warehouse/_checkpoints" == checkpoint_dir(session_)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(session_)
