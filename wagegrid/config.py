"""Session defaults and the shared scratch location.

Library functions take a ``SparkSession`` and never create one. ``session()``
is for tests, the bench and command-line jobs; on a cluster the submitter's
settings win because every default here is applied only when unset.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the rules rely on (UTC dates, ANSI errors) and that keep the plans
# adaptive. Each is applied only where the session has no value for it, so a
# submitter's --conf or spark-defaults always win.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from planning-time estimates (compressed file sizes prove
    # nothing about the decoded rows). AQE broadcasts a join side only after
    # its shuffle ran and measured at most 32 MB; larger sides stay
    # sort-merge joins.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Coalesce shuffle partitions to the advisory size rather than to the
    # default parallelism (no swarm of tiny reduce tasks on a big cluster).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}
# No web UI or console progress for batch runs.
STATIC_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, app: str = "wagegrid",
            shuffle_partitions: int | None = None,
            conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session (tests, bench, CLI).

    ``master``, ``shuffle_partitions`` and ``conf`` are applied as given;
    ``SQL_DEFAULTS`` only where the session has no value yet.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    explicit = dict(STATIC_SETTINGS)
    if shuffle_partitions is not None:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    explicit.update(conf or {})
    for key, value in explicit.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Staging tables and lineage cuts go there so that they survive the loss of
    an executor. Where nothing is configured, a session on one machine registers a
    folder below the SQL warehouse; on a cluster, whose executors might not see
    that folder, it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
