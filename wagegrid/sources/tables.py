"""Parquet tables: ensure, probe, and all-or-nothing loads.

A stored table is a folder of loads and versions (see ``versions``). Every load
writes its rows once, into a folder of its own, and then commits the next version:
a failure at any point before leaves the rows as they were, readers never see a
half-written table, and of two loads that ran at the same time the second to commit
fails with ``ConcurrentLoadError``. That holds for refreshes, appends and upserts,
also of single partitions. In the catalog a table is a view of its current version.

Loads that compute from the stored rows first write to a staging folder below
the shared ``spark.checkpoint.dir``. That cuts the lineage (a lost executor
costs one re-read, not a recomputation) and evaluates the arriving rows once.

Partitioned writes are rebalanced on the partition columns, so a partition
gets few files whatever the number of tasks; AQE splits the large ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import scratch_path
from ..operators.dedupe import normalize_keys
from ..operators.merge import (latest_keyed, merged_with_flag, stored_key_columns,
                               validate_keys)
from ..schemas import ddl
from . import versions
from .versions import LOAD, Version, hadoop, load_folder


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog probe."""
    return spark.catalog.tableExists(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS from a declared schema."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet{loc}")


def table_folder(spark: SparkSession, path: str) -> str:
    """The folder of a table that consists of one load."""
    at = versions.latest(spark, path)
    if at is None:
        return path
    if len(at.loads()) != 1:
        raise ValueError(f"{path} has rows of {len(at.loads())} loads")
    return load_folder(path, at.parts[0][0])


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable Parquet table (S8 for folders)."""
    if versions.latest(spark, path):
        return True
    here, fs = hadoop(spark, path)
    if not fs.exists(here):
        return False
    if any(s.getPath().getName().startswith(f"{LOAD}=") for s in fs.listStatus(here)):
        return False  # a first load that was never committed
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolves the file listing
        return True
    except AnalysisException:
        return False


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Whole-table scan (S4); projections and filters prune at the scan."""
    at = versions.latest(spark, path)
    return versions.read(spark, path, at) if at else spark.read.parquet(path)


def run_sql(spark: SparkSession, query: str, views: dict[str, DataFrame] | None = None,
            args: dict | None = None) -> DataFrame:
    """Run a SQL text over named frames (S5): each frame becomes a temporary
    view of the session; ``args`` bind ``:name`` parameters."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=args) if args else spark.sql(query)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns by name and cast them (S12; decimals round
    half up, ANSI: an overflowing value fails the load)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stage(spark: SparkSession, df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh staging folder and return it re-read."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def discard(spark: SparkSession, path: str) -> bool:
    """Delete a staging folder after its content was published.

    Uses the Hadoop file system of the session (any scheme the cluster is
    configured for). Returns False, leaving the folder to the retention of
    the checkpoint location, when no JVM handle is available.
    """
    try:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True))
    except Exception:  # noqa: BLE001 - cleanup is best effort
        return False


def _public(df: DataFrame) -> DataFrame:
    """Drop helper columns (``__`` prefix, e.g. arrival order) before storing."""
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def write_load(df: DataFrame, target: str, partition_by: Sequence[str],
               cluster_by: Sequence[str] = ()) -> str:
    """Write the rows into a new load folder of ``target``; returns the load.

    A partition folder gets few files. Without partitions, ``cluster_by`` sorts the
    load by ranges of these columns, so that files cover few values of each.
    """
    df, load = _public(df), versions.new_load()
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    elif cluster_by:
        writer = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by).write
    else:
        writer = df.write
    writer.parquet(load_folder(target, load))
    return load


def replace_load(spark: SparkSession, df: DataFrame, target: str,
                 partition_by: Sequence[str] | None = None, notes: dict | None = None) -> int:
    """Write ``df`` as the whole next version of the table; returns its rows."""
    base, partition_by = versions.latest(spark, target), tuple(partition_by or ())
    load = write_load(df, target, partition_by)
    made = versions.commit(spark, target, base, _nullable(_public(df).schema), partition_by,
                           versions.written_parts(spark, target, load, len(partition_by)), notes)
    return versions.read(spark, target, made).count()


def full_refresh(spark: SparkSession, df: DataFrame, target: str,
                 schema: T.StructType | None = None,
                 partition_by: Sequence[str] | None = None) -> int:
    """Replace the table with ``df``, all or nothing.

    The rows are cast to ``schema`` by column name (the insert-select by column
    list) and written once. Returns the number of rows loaded. When another load
    commits between start and end, that one stays and this one raises
    ``ConcurrentLoadError``.
    """
    return replace_load(spark, df if schema is None else cast_to_schema(df, schema), target, partition_by)


def full_refresh_table(spark: SparkSession, df: DataFrame, table: str, root: str,
                       schema: T.StructType | None = None,
                       partition_by: Sequence[str] | None = None) -> int:
    """Full refresh of a catalog table without copying the data.

    The rows are stored below ``root``, in a folder of the table's name, as
    ``full_refresh`` does; then the catalog shows the new version (``show_table``).
    """
    target = f"{root.rstrip('/')}/{table}"
    n = full_refresh(spark, df, target, schema, partition_by)
    show_table(spark, table, target)
    return n


def show_table(spark: SparkSession, name: str, target: str) -> int:
    """Make the catalog's ``name`` a view of the current version of the table stored
    at ``target``; returns the version's number.

    The files belong to an external table ``<name>__files`` whose outermost partition
    is the load. New loads are added there first, which no reader sees; then one
    statement replaces the view. So a reader gets one version or the other, never
    rows of both. If another load commits meanwhile, the view is replaced again.
    """
    files = f"{name}__files"
    while True:
        at = versions.latest(spark, target)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in at.schema.fields)
        parts = ", ".join(f"`{c}`" for c in (LOAD, *at.partition_by))
        if not table_exists(spark, files):
            spark.sql(f"CREATE TABLE {files} ({columns}, `{LOAD}` STRING) USING parquet "
                      f"PARTITIONED BY ({parts}) LOCATION '{target}'")
        known = set(spark.table(files).columns)
        more = [f for f in at.schema.fields if f.name not in known]
        if more:
            spark.sql(f"ALTER TABLE {files} ADD COLUMNS ("
                      + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in more) + ")")
        spark.catalog.recoverPartitions(files)
        chosen = ", ".join(f"`{c}`" for c in at.schema.names)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {chosen} FROM {files} "
                  f"WHERE {_parts_sql(spark, target, at)}")
        if versions.latest(spark, target).number == at.number:
            return at.number


def _parts_sql(spark: SparkSession, target: str, at: Version) -> str:
    """A condition on the partition columns that holds for a version's parts."""
    whole, some = [], []
    for load in sorted(at.loads()):
        own = {p for other, p in at.parts if other == load}
        if own == {p for _, p in versions.written_parts(spark, target, load, len(at.partition_by))}:
            whole.append(f"'{load}'")
        else:
            some.append(f"(`{LOAD}` = '{load}' AND ("
                        + " OR ".join(_partition_sql(p, at.schema) for p in sorted(own)) + "))")
    either = ([f"`{LOAD}` IN ({', '.join(whole)})"] if whole else []) + some
    return " OR ".join(either) or "false"


def _partition_sql(folder: str, schema: T.StructType) -> str:
    """``year=2020/month=1`` as a condition; the default partition is NULL."""
    out = []
    for part in folder.split("/"):
        name, _, value = part.partition("=")
        value = unquote(value)
        kind = schema[name].dataType.simpleString()
        if value == "__HIVE_DEFAULT_PARTITION__":
            out.append(f"`{name}` IS NULL")
        else:
            quoted = value.replace("\\", "\\\\").replace("'", "\\'")
            out.append(f"`{name}` = CAST('{quoted}' AS {kind})")
    return "(" + " AND ".join(out) + ")"


def first_load(spark: SparkSession, new: DataFrame, target: str,
               partition_by: Sequence[str] | None = None) -> int:
    """Create the table from the data as it is -- no de-duplication -- and
    report every row as new (S9)."""
    return replace_load(spark, new, target, partition_by)


def _stored_version(spark: SparkSession, target: str,
                    partition_by: Sequence[str] | None) -> Version | None:
    """The version that a load starts from; None before the first one."""
    base = versions.latest(spark, target)
    if base is None and path_exists(spark, target):
        raise ValueError(f"{target} is a plain folder of files; full_refresh can take it over")
    if base and tuple(partition_by or ()) != base.partition_by:
        raise ValueError(f"{target} is stored by {base.partition_by}, not {tuple(partition_by or ())}")
    return base


def _as_stored(new: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that are stored, cast to their stored types; others as they are."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return new.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`")
                        for c in new.columns])


@dataclass
class StagedAppend:
    """Rows written for an append-new-keys load, not yet committed."""
    target: str
    rows: DataFrame          # re-read from the load's folder
    load: str
    count: int
    base: Version | None     # the version that the load started from
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    notes: dict = field(default_factory=dict)

    @property
    def first(self) -> bool:
        """Whether this load creates the table."""
        return self.base is None

    def publish(self) -> int:
        """Commit the version that has these rows, too."""
        spark = self.rows.sparkSession
        base = self.base
        if not self.count and base and self.notes in ({}, base.notes):
            discard(spark, load_folder(self.target, self.load))
            return 0
        versions.commit(
            spark, self.target, base, self.schema, self.partition_by,
            (*(base.parts if base else ()),
             *versions.written_parts(spark, self.target, self.load, len(self.partition_by))),
            self.notes or (base.notes if base else None), base.merged if base else None)
        return self.count


# Largest broadcast of batch keys, as a bound computed from the row count and
# fixed key widths (hash-relation overhead included), not an estimate. It picks
# the join's plan; the rows are the same either way.
BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024
HASHED_KEY_BYTES = 16  # what a lookup in the key index sends of a key


def _key_bytes_bound(schema: T.StructType) -> int | None:
    """Upper bound of one key row in a broadcast hash relation; None when a
    key column has no fixed width (strings)."""
    width = 0
    for f in schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return None
        width += 16
    return 2 * (32 + width)


def stage_append(spark: SparkSession, new: DataFrame, target: str,
                 keys: Sequence[str] | str, sequence: Sequence[str] | str,
                 partition_by: Sequence[str] | None = None, cluster_by: Sequence[str] = (),
                 holders: Callable[[DataFrame], list[str]] | None = None) -> StagedAppend:
    """Write the rows an append-new-keys load adds (S13, S16), without committing.

    On the first run that is every row, without de-duplication (S9). Otherwise the
    batch is reduced to its last row per key and staged; its row count then bounds
    the size of its keys. Within ``BROADCAST_LIMIT_BYTES`` the batch keys are
    broadcast and the stored key column is semi-joined against them where it lies --
    the stored table is not shuffled. Beyond it, the stored keys are de-duplicated
    and shuffled for a sort-merge anti join. ``holders`` may name, for a batch within
    that bound, the only files that can hold one of its keys (see ``keyindex``).

    A stored column that the batch lacks is NULL in the new rows. A column that is
    not stored (other than the sequence and ``__`` helpers) raises ``KeyError``.
    """
    parts = tuple(partition_by or ())
    base = _stored_version(spark, target, partition_by)
    if base is None:
        load = write_load(new, target, parts, cluster_by)
        schema = _nullable(_public(new).schema)
    else:
        existing = versions.read(spark, target, base)
        keys = validate_keys(new, existing, keys)
        schema = base.schema
        unknown = [c for c in _public(new).columns
                   if c not in schema.names and c not in normalize_keys(sequence)]
        if unknown:
            raise KeyError(f"columns {', '.join(unknown)} are not stored in {target}")
        latest, cols = latest_keyed(_as_stored(new, schema), keys, sequence)
        batch, batch_path = stage(spark, latest, "batch")
        n = batch.count()
        if holders and n * HASHED_KEY_BYTES <= BROADCAST_LIMIT_BYTES:
            existing = versions.read(spark, target, base, files=holders(batch))
        rows = rows_with_new_keys(batch, n, existing, keys, cols)
        load = write_load(rows.select(*[
            F.col(f"`{f.name}`") if f.name in rows.columns else
            F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]),
            target, parts, cluster_by)
        discard(spark, batch_path)
    found = Version(0, schema, parts, tuple(versions.written_parts(spark, target, load, len(parts))))
    staged = versions.read(spark, target, found)
    return StagedAppend(target, staged, load, staged.count(), base, schema, parts)


def rows_with_new_keys(batch: DataFrame, batch_rows: int, existing: DataFrame,
                       keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows of a staged, keep-last batch (with key columns ``cols``) whose key
    is not stored; picks the broadcast plan when ``batch_rows`` bounds the
    batch keys within ``BROADCAST_LIMIT_BYTES``."""
    per_row = _key_bytes_bound(batch.select(*cols).schema)
    stored = stored_key_columns(existing, keys)
    if per_row is not None and batch_rows * per_row <= BROADCAST_LIMIT_BYTES:
        hits = stored.join(F.broadcast(batch.select(*cols)), list(cols), "left_semi") \
            .dropDuplicates()
        rows = batch.join(F.broadcast(hits), list(cols), "left_anti")
    else:
        rows = batch.join(stored.dropDuplicates(), list(cols), "left_anti")
    return rows.drop(*cols)


def append_rows(spark: SparkSession, new: DataFrame, target: str,
                keys: Sequence[str] | str, sequence: Sequence[str] | str,
                partition_by: Sequence[str] | None = None) -> tuple[int, bool]:
    """Append rows whose key is new; stored rows never change.

    Returns the appended row count and whether this was the first load.
    """
    s = stage_append(spark, new, target, keys, sequence, partition_by)
    s.publish()
    return s.count, s.first


def append_load(spark: SparkSession, new: DataFrame, target: str,
                keys: Sequence[str] | str, sequence: Sequence[str] | str,
                partition_by: Sequence[str] | None = None, notes: dict | None = None) -> int:
    """Append rows whose key is new; returns the appended row count. ``notes`` are
    kept with the version."""
    s = stage_append(spark, new, target, keys, sequence, partition_by)
    s.notes = notes or {}
    return s.publish()


def upsert_load(spark: SparkSession, new: DataFrame, target: str,
                keys: Sequence[str] | str, sequence: Sequence[str] | str | None = None,
                partition_by: Sequence[str] | None = None, notes: dict | None = None) -> int:
    """Keyed upsert (S14); returns the number of rows whose key was new.

    ``new`` is staged and so evaluated once. With ``partition_by`` (which must be
    part of the key) only partitions the arriving rows touch are read, merged and
    written again; the others stay as they are in the next version. Either way the
    load shows whole or not at all.

    The table gets the union of the columns, as ``merge.upsert`` does: one that is
    new is NULL in stored rows, one that the arriving rows lack is NULL in them.
    ``notes`` are kept with the version.
    """
    keys = normalize_keys(keys)
    parts = tuple(partition_by or ())
    if not set(parts) <= set(keys):
        raise ValueError("partition columns must be part of the upsert key")
    base = _stored_version(spark, target, partition_by)
    if base is None:
        return replace_load(spark, new, target, partition_by, notes)
    validate_keys(new, versions.read(spark, target, base), keys)
    near = _touched(spark, new, target, base)
    merged = merged_with_flag(near.stored, near.arriving, keys, sequence, "__new")
    staged, path = stage(spark, merged, "upsert")
    n_new = staged.where("__new").count()
    _commit_touched(spark, target, base, near, staged, notes)
    discard(spark, path)
    return n_new


@dataclass
class _Touched:
    """Arriving rows, staged, and the stored rows of the partitions they touch."""
    arriving: DataFrame
    stored: DataFrame
    folders: set[str]
    path: str


def _touched(spark: SparkSession, new: DataFrame, target: str, base: Version) -> _Touched:
    parts = base.partition_by
    # Staged by partition, so that the folders tell which partitions are touched.
    typed, path = _as_stored(new, base.schema), scratch_path(spark, "arriving")
    (typed.hint("rebalance", *parts).write.partitionBy(*parts) if parts else typed.write).parquet(
        load_folder(path, "v-staged"))
    found = tuple(versions.written_parts(spark, path, "v-staged", len(parts)))
    arriving = versions.read(spark, path, Version(0, _nullable(typed.schema), parts, found))
    folders = {folder for _, folder in found}
    stored = versions.read(spark, target, base, [p for p in base.parts if p[1] in folders])
    return _Touched(arriving, stored, folders, path)


def _commit_touched(spark: SparkSession, target: str, base: Version, near: _Touched,
                    rows: DataFrame, notes: dict | None) -> None:
    """Commit a version in which ``rows`` take the place of the touched partitions."""
    load = write_load(rows, target, base.partition_by)
    versions.commit(
        spark, target, base, _nullable(_public(rows).schema), base.partition_by,
        [p for p in base.parts if p[1] not in near.folders]
        + versions.written_parts(spark, target, load, len(base.partition_by)),
        base.notes if notes is None else notes, base.merged)
    discard(spark, near.path)


def merge_load(spark: SparkSession, new: DataFrame, target: str,
               combine: Callable[[DataFrame, DataFrame], DataFrame],
               partition_by: Sequence[str] | None = None, notes: dict | None = None) -> None:
    """Replace the partitions that the rows ``new`` touch by ``combine(stored rows of
    these partitions, new)``, all or nothing; the whole table without partitions."""
    base = _stored_version(spark, target, partition_by)
    if base is None:
        replace_load(spark, new, target, partition_by, notes)
        return
    near = _touched(spark, new, target, base)
    _commit_touched(spark, target, base, near, combine(near.stored, near.arriving), notes)


def compact(spark: SparkSession, target: str, file_bytes: int = 128 << 20,
            cluster_by: Sequence[str] = ()) -> int:
    """Merge small files of a stored table into files of about ``file_bytes``;
    returns the number of parts rewritten.

    In each partition the parts whose files are small on average are rewritten
    together, if that gives fewer files. Rows stay the same, and readers of earlier
    versions keep their files. A version remembers which loads went into which
    (``merged``), so that what was computed from those loads stays valid.
    """
    base = versions.latest(spark, target)
    if base is None:
        return 0
    by_folder: dict[str, list[tuple[tuple[str, str], int, int]]] = {}
    for load, folder in base.parts:
        p, fs = hadoop(spark, f"{load_folder(target, load)}/{folder}".rstrip("/"))
        sizes = [s.getLen() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
        by_folder.setdefault(folder, []).append(((load, folder), len(sizes), sum(sizes)))
    chosen: list[tuple[str, str]] = []
    total = 0
    for found in by_folder.values():
        small = [(part, n, size) for part, n, size in found if size < n * file_bytes / 2]
        size = sum(x[2] for x in small)
        if sum(x[1] for x in small) > max(1, math.ceil(size / file_bytes)):
            chosen += [x[0] for x in small]
            total += size
    if not chosen:
        return 0
    rows = versions.read(spark, target, base, chosen)
    files = max(1, math.ceil(total / file_bytes))
    if base.partition_by:
        load = write_load(rows, target, base.partition_by)
    elif cluster_by:
        load = versions.new_load()
        rows.repartitionByRange(files, *cluster_by).sortWithinPartitions(*cluster_by).write.parquet(
            load_folder(target, load))
    else:
        load = write_load(rows.coalesce(files), target, ())
    sources = sorted({x for x, _ in chosen})
    versions.commit(
        spark, target, base, base.schema, base.partition_by,
        [p for p in base.parts if p not in set(chosen)]
        + versions.written_parts(spark, target, load, len(base.partition_by)),
        base.notes, base.merged | {load: sources})
    return len(chosen)
