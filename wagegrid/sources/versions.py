"""Versions of a stored table: whole contents, switched by one conditional rename.

A table folder holds

* ``__load=<id>/``: the Parquet files that one load wrote, never changed again;
* ``_versions/<number>.json``: what the table is in that version: its schema, and
  its parts, each a partition folder of a load (or a whole load).

A load writes its own folder, then commits the version after the one it started
from. The commit is a rename that fails when that version exists: of two loads that
start from the same version one wins and the other raises ``ConcurrentLoadError``,
having changed nothing. Readers take the highest version when they start and go on
reading its files whatever is committed later.

A version can keep partitions of earlier loads beside those a load has rewritten, so
replacing some partitions is as much all or nothing as replacing the table.

Old versions and files go by age (``RETENTION_HOURS``), never by count alone: a
load that has written its folder and not yet committed is safe for that time. The
current version and the one before are always kept.

The rename is atomic on HDFS and, by a hard link, on a local or mounted file system.
Object stores need a Hadoop file system whose rename fails if the target exists.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

LOAD = "__load"        # the outermost folder level; tables have no such column
FOLDER = "_versions"
RETENTION_HOURS = 7 * 24
CLEAN_EVERY = 10       # commits between two cleanings

_NAME = re.compile(r"(\d{12})\.json")


class ConcurrentLoadError(RuntimeError):
    """Another load has committed since this one started; nothing was changed."""


@dataclass(frozen=True)
class Version:
    """The content of a table: ``parts`` are (load, partition folder or "")."""
    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    parts: tuple[tuple[str, str], ...]
    #: What the load that committed it noted, for instance which rows of another
    #: table the content reflects.
    notes: dict = field(default_factory=dict)
    #: Loads whose rows were merged into another load, by that load.
    merged: dict = field(default_factory=dict)

    def loads(self) -> set[str]:
        return {load for load, _ in self.parts}


def hadoop(spark: SparkSession, path: str):
    """The Hadoop path and its file system (any scheme of the cluster)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def lines(spark: SparkSession, path: str):
    """A buffered reader over a (possibly compressed) text file."""
    jvm = spark._jvm
    p, fs = hadoop(spark, path)
    stream = fs.open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsc.hadoopConfiguration()).getCodec(p)
    if codec is not None:
        stream = codec.createInputStream(stream)
    return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, None when it is empty."""
    reader = lines(spark, path)
    try:
        return reader.readLine()
    finally:
        reader.close()


def new_load() -> str:
    """A fresh name for a load."""
    return f"v-{uuid.uuid4().hex}"


def load_folder(root: str, load: str) -> str:
    return f"{root.rstrip('/')}/{LOAD}={load}"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    p, fs = hadoop(spark, f"{root.rstrip('/')}/{FOLDER}")
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(m[1]) for m in map(_NAME.fullmatch, names) if m)


def _file(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{number:012d}.json"


def version(spark: SparkSession, root: str, number: int) -> Version:
    """A version by its number."""
    said = json.loads(first_line(spark, _file(root, number)))
    return Version(number, T.StructType.fromJson(said["schema"]), tuple(said["partition_by"]),
                   tuple(map(tuple, said["parts"])), said["notes"], said["merged"])


def latest(spark: SparkSession, root: str) -> Version | None:
    """The current version, None when nothing was ever committed."""
    numbers = _numbers(spark, root)
    return version(spark, root, numbers[-1]) if numbers else None


def _rename_if_absent(spark: SparkSession, draft, target) -> bool:
    """Move ``draft`` to ``target`` in one step unless that exists."""
    jvm = spark._jvm
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        if fs.getUri().getScheme() == "file":  # a rename would replace; a link does not
            paths = [jvm.java.nio.file.Paths.get(p.toUri().getPath(),
                                                 spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
                     for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*paths)
            fs.delete(draft, False)
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, none)
        return True
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def commit(spark: SparkSession, root: str, base: Version | None, schema: T.StructType,
           partition_by: Sequence[str], parts: Iterable[tuple[str, str]],
           notes: dict | None = None, merged: dict | None = None) -> Version:
    """Make ``parts`` the version after ``base``, the one the load started from.

    Raises ``ConcurrentLoadError`` when another load has committed meanwhile.
    """
    number = base.number + 1 if base else 1
    made = Version(number, schema, tuple(partition_by), tuple(sorted(set(parts))), notes or {},
                   merged or {})
    said = {"schema": schema.jsonValue(), "partition_by": made.partition_by, "parts": made.parts,
            "notes": made.notes, "merged": made.merged, "at": int(time.time() * 1000)}
    draft, fs = hadoop(spark, f"{root.rstrip('/')}/{FOLDER}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(said).encode()))
    out.close()
    target, _ = hadoop(spark, _file(root, number))
    if not _rename_if_absent(spark, draft, target):
        raise ConcurrentLoadError(
            f"{root}: version {number} was committed by another load while this one ran; "
            "its rows are in place and this load has changed nothing. Run this load again.")
    if number % CLEAN_EVERY == 0:
        clean(spark, root)
    return made


def written_parts(spark: SparkSession, root: str, load: str, levels: int) -> list[tuple[str, str]]:
    """The parts that a load wrote: itself, or its partition folders."""
    folder = load_folder(root, load)
    if not levels:
        return [(load, "")]
    p, fs = hadoop(spark, folder + "/*" * levels)
    found = [s.getPath() for s in fs.globStatus(p) or [] if s.isDirectory()]
    out = []
    for path in found:
        names = []
        for _ in range(levels):
            names.append(path.getName())
            path = path.getParent()
        out.append((load, "/".join(reversed(names))))
    return out


def read(spark: SparkSession, root: str, at: Version,
         parts: Iterable[tuple[str, str]] | None = None, files: Sequence[str] | None = None,
         extra: dict[str, Column] | None = None) -> DataFrame:
    """The rows of a version (or of some of its parts, or files), in its columns.

    The schema is the version's, so a column that older files lack is NULL there
    and partition values have their declared types. Filters on partition columns
    prune folders. ``files`` are URIs as Spark tells them; those of other versions
    are left out. ``extra`` columns may use file metadata and the load.
    """
    root = root.rstrip("/")
    if files is not None:
        own, paths = set(at.parts), []
        for path in map(unquote, files):
            load, *folder = path.rpartition(f"/{LOAD}=")[2].split("/")[:-1]
            if (load, "/".join(folder)) in own:
                paths.append(path)
    else:
        paths = [f"{load_folder(root, load)}/{part}" if part else load_folder(root, load)
                 for load, part in (at.parts if parts is None else parts)]
    if not paths:
        return spark.createDataFrame([], at.schema)
    schema = T.StructType(at.schema.fields + [T.StructField(LOAD, T.StringType())])
    return (spark.read.schema(schema).option("basePath", root).parquet(*paths)
            .select(*[f"`{c}`" for c in at.schema.names],
                    *[c.alias(name) for name, c in (extra or {}).items()]))


def clean(spark: SparkSession, root: str, hours: float | None = None) -> list[str]:
    """Delete versions and loads older than ``hours``; returns the loads deleted.

    The current version and the one before stay, with all files they name, and so
    does every load folder changed within that time, committed or not.
    """
    limit = int((time.time() - 3600 * (RETENTION_HOURS if hours is None else hours)) * 1000)
    numbers = _numbers(spark, root)
    named: set[str] = set()
    for number in numbers:
        p, fs = hadoop(spark, _file(root, number))
        if number in numbers[-2:] or fs.getFileStatus(p).getModificationTime() > limit:
            named |= version(spark, root, number).loads()
        else:
            fs.delete(p, False)
    here, fs = hadoop(spark, root)
    gone = []
    for status in fs.listStatus(here):
        name = status.getPath().getName().partition("=")
        if name[0] == LOAD and name[2] not in named and status.getModificationTime() <= limit:
            fs.delete(status.getPath(), True)
            gone.append(name[2])
    return gone
