"""CSV scans (S1 positional typed, S2 by header name, S3 header repair) and
the CSV sink (S6).

Types are always declared; ``inferSchema`` is never used (it would turn
``08:13:31`` into a timestamp on today's date). Time columns are read as
text and parsed by the rules that use them.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EMPLOYEE_ID, EMPLOYEES, MISSPELT_EMPLOYEE_ID, TIMESHEETS_TEXT


def read_csv_positional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed scan that binds fields by position and skips each file's header.

    One malformed row fails the whole scan (FAILFAST), like a bulk COPY
    inside a transaction.
    """
    return (spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", True)
            .option("mode", "FAILFAST")
            .csv(path))


def repair_header(df: DataFrame) -> DataFrame:
    """``employe_id`` -> ``employee_id``; a no-op when the column is absent."""
    return df.withColumnRenamed(MISSPELT_EMPLOYEE_ID, EMPLOYEE_ID)


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of ``path`` by their header (the names in file order).

    Tasks read the headers, one file each and no further than its first rows; the
    driver, which has listed the files, opens none. Files without a line have none.
    """
    # A session of its own, so that these settings hold for this read alone.
    alone = spark.newSession()
    alone.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))  # no file is split
    alone.conf.set("spark.sql.files.openCostInBytes", str(1 << 60))    # one file a task
    alone.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    lines = (alone.read.text(path).select("value", "_metadata.file_path")
             .mapInArrow(first, "value string, file string"))
    found: dict[tuple[str, ...], list[str]] = {}
    for r in lines.groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files")).collect():
        header = tuple(next(csv.reader([r.value]), ()))
        if header:
            found.setdefault(header, []).extend(map(unquote, r.files))
    return found


def read_csv_named(spark: SparkSession, path: str, schema: T.StructType,
                   repair: bool = True, arrival: bool = False) -> DataFrame:
    """Scan that binds columns by header name, then casts to ``schema``.

    Files are grouped by their header, which tasks read, so files whose columns are
    in another order bind rightly; a file that lacks a declared column fails the scan.
    Every field is read as text first, the header is repaired, and each
    declared column is cast (ANSI: a malformed value fails the scan; string
    columns such as times stay text). Columns not in ``schema`` are dropped.
    """
    frames = []
    for header, files in _headers(spark, path).items():
        named = T.StructType([T.StructField(h, T.StringType()) for h in header])
        raw = (spark.read.schema(named).option("header", True).option("enforceSchema", True)
               .option("mode", "FAILFAST").csv(files))
        if arrival:
            raw = arrival_order(raw)
        if repair:
            raw = repair_header(raw)
        missing = [f.name for f in schema.fields if f.name not in raw.columns]
        if missing:
            raise KeyError(f"columns {missing} not found in the header of {files[0]}")
        cols = []
        for f in schema.fields:
            c = F.col(f"`{f.name}`")
            if not isinstance(f.dataType, T.StringType):
                c = F.when(F.trim(c) == "", F.lit(None)).otherwise(F.trim(c)).cast(f.dataType)
            cols.append(c.alias(f.name))
        if arrival:
            cols.append(F.col("__arrival"))
        frames.append(raw.select(*cols))
    if not frames:
        raise KeyError(f"no header found in {path}")
    return reduce(DataFrame.unionByName, frames)


def read_employees_csv(spark: SparkSession, path: str, by_name: bool = False,
                       arrival: bool = False) -> DataFrame:
    if by_name:
        return read_csv_named(spark, path, EMPLOYEES, arrival=arrival)
    df = read_csv_positional(spark, path, EMPLOYEES)
    return arrival_order(df) if arrival else df


def read_timesheets_csv(spark: SparkSession, path: str, by_name: bool = False,
                        arrival: bool = False) -> DataFrame:
    if by_name:
        return read_csv_named(spark, path, TIMESHEETS_TEXT, arrival=arrival)
    df = read_csv_positional(spark, path, TIMESHEETS_TEXT)
    return arrival_order(df) if arrival else df


def arrival_order(df: DataFrame, name: str = "__arrival", meta: str = "_metadata") -> DataFrame:
    """Add a sortable arrival position to rows of a file scan.

    A distributed scan has no row order, so "keep the last row" needs one
    made explicit: (file modification time, file path, split start, row
    position within the split). Rows of one split are read by one task in
    file order, so ``monotonically_increasing_id`` ranks them correctly.
    ``meta`` names the file-metadata struct (a carried copy of ``_metadata``
    for streams, where the position is taken per micro-batch).
    """
    m = F.col(meta)
    out = df.withColumn(name, F.struct(
        m.getField("file_modification_time").alias("mtime"),
        m.getField("file_path").alias("path"),
        m.getField("file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))
    return out.drop(meta) if meta != "_metadata" else out


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index, folder created, previous content replaced; NULL is
    written as an empty field. One file per task -- the folder is the table."""
    df.write.mode("overwrite").option("header", True).csv(path)
