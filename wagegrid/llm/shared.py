"""Shared-folder tables and small Arrow helpers used by the operators."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..config import checkpoint_dir

# When set, Spark drops an execution's shuffle files as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Parquet looks at the size of what it holds after 100 rows only; with rows of
# megabytes, row groups and pages of hundreds of them. Then writers hold that, and
# readers, and each (de)compressor has a page outside the heap.
_WIDE = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1",
         "parquet.page.size.row.check.min": "1"}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh location below the folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors (once per application).

    The zip goes to the shared folder and from there to every Python worker.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(top)))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_path(spark, 'package')}.zip")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(data.getvalue())
    stream.close()
    sc.addPyFile(path.toString())
    _SHIPPED.add(sc.applicationId)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def store(df: DataFrame, name: str, by: tuple[str, ...] = (), wide: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder, with a folder for each
    value of the columns ``by``, and read it back. ``wide``: a row can have megabytes,
    so sizes are looked at after every row.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    The shuffle files behind the table are released once it is written.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    with _setting(spark, _CLEANUP, "true"):
        out = df.write.partitionBy(*by) if by else df.write
        out.options(**(_WIDE if wide else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``store`` that no later step reads."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; a null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]
