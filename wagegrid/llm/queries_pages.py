"""Registered queries over pages: WARC archives written and read back, URL filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import linkgraph
from .shared import shared_path
from .warc import read_records, write_archives


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, read back from the archives by its index."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = shared_path(spark, "warc")
    index = write_archives(pages, folder, min_revisit=1000)
    return read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


# The rules of the registered query: host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return linkgraph.judge(pages, rules)
