"""Data-quality checks as single-pass aggregates.

Verdicts the workload printed as text are boolean columns here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import scratch_path
from ..functions.timeofday import parse_time


def _seconds(df: DataFrame, name: str, coerce: bool = True) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_time(f"`{name}`", coerce=coerce)
    return F.col(name).cast("bigint")


def _missing(df: DataFrame, name: str, coerce: bool) -> Column:
    """NULL test; with ``coerce`` a text time that does not parse counts as
    missing (the check-in column was coerced before the check in one form)."""
    if coerce and isinstance(df.schema[name].dataType, T.StringType):
        return _seconds(df, name, coerce=True).isNull()
    return F.col(name).isNull()


def missing_either(timesheets: DataFrame, coerce_checkin: bool = False) -> DataFrame:
    """Rows with a missing check-in or check-out."""
    return timesheets.filter(_missing(timesheets, "checkin", coerce_checkin)
                             | F.col("checkout").isNull())


def missing_both(timesheets: DataFrame, coerce_checkin: bool = False) -> DataFrame:
    """Rows with both times missing."""
    return timesheets.filter(_missing(timesheets, "checkin", coerce_checkin)
                             & F.col("checkout").isNull())


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows under an explicit order (O3; a top-k, planned as
    TakeOrderedAndProject: each task keeps its n best rows, one final task
    merges those few)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def duplicate_check(df: DataFrame, column: str, raw_name: str | None = None,
                    unique_name: str | None = None) -> DataFrame:
    """count(col), count(distinct col) and the duplicate verdict (A4 + P9).

    NULLs are skipped by both counts. The distinct count is planned as a
    two-phase aggregate (keys de-duplicated map-side, then shuffled).
    """
    raw_name = raw_name or f"raw_{column}"
    unique_name = unique_name or f"unique_{column}"
    return (df.agg(F.count(column).alias(raw_name),
                   F.count_distinct(column).alias(unique_name))
              .withColumn("has_duplicates", F.col(raw_name) > F.col(unique_name)))


def checkin_range(timesheets: DataFrame) -> DataFrame:
    """Latest and earliest check-in as seconds of day (A5)."""
    s = _seconds(timesheets, "checkin")
    return timesheets.agg(F.max(s).alias("max_checkin"), F.min(s).alias("min_checkin"))


def missing_flags(timesheets: DataFrame, coerce_checkin: bool = False) -> DataFrame:
    """Counts of rows missing one or both times and their verdicts."""
    ci, co = _missing(timesheets, "checkin", coerce_checkin), F.col("checkout").isNull()
    return (timesheets.agg(F.count_if(ci | co).alias("missing_either"),
                           F.count_if(ci & co).alias("missing_both"))
            .withColumn("has_missing_either", F.col("missing_either") > 0)
            .withColumn("has_missing_both", F.col("missing_both") > 0))


def quality_report(timesheets: DataFrame, employees: DataFrame,
                   coerce_checkin: bool = False) -> DataFrame:
    """All checks in one pass per table, one row per table (Q4).

    Columns: table_name, raw_ids, unique_ids, has_duplicates, missing_either,
    missing_both, min_checkin, max_checkin (time columns NULL for employees).
    """
    ci, co = _missing(timesheets, "checkin", coerce_checkin), F.col("checkout").isNull()
    s = _seconds(timesheets, "checkin")
    ts = timesheets.agg(
        F.lit("timesheets").alias("table_name"),
        F.count("timesheet_id").alias("raw_ids"),
        F.count_distinct("timesheet_id").alias("unique_ids"),
        F.count_if(ci | co).alias("missing_either"),
        F.count_if(ci & co).alias("missing_both"),
        F.min(s).alias("min_checkin"),
        F.max(s).alias("max_checkin"),
    )
    emp = employees.agg(
        F.lit("employees").alias("table_name"),
        F.count("employee_id").alias("raw_ids"),
        F.count_distinct("employee_id").alias("unique_ids"),
        *[F.lit(None).cast("bigint").alias(c) for c in
          ("missing_either", "missing_both", "min_checkin", "max_checkin")],
    )
    return (ts.unionByName(emp)
              .withColumn("has_duplicates", F.col("raw_ids") > F.col("unique_ids")))


DESCRIBE_STATS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear), max per column.

    Exact at every size, the input is evaluated once. Values are counted first
    (a value that many rows share becomes one row before the shuffle), then
    dealt over ranges and stored; sums of the counts per range, a small table,
    give every value its rank, and the quartiles are the smallest values whose
    rank exceeds the wanted ones. A column without values has count 0 and NULL
    statistics.
    """
    spark = df.sparkSession
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    counted = (df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, x)")
               .where("x IS NOT NULL").groupBy("column_name", "x").agg(F.count("*").alias("n")))
    path = scratch_path(spark, "describe")
    (counted.repartitionByRange("column_name", "x")
     .withColumn("part", F.spark_partition_id()).write.parquet(path))
    values = spark.read.parquet(path)
    earlier = Window.partitionBy("column_name").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = (values.groupBy("column_name", "part").agg(F.sum("n").alias("n"))
            .select("column_name", "part",
                    F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    inside = Window.partitionBy("column_name", "part").orderBy("x")
    whole = values.groupBy("column_name").agg(
        F.sum("n").alias("count"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"))
    ranked = (values.join(sums, ["column_name", "part"])
              .withColumn("upto", F.col("before") + F.sum("n").over(inside))
              .join(whole, "column_name"))
    wanted = {name: F.lit(q) * (F.col("count") - 1) for name, q in QUARTILES.items()}

    def at(rank: Column, name: str) -> Column:
        return F.min(F.when(F.col("upto") > rank, F.col("x"))).alias(name)

    stats = ranked.groupBy("column_name", "count", "mean").agg(
        F.sum(F.col("n") * F.pow(F.col("x") - F.col("mean"), 2)).alias("squares"),
        F.min("x").alias("min"), F.max("x").alias("max"),
        *[at(F.floor(r), f"{name}_low") for name, r in wanted.items()],
        *[at(F.ceil(r), f"{name}_high") for name, r in wanted.items()])
    low, high = (lambda k: F.col(f"{k}_low")), (lambda k: F.col(f"{k}_high"))
    names = spark.range(len(columns)).select(
        F.element_at(F.array(*[F.lit(c) for c in columns]),
                     (F.col("id") + 1).cast("int")).alias("column_name"))
    return names.join(stats, "column_name", "left").select(
        "column_name", F.coalesce("count", F.lit(0)).alias("count"), "mean",
        F.sqrt(F.try_divide("squares", F.col("count") - 1)).alias("std"), "min",
        *[(low(k) + (high(k) - low(k)) * (r - F.floor(r))).alias(k) for k, r in wanted.items()],
        "max")
