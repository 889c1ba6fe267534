"""Incremental load operators (U1, U3/J3, S13-S17, W3 across two sources).

Two load behaviours exist in the workload:

* **append new keys** (S13): the arriving rows, last one per key, whose key
  is not yet stored are appended; stored rows are never changed;
* **keyed upsert** (S14): stored and arriving rows are combined and the last
  row per key wins (arriving rows after stored ones), replacing the table.

Both report the number of rows whose key is new (S16). Keys match NULL-safely
(a NULL key present on both sides counts as present).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedupe import normalize_keys, top_per_key

SOURCE = "__source"


def validate_keys(new: DataFrame, existing: DataFrame, keys: Sequence[str] | str) -> list[str]:
    """All keys must exist on both sides (S15); returns the key list."""
    keys = normalize_keys(keys)
    for side, df in (("arriving", new), ("stored", existing)):
        absent = [k for k in keys if k not in df.columns]
        if absent:
            raise KeyError(f"key columns absent from the {side} rows: {', '.join(absent)}")
    return keys


def union_all(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stack two frames by column name; a column missing on one side is NULL."""
    return existing.unionByName(new, allowMissingColumns=True)


def _zero(dtype: T.DataType) -> str:
    if isinstance(dtype, T.NumericType):
        return f"CAST(0 AS {dtype.simpleString()})"
    if isinstance(dtype, T.StringType):
        return "''"
    if isinstance(dtype, T.BooleanType):
        return "false"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return f"CAST('1970-01-01' AS {dtype.simpleString()})"
    raise TypeError(f"unsupported key type {dtype.simpleString()}")


def with_key_columns(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add NULL-safe key columns: ``coalesce(k, zero)`` and ``k IS NULL``.

    Equal pairs mean equal keys, NULL included, and the pairs themselves are
    never NULL, so plain equi-joins on them are NULL-safe joins. Using the
    same columns to partition the top-1 window and to join lets the join
    reuse the window's partitioning instead of shuffling again.
    """
    exprs, cols = [], []
    for i, k in enumerate(keys):
        zero = _zero(df.schema[k].dataType)
        exprs += [f"coalesce(`{k}`, {zero}) AS __key{i}", f"`{k}` IS NULL AS __null{i}"]
        cols += [f"__key{i}", f"__null{i}"]
    return df.selectExpr("*", *exprs), cols


def latest_keyed(new: DataFrame, keys: Sequence[str], sequence) -> tuple[DataFrame, list[str]]:
    """Last row per key (keep-last), with its NULL-safe key columns."""
    keyed, cols = with_key_columns(new, keys)
    order = [f"`{c}` DESC NULLS LAST" for c in normalize_keys(sequence)]
    return top_per_key(keyed, cols, order), cols



def stored_key_columns(existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The NULL-safe key columns of a stored table (only its key columns are read)."""
    keyed, cols = with_key_columns(existing.select(*keys), keys)
    return keyed.select(*cols)


def _stored_keys(existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Only the key columns of the stored table move; duplicates are removed
    # map-side first (partial aggregation) so the shuffle carries distinct keys.
    return stored_key_columns(existing, keys).dropDuplicates()


def append_new_keys(new: DataFrame, existing: DataFrame, keys: Sequence[str] | str,
                    sequence: Sequence[str] | str) -> DataFrame:
    """Rows to append (S13): last arriving row per key, key not yet stored.

    Equal to taking the last row per key of (stored ++ arriving) and keeping
    the keys that were not stored, without shuffling the stored rows -- only
    their distinct keys.
    """
    keys = validate_keys(new, existing, keys)
    latest, cols = latest_keyed(new, keys, sequence)
    return latest.join(_stored_keys(existing, keys), cols, "left_anti").drop(*cols)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str] | str,
           sequence: Sequence[str] | str | None = None) -> DataFrame:
    """The merged table of a keyed upsert (S14): last row per key wins.

    Arriving rows come after stored rows; within a source ``sequence``
    orders arrival. Without a sequence, the remaining columns break ties so
    the result is deterministic.
    """
    keys = validate_keys(new, existing, keys)
    both = union_all(existing.withColumn(SOURCE, F.lit(0)), new.withColumn(SOURCE, F.lit(1)))
    seq = normalize_keys(sequence) if sequence is not None else \
        [c for c in both.columns if c not in keys and c != SOURCE]
    order = [f"{SOURCE} DESC"] + [f"`{c}` DESC NULLS LAST" for c in seq]
    return top_per_key(both, keys, order).drop(SOURCE)


def merged_with_flag(existing: DataFrame, new: DataFrame, keys: Sequence[str] | str,
                     sequence: Sequence[str] | str | None, flag: str) -> DataFrame:
    """``upsert`` plus a column telling whether the key is new.

    One aggregation per key (NULL keys form one group): the last row, and the
    smallest source. Rows of a hot key are combined before the shuffle. The
    columns are those of both sides, the stored ones first.
    """
    keys = validate_keys(new, existing, keys)
    both = union_all(existing.withColumn(SOURCE, F.lit(0)), new.withColumn(SOURCE, F.lit(1)))
    rest = [c for c in both.columns if c not in keys and c != SOURCE]
    seq = normalize_keys(sequence) if sequence is not None else rest
    # Struct order puts NULL first, so the largest is "last, NULLs before values".
    order = F.struct(SOURCE, *[F.col(f"`{c}`") for c in seq])
    last = (both.groupBy(*[F.col(f"`{k}`") for k in keys])
            .agg(F.max_by(F.struct(F.col(SOURCE).alias("__last"), *[F.col(f"`{c}`") for c in rest]),
                          order).alias("__row"),
                 F.min(SOURCE).alias(SOURCE)))
    return last.select(*[F.col(f"`{k}`") if k in keys else F.col("__row").getField(k).alias(k)
                         for k in both.columns if k != SOURCE], (F.col(SOURCE) == 1).alias(flag))


def load_counts(new: DataFrame, existing: DataFrame, keys: Sequence[str] | str,
                sequence: Sequence[str] | str) -> DataFrame:
    """Rows whose key is new (S16, the number the workload reports) and rows
    whose key was already stored (updated by an upsert, ignored by append)."""
    keys = validate_keys(new, existing, keys)
    latest, cols = latest_keyed(new, keys, sequence)
    stored = _stored_keys(existing, keys).withColumn("__hit", F.lit(True))
    flagged = latest.join(stored, cols, "left")
    return flagged.agg(F.count_if(F.col("__hit").isNull()).alias("new_keys"),
                       F.count_if(F.col("__hit")).alias("matched_keys"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication."""
    return df.distinct()
