"""Top-1-per-key selection: latest employee record (W1/W2), keep-last.

Written as ``row_number() OVER (PARTITION BY keys ORDER BY ...) = 1`` so that
Catalyst plans a ``WindowGroupLimit``: a partial top-1 runs *before* the
shuffle, so a key holding a third of all rows is cut to one row per input
partition before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows ranked first within each key under ``order`` (P7: keep rank 1).

    ``order`` items are Columns or SQL sort items such as ``"d DESC NULLS LAST"``.
    """
    keys = normalize_keys(keys)
    if all(isinstance(o, str) for o in order):
        part = ", ".join(f"`{k}`" for k in keys)
        ranked = df.selectExpr(
            "*", f"row_number() OVER (PARTITION BY {part} ORDER BY {', '.join(order)}) AS {_RANK}")
    else:
        w = Window.partitionBy(*keys).orderBy(*order)
        ranked = df.withColumn(_RANK, F.row_number().over(w))
    return ranked.filter(f"{_RANK} = 1").drop(_RANK)


def employee_order(nulls_first: bool) -> list[str]:
    """join_date DESC, salary DESC, then branch_id and resign_date as tie-breaks."""
    nulls = "NULLS FIRST" if nulls_first else "NULLS LAST"
    return [f"`{c}` DESC {nulls}" for c in ("join_date", "salary", "branch_id", "resign_date")]


def latest_employee(employees: DataFrame, nulls_first: bool) -> DataFrame:
    """One record per employee_id: the latest join_date, then highest salary.

    ``nulls_first=True`` places NULL dates/salaries first in the descending
    order (SQL-engine order, W1); ``False`` places them last (dataframe-library
    order, W2).
    """
    return top_per_key(employees, ["employee_id"], employee_order(nulls_first))


def keep_last(df: DataFrame, keys: Sequence[str] | str, sequence: Sequence[str] | str) -> DataFrame:
    """Keep the last row per key in arrival order.

    Arrival order is not a property of a distributed scan, so it must be
    given as ``sequence`` columns (higher = later).
    """
    seq = normalize_keys(sequence)
    return top_per_key(df, keys, [f"`{c}` DESC NULLS LAST" for c in seq])


def normalize_keys(keys: Sequence[str] | str) -> list[str]:
    """A scalar key becomes a one-element list."""
    if isinstance(keys, str):
        return [keys]
    keys = list(keys)
    if not keys:
        raise ValueError("at least one key column is required")
    return keys
