"""A left join whose hot keys are spread over many tasks.

Which keys are hot is told by a frequent-items aggregate with a bounded state,
combined before it moves. Only their rows get a salt: left rows one of a key's
salts, right rows all of them. The other keys join as they are. Rows without a key
match nothing and are spread as well.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = 8  # parts of a task's fair share that a hot key is cut into


def hot_keys(rows: DataFrame, key: str, tasks: int) -> list[tuple[object, int]]:
    """Keys with more than a ``PIECES``-th of a task's fair share of the rows, and
    into how many such pieces each is cut: at most ``PIECES * tasks`` keys, or 100,000
    where there are more tasks (and larger pieces)."""
    most = min(PIECES * tasks, 100_000)  # the most that the aggregate can return
    found = rows.selectExpr(f"approx_top_k(`{key}`, {most}, {4 * most}) AS top",
                            f"count(`{key}`) AS n").first()
    piece = max(found.n / most, 1)
    return [(x["item"], math.ceil(x["count"] / piece)) for x in found.top or []
            if x["item"] is not None and x["count"] > piece]


def left_join_spread(left: DataFrame, right: DataFrame, key: str, also: Sequence[str] = (),
                     tasks: int | None = None) -> DataFrame:
    """``left.join(right, [key, *also], "left")`` in which no key's rows meet in one task.

    ``tasks`` is the number of tasks to spread over (the session's shuffle
    partitions). ``left`` is read twice: once for its column ``key`` alone, by which
    hot rows are told (``also`` holds further columns that must be equal).
    """
    spark = left.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, key, tasks)
    kind = left.schema[key].dataType.simpleString()
    pieces = F.broadcast(spark.createDataFrame(hot, f"`{key}` {kind}, __pieces int"))
    number = F.monotonically_increasing_id()
    salted = left.join(pieces, key, "left").withColumn("__salt", F.when(
        F.col(key).isNull(), number % (PIECES * tasks)).otherwise(
        number % F.coalesce("__pieces", F.lit(1))))
    copies = right.join(pieces, key, "left").withColumn("__salt", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.coalesce("__pieces", F.lit(1)).cast("bigint") - 1)))
    return (salted.drop("__pieces").join(copies.drop("__pieces"), [key, *also, "__salt"], "left")
            .drop("__salt"))
