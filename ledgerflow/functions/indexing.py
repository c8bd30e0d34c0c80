"""Dense 0-based row index in a given order, without a single-task window.

A window without ``partitionBy`` would pull every row into one task.
Here the rows are range-sorted (a distributed sort), each task counts
its rows, the per-task offsets are a running sum over one row per task,
and every row adds its position inside its task.  The offsets table has
exactly one row per task, so broadcasting it is bounded by the task
count, not by the data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def with_dense_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """``df`` plus ``name``: 0, 1, 2, ... following ``order`` (a unique key).

    The input is staged, as the range sort reads it twice (a sample, then
    the rows), and so are the sorted rows, so that the count and the
    numbering see the same task layout.  The sort runs once, here; no
    copy stays in executor memory.
    """
    sorted_rows = stage(stage(df, "index-input").orderBy(*order).select(
        "*",
        F.spark_partition_id().alias("_task"),
        F.monotonically_increasing_id().alias("_mid"),
    ), "index-sorted")
    per_task = sorted_rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    offsets = per_task.select(
        "_task",
        (F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"),
    ).fillna({"_offset": 0})
    # position inside a task: the id's low 33 bits
    position = F.col("_mid") - F.shiftleft(F.col("_task").cast("long"), 33)
    return (sorted_rows.join(F.broadcast(offsets), "_task")
            .select(*df.columns, (F.col("_offset") + position).alias(name)))
