"""Numbers of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import stage

# monotonically_increasing_id puts the task above these bits and the row below.
ROW_BITS = 33
ROW_MASK = (1 << ROW_BITS) - 1


def with_rank(table: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """The rows with their number in the given order, from 1 on.

    The rows are sorted over all tasks and written; then only the number of rows of each
    task is added up, a row a task.
    """
    at = F.col("sorted at")
    placed = stage(
        table.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("sorted at", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("task", F.shiftright(at, ROW_BITS))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("task").agg(F.count("*").alias("own"))
    starts = counts.select("task", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("earlier"))
    place = F.col("earlier") + at.bitwiseAND(F.lit(ROW_MASK)) + 1
    return placed.join(starts, "task").withColumn(name, place).select(*table.columns, name)
