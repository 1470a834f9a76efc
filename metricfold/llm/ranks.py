"""Row positions over a whole table, without a window over it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_BITS = 33           # monotonically_increasing_id counts a task's rows in its low 33 bits


def ranked(df: DataFrame, order: Sequence[Column], save: Callable[[DataFrame, str], DataFrame],
           label: str = "ranked") -> DataFrame:
    """``df`` with ``part`` (its range of the order) and ``position`` (from 0, in ``order``).

    Rows are dealt to ranges of ``order`` and sorted there, the sorted ranges are written, and each range's
    first position is the sum of the earlier ranges' counts.  Rows that are equal in ``order`` may part: a
    last order column numbers the scanned rows, so very many equal rows do not meet in one task.
    """
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    by = [*order, F.col("__row")]
    placed = save(numbered.repartitionByRange(*by).sortWithinPartitions(*by).drop("__row").select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("__at")), label)
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("__n"))
    # One row for each task of the sort in this window.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(F.col("part").alias("__part"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__begin"))
    return placed.join(begins, F.col("part") == F.col("__part")).withColumn("position", F.col("__begin") + F.col("__at")).drop(
        "__part", "__begin", "__at")
