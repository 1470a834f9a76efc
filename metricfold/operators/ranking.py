"""Ranks, per-group top-k and top-N.

Windows here always run on *aggregated* rows (one row per group member, e.g. a
carrier within an origin), never on raw fact rows, so a window partition is
bounded by the number of distinct members, not by how many facts a hot key has.
Where even the members of one group are too many for a task, ``rank_spread`` ranks them in ranges.
A rank filter (``rank <= k``) is planned by Spark as a partial + final
``WindowGroupLimit``, which trims each group inside the task before the
shuffle.  Whole-table top-N is ``orderBy(...).limit(n)``, planned as
``TakeOrderedAndProject`` (a bounded heap per task).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIRECTIONS = ("asc", "desc")


def check_direction(direction: str) -> str:
    d = (direction or "").strip().lower()
    if d not in DIRECTIONS:
        raise ValueError(f"sort direction must be 'asc' or 'desc', not {direction!r}")
    return d


def ordered(column: str | Column, direction: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.desc() if check_direction(direction) == "desc" else c.asc()


def rank_within(df: DataFrame, partition: Sequence[str], by: str, out: str = "rank",
                direction: str = "desc") -> DataFrame:
    """Dense rank (int) of each row within ``partition`` ordered by ``by``.  [W2, W3]"""
    w = Window.partitionBy(*partition).orderBy(ordered(by, direction))
    return df.withColumn(out, F.dense_rank().over(w))


def rank_spread(df: DataFrame, partition: Sequence[str], by: str, save: Callable[[DataFrame, str], DataFrame],
                out: str = "rank", direction: str = "desc") -> DataFrame:
    """:func:`rank_within` for groups of any size: no task holds a whole group.  [W2, W3]

    Rows are dealt to ranges of (group, value, row) and written with their range's number.  Each range ranks its
    own part of a group; the ranks go on from the number of distinct values in the group's
    earlier ranges, less one wherever a value reaches from one range into the next.
    """
    value = F.struct(F.col(by).isNotNull().alias("known"), F.col(by).alias("value"))    # null is the smallest
    others = [c for c in df.columns if c not in (*partition, by)]
    dealt = df.repartitionByRange(*partition, ordered(by, direction), *others)
    placed = save(dealt.withColumn("__part", F.spark_partition_id()), "ranges")
    group = ["__part", *partition]
    first, last = (F.min, F.max) if check_direction(direction) == "asc" else (F.max, F.min)
    ends = placed.select(*group, value.alias("__value")).distinct().groupBy(*group).agg(
        F.count(F.lit(1)).alias("__values"), first("__value").alias("__first"), last("__value").alias("__last"))
    # One row for each range that a group reaches into.
    along = Window.partitionBy(*partition).orderBy("__part")
    goes_on = F.coalesce(F.lag("__last").over(along).eqNullSafe(F.col("__first")), F.lit(False)).cast("int")
    ends = ends.withColumn("__goes_on", goes_on)
    before = (F.coalesce(F.sum("__values").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
              - F.sum("__goes_on").over(along))
    begins = ends.select(*[F.col(c).alias(f"__of_{c}") for c in group], before.alias("__before"))
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in group]
    local = F.dense_rank().over(Window.partitionBy(*group).orderBy(ordered(by, direction)))
    return placed.withColumn("__local", local).join(begins, same).select(
        *df.columns, (F.col("__local") + F.col("__before")).cast("int").alias(out))


def top_per_group(df: DataFrame, partition: Sequence[str], by: str, k: int | None,
                  out: str = "rank", direction: str = "desc") -> DataFrame:
    """Rows whose dense rank within ``partition`` is at most ``k`` (ties kept).  [W4]

    ``k=None`` keeps every row (ranked).
    """
    ranked = rank_within(df, partition, by, out, direction)
    return ranked if k is None else ranked.filter(F.col(out) <= k)


def position_within(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                    out: str = "position") -> DataFrame:
    """1-based row position within ``partition``; ``order`` must be a total order."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w))


def top_n(df: DataFrame, by: Sequence[str | Column], n: int | None, direction: str = "desc",
          tie_break: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows ordered by ``by`` in ``direction``.  [T1-T3]

    ``tie_break`` columns (ascending) are appended so that rows tied at the cut-off
    are chosen deterministically.  ``n=None`` returns every row, unsorted (the full
    result: ordering it would only add a shuffle).
    """
    check_direction(direction)
    if n is None:
        return df
    if n < 0:
        raise ValueError("n must be >= 0")
    order = [ordered(c, direction) for c in by] + [F.col(c).asc() for c in tie_break]
    return df.orderBy(*order).limit(n)


def sort_all(df: DataFrame, by: Sequence[str | Column], direction: str = "asc") -> DataFrame:
    """Full sort (range-partitioned shuffle; no single-partition step).  [T4]"""
    return df.orderBy(*[ordered(c, direction) for c in by])
