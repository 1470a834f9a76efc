"""Mergeable aggregates.

Only additive quantities are ever produced for storage: counts, sums, and a mean
kept as ``(sum, count)``.  Such partials merge by plain ``sum`` in any order and
grouping, which is what makes increments composable.  All aggregates here plan
as a partial (map-side) plus final hash aggregate, so a hot key is combined
inside each task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricfold.functions.columns import percent_of, ratio


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Row count per key tuple (``GROUP BY keys``, ``count(*)``).  [A1, A2]"""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str | Column]) -> DataFrame:
    """Sum of each expression per key tuple; ``sums`` maps output name -> column."""
    aggs = [F.sum(F.col(c) if isinstance(c, str) else c).alias(out) for out, c in sums.items()]
    return df.groupBy(*keys).agg(*aggs)


def mean_parts(df: DataFrame, keys: Sequence[str], value: str | Column,
               sum_name: str = "value_sum", count_name: str = "value_count") -> DataFrame:
    """Mean kept as mergeable parts: sum and non-null count of ``value`` per key.  [A3]"""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(
        F.sum(v).alias(sum_name), F.count(v).alias(count_name)
    )


def mean_from_parts(df: DataFrame, sum_name: str, count_name: str, out: str) -> DataFrame:
    """Replace ``(sum, count)`` by their quotient (null when the count is 0)."""
    return df.withColumn(out, ratio(sum_name, count_name)).drop(sum_name, count_name)


def count_non_null(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per category, the null category dropped.  [A4]

    The null filter runs before the shuffle, so rows without a category never
    leave their task.
    """
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.col(key)).alias(name))


def column_totals(df: DataFrame, columns: Sequence[str], cast: str | None = "bigint") -> DataFrame:
    """One row with the total of each column, computed in a single pass.  [A5]"""
    aggs = []
    for c in columns:
        total = F.sum(F.col(c))
        aggs.append((total.cast(cast) if cast else total).alias(c))
    return df.agg(*aggs)


def union_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name (never by position).  [U1]"""
    return reduce(lambda a, b: a.unionByName(b), parts)


def merge_sums(parts: DataFrame | Iterable[DataFrame], keys: Sequence[str],
               sums: Sequence[str]) -> DataFrame:
    """Re-aggregate additive partials: ``UNION ALL`` then ``sum`` per key.  [A6, A7, U1]

    With no keys this is a global total.  Integer sums stay integers.
    """
    df = parts if isinstance(parts, DataFrame) else union_parts(parts)
    aggs = [F.sum(F.col(c)).alias(c) for c in sums]
    if keys:
        return df.groupBy(*keys).agg(*aggs)
    return df.agg(*aggs)


def share_of_total(totals: DataFrame, columns: Mapping[str, str], label: str = "reason",
                   value: str = "percent") -> DataFrame:
    """Per-column share (in percent) of the grand total, wide row -> long rows.  [A8]

    ``totals`` holds one or more rows of per-column totals (for example one row
    per stored increment); ``columns`` maps output label -> column name.  The
    totals are summed, each share is computed inside the single resulting row,
    and ``stack`` turns the row into one row per label: no join, no window and no
    round trip through the driver.
    """
    names = list(columns.values())
    merged = totals.agg(*[F.sum(F.col(c)).alias(c) for c in names])
    grand = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in names])
    any_present = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in names])
    grand = F.when(any_present, grand)
    shares = merged.select(*[percent_of(F.col(c), grand).alias(c) for c in names])
    pairs = ", ".join(f"'{lbl}', `{c}`" for lbl, c in columns.items())
    return shares.select(
        F.expr(f"stack({len(columns)}, {pairs})").alias(label, value)
    )
