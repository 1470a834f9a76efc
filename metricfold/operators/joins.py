"""Joins between aggregated facts and dimension tables.

How a side moves is left to Spark: it broadcasts a side whose size it knows to be under its own
thresholds (``spark.sql.autoBroadcastJoinThreshold``, and at run time the adaptive one) and
shuffles both otherwise, where AQE splits skewed partitions.  Where facts can be reduced to the
join key alone, :func:`roll_up` aggregates them on it *before* the join, so that the shuffle
carries one row per key and task instead of one per fact row, a hot key's included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def attach(df: DataFrame, dim: DataFrame, key: str, dim_key: str,
           columns: Mapping[str, str]) -> DataFrame:
    """Inner-join ``dim`` attributes onto ``df`` by ``key = dim_key``.  [J1-J4]

    ``columns`` maps dimension column -> output name; dimension columns are renamed
    before the join so same-named columns on both sides never clash.  Rows
    without a dimension match are dropped (inner join).
    """
    right_key = f"__{dim_key}"
    side = dim.select(F.col(dim_key).alias(right_key),
                      *[F.col(c).alias(out) for c, out in columns.items()])
    return df.join(side, F.col(key) == F.col(right_key), "inner").drop(right_key)


def with_dimension(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` the dimension has: those that :func:`attach` keeps, once each."""
    side = dim.select(F.col(dim_key).alias(f"__{dim_key}"))
    return df.join(side, F.col(key) == F.col(f"__{dim_key}"), "left_semi")


def roll_up(df: DataFrame, key: str, dim: DataFrame, dim_key: str,
            attrs: Mapping[str, str], sums: Sequence[str], pre_aggregate: bool = True) -> DataFrame:
    """Swap fact key ``key`` for dimension attributes ``attrs`` (inner join).

    ``df`` holds additive columns ``sums`` next to key columns.  The result has the
    same columns with ``key`` replaced by ``attrs.values()``; the caller aggregates once
    more at the end.  With ``pre_aggregate`` the facts are first summed per key tuple,
    which pays off when many fact rows share one.
    """
    others = [c for c in df.columns if c not in sums and c != key]
    facts = df.groupBy(key, *others).agg(*[F.sum(c).alias(c) for c in sums]) if pre_aggregate and sums else df
    return attach(facts, dim, key, dim_key, attrs).select(*others, *attrs.values(), *sums)


def limit_then_join(df: DataFrame, order: Sequence[Column], n: int, dim: DataFrame,
                    key: str, dim_key: str, columns: Mapping[str, str]) -> DataFrame:
    """Take the first ``n`` rows of ``df`` by ``order``, then attach names.  [J6, T3]

    The limit runs first (``TakeOrderedAndProject``: a per-task heap of ``n`` rows,
    merged on the driver), so the join sees at most ``n`` rows and the dimension
    side is the only large input.  Rows whose key has no dimension match are lost
    *after* the cut, so fewer than ``n`` rows can come back.
    """
    head = F.broadcast(df.orderBy(*order).limit(n))       # n rows at most
    return attach(head, dim, key, dim_key, columns)


def merge_join(left: DataFrame, right: DataFrame, on: Column | str | Sequence[str],
               how: str = "inner") -> DataFrame:
    """Join forced to a shuffle sort-merge join for this join only.  [J7]

    A per-join hint replaces turning off automatic broadcast for the whole session.
    """
    return left.hint("merge").join(right, on, how)


def attach_where(df: DataFrame, some: Column, dim: DataFrame, key: str, dim_key: str,
                 columns: Mapping[str, str]) -> DataFrame:
    """:func:`attach` for the rows that ``some`` names: of these, rows without a match go.  The others stay, with nulls."""
    known = dim.select(F.col(dim_key).alias("__key"), F.lit(True).alias("__known"),
                       *[F.col(c).alias(out) for c, out in columns.items()])
    joined = df.join(known, (F.col(key) == F.col("__key")) & some, "left")
    return joined.filter(~some | F.col("__known")).drop("__key", "__known")


def side_by_side(df: DataFrame, keys: Sequence[str], columns: Sequence[tuple[Column, str, str]]) -> DataFrame:
    """A long list of several kinds of rows, laid side by side: one row for each ``keys``.  [J5, re-aimed]

    ``columns`` holds (condition of the kind, column, output name).  Each kind has at most one row for a key, so the
    output is linear in the input, never a product, and one aggregate replaces an outer join of the lists.
    """
    return df.groupBy(*keys).agg(*[F.max(F.when(kind, F.col(c))).alias(out) for kind, c, out in columns])
