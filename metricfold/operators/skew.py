"""Joins in which a few keys hold much of the facts.

The heavy keys are found by ``approx_top_k``, a mergeable sketch: one row per task moves, and at most
``TRACKED`` keys for each column reach the driver.  A key with more rows than an average shuffle partition is
hot.  In a join its facts get a salt (a hash of the row) and its dimension row is repeated once for each salt, so the
key's rows spread over as many partitions as their share asks for.  All other keys join as usual, in the same
join; results do not depend on which keys count as hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from metricfold.operators.joins import attach

TRACKED = 64            # heavy keys looked at per column
SPREAD = 2              # slices of a hot key for each average partition that it would fill

HotKeys = Mapping[object, int]


def hot_keys(df: DataFrame, columns: Sequence[str]) -> dict[str, HotKeys]:
    """For each column its hot keys, with the number of slices that their rows are to be cut into."""
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.expr(f"approx_top_k(`{c}`, {TRACKED})").alias(c) for c in columns]).first()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    average = row["rows"] / partitions
    return {c: {e["item"]: min(partitions, -(-SPREAD * e["count"] * partitions // row["rows"]))
                for e in row[c] or () if e["item"] is not None and e["count"] > average} for c in columns}


def _slices(key: str, hot: HotKeys, kind: DataType) -> Column:
    table = F.create_map(*[c for v, n in hot.items() for c in (F.lit(v).cast(kind), F.lit(n))])
    return F.coalesce(F.try_element_at(table, F.col(key)), F.lit(1))


def attach_spread(df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: Mapping[str, str],
                  hot: HotKeys) -> DataFrame:
    """:func:`~metricfold.operators.joins.attach` with the rows of hot keys spread over their slices."""
    if not hot:
        return attach(df, dim, key, dim_key, columns)
    kind = df.schema[key].dataType
    others = [c for c in df.columns if c != key]
    salt = F.pmod(F.xxhash64(*others), _slices(key, hot, kind)) if others else F.lit(0)
    slices = _slices("__key", hot, kind)
    side = dim.select(F.col(dim_key).cast(kind).alias("__key"), *[F.col(c).alias(out) for c, out in columns.items()]).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), slices.cast("bigint") - 1)).alias("__slice"))
    salted = df.withColumn("__salt", salt.cast("bigint"))
    return salted.join(side, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__slice")), "inner").drop(
        "__key", "__slice", "__salt")
