"""First reduction of fact rows, alone or for several metrics in one scan.

A :class:`Reduction` groups (some of) the rows by keys and sums whole numbers.  Metrics that read the same
rows are reduced together: each row becomes one tagged row for every reduction whose condition it meets
(metric, that metric's key struct, its sums), and one aggregate over (metric, keys) serves them all, with
one scan, one partial aggregation inside the tasks and one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG = "metric"


@dataclass(frozen=True)
class Reduction:
    """Column expressions by output name, built when they are used (they need a session)."""
    keys: Callable[[], Mapping[str, Column]]            # empty: one row for all
    sums: Callable[[], Mapping[str, Column]]            # bigint sums
    where: Callable[[], Column] | None = None           # rows that count (null: not)


def _summed(sums: Mapping[str, Column]) -> list[Column]:
    return [F.sum(c.cast("bigint")).alias(name) for name, c in sums.items()]


def reduced(df: DataFrame, r: Reduction) -> DataFrame:
    """``keys + sums`` of one reduction.  Without keys one row, of nulls where no row counts."""
    rows = df if r.where is None else df.filter(r.where())
    keys = [c.alias(name) for name, c in r.keys().items()]
    return rows.groupBy(*keys).agg(*_summed(r.sums())) if keys else rows.agg(*_summed(r.sums()))


def _key_struct(r: Reduction) -> Column:
    return F.struct(*[c.alias(name) for name, c in r.keys().items()] or [F.lit(True).alias("all")])


def reduced_together(df: DataFrame, reductions: Mapping[str, Reduction]) -> DataFrame:
    """``metric``, a key struct ``k0, k1, ...`` for each reduction (null in the rows of the others) and the sums
    ``s0, s1, ...`` of the row's own reduction; ``unpacked`` takes one of them out."""
    width = max(len(r.sums()) for r in reductions.values())
    types = [df.select(_key_struct(r).alias("k")).schema["k"].dataType for r in reductions.values()]

    def tagged(place: int, name: str, r: Reduction) -> Column:
        keys = [(_key_struct(r) if i == place else F.lit(None).cast(t)).alias(f"k{i}") for i, t in enumerate(types)]
        own = list(r.sums().values())
        sums = [(own[j].cast("bigint") if j < len(own) else F.lit(None).cast("bigint")).alias(f"s{j}") for j in range(width)]
        entry = F.struct(F.lit(name).alias(TAG), *keys, *sums)
        return entry if r.where is None else F.when(r.where(), entry)

    entries = F.array(*[tagged(i, name, r) for i, (name, r) in enumerate(reductions.items())])
    rows = df.select(F.explode(entries).alias("entry")).where("entry IS NOT NULL").select("entry.*")
    return rows.groupBy(TAG, *[f"k{i}" for i in range(len(types))]).agg(
        *[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)])


def unpacked(together: DataFrame, reductions: Mapping[str, Reduction], name: str) -> DataFrame:
    """One reduction's rows, as :func:`reduced` gives them."""
    r = reductions[name]
    own = together.filter(F.col(TAG) == name)
    sums = {out: F.col(f"s{j}") for j, out in enumerate(r.sums())}
    keys = [F.col(f"k{list(reductions).index(name)}.{k}").alias(k) for k in r.keys()]
    return own.select(*keys, *[c.alias(out) for out, c in sums.items()]) if keys else own.agg(*_summed(sums))
