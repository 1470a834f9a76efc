"""Top-N of a merged metric from sorted heads of its windows, without merging every key.  [T1, T2]

Each window of a ranked metric keeps, next to its partial, its rows of largest sums (the head), and the
partial's files are sorted by that sum.  A read for the first N keys by the sum, descending, takes three steps
(a three-phase uniform threshold search):

1. The windows' heads are added up by key.  The N-th largest of these totals is a bound: N keys
   have at least as much, so a key with less in all windows together is not among the first N.
2. With W windows, a key of less than bound / W in each of them stays below the bound.  The rows of at
   least bound / W are found by a filter that reaches the scan, where the sorted files skip whole row groups.
3. Only the keys of those rows are merged over all windows.

Ties with the N-th key are among them, so the result is exact, whatever the data: a bad bound costs time, not rows.
The sums must be whole numbers and not negative.  All keys are merged where there is no bound (fewer than N known keys in
the heads, a bound of 0, ascending order, no limit, or windows written without heads).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.plans.state import StateStore


def head_bound(heads: DataFrame, keys: Sequence[str], by: str, n: int) -> int | None:
    """The ``n``-th largest total of ``heads``; None with fewer keys.  The driver gets one number."""
    totals = heads.groupBy(*keys).agg(F.sum(by).alias("total")).orderBy(F.desc("total")).limit(n)
    keys_found, bound = totals.agg(F.count("total"), F.min("total")).first()
    return bound if keys_found == n else None


def promising(partials: DataFrame, keys: Sequence[str], by: str, share: int) -> DataFrame:
    """The rows, of all windows, of keys that have ``share`` or more in one of them."""
    found = partials.filter(F.col(by) >= share).select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return partials.join(found, same, "left_semi")


def top_rows(store: StateStore, metric: str, keys: Sequence[str], by: str, n: int,
             known: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame | None:
    """Partial rows that hold every key of the ``n`` largest sums ``by``, ties included; None without a bound.

    ``known`` keeps the rows of keys that the result can name, where it drops the others: the
    bound must come from keys that count.
    """
    heads, partials = store.read_heads(metric), store.read_partials(metric)
    if heads is None or n < 1:
        return None
    bound = head_bound(known(heads), keys, by, n)
    if bound is None or bound <= 0:
        return None
    return promising(partials, keys, by, -(-bound // len(store.committed_windows(metric))))
