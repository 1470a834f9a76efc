"""Connected components of a link table, as joins and aggregates with checkpointed rounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def components(links: DataFrame, save: Callable[[DataFrame, str], DataFrame], rounds: int = 60) -> DataFrame:
    """``a, b`` (undirected, any order) -> ``node, component`` (the smallest node that it reaches), for the nodes
    that have links.

    Each round points every node and its neighbours at the smallest label near them and then
    shortens the pointers (label of the label), so long chains need rounds in proportion to
    the logarithm of their length.  Labels are written to shared storage after every round.
    Null ends and loops are ignored.  A node with very many links is combined map-side."""
    edges = save(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    for _ in range(rounds):
        of_other = labels.select(F.col("node").alias("b"), F.col("label").alias("other"))
        near = both.join(of_other, "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        lowered = labels.join(near, "node").select("node", "label", F.least("label", "other").alias("new"))
        # The label a node had points at another node: it learns of the smaller label as well.
        pushed = lowered.groupBy(F.col("label").alias("node")).agg(F.min("new").alias("pushed"))
        hooked = lowered.join(pushed, "node", "left").select(
            "node", "label", F.least("new", F.coalesce("pushed", "new")).alias("new"))
        # Only nodes that are labels are looked up; a label that very many nodes have is met in SALTS places.
        named = hooked.select(F.col("new").alias("node")).distinct()
        target = hooked.join(named, "node", "left_semi").select(
            F.col("node").alias("new"), F.col("new").alias("further"), F.explode(salts).alias("salt"))
        salted = hooked.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
        jumped = save(salted.join(target, ["new", "salt"], "left").select(
            "node", "label", F.least("new", F.coalesce("further", "new")).alias("new")), "labels")
        labels = jumped.select("node", F.col("new").alias("label"))
        if jumped.where("new <> label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"labels still changed after {rounds} rounds")
