"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame operations only).

1. Targets.  Sources in code point order (null last) weigh 3, 1, 2, repeating, and share
   ``budget`` times all words; no target exceeds ``cap`` times its source's words, and the excess is
   shared again by weight (a water level, found in closed form over the sorted sources).
2. Quotas.  The mix is cut into blocks of ``BLOCK_WORDS`` words.  Highest quotients (divisors 1, 3,
   5, ...) give each source an integer number of blocks, and each source's blocks go to its
   shards the same way (a shard: documents of the source with the same seeded hash, at most
   about ``SHARD_ROWS`` of them).
3. Selection.  A shard's documents lie one after another in seeded order.  Whole passes over
   the shard come first; the blocks left are the first ones in that order.

Every window runs over one shard, over the shards of a source, or over the sources; documents
of a large source are spread over many shards.  Shard and order come from ``doc_id`` and a digest of the text, so
rows of a null or repeated id spread and their order is the same in any layout of the table; rows equal in both
are interchangeable and share a shard.  The windows over sources take one row for each source in one
task: meant for up to some million sources.  Null and empty texts have size 0 and are never
taken; a null source is a source.  No rows: no sources, no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
BUDGET = 1.5            # words of the mix, as a multiple of all words
CAP = 2                 # most passes over a source, and over a document
BLOCK_WORDS = 16
SHARD_ROWS = 2_048
SHARD_WORDS = 2_000_000
SEED = 20_240_601
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, budget: float = BUDGET, cap: float = CAP, weights=WEIGHTS) -> DataFrame:
    """``source, source_size`` -> ``target`` added.  The level ``L`` with sum(min(cap_i, L w_i)) equal to
    the budget is the largest of (budget - caps of the first i) / (weights of the rest), in
    order of cap_i / w_i."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights)) + 1)
    level = ((F.sum("source_size").over(every) * F.lit(float(budget)) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    return (sources.withColumn("weight", weight).withColumn("full", F.col("source_size") * F.lit(float(cap)))
            .withColumn("level", level).withColumn("level", F.max("level").over(every))
            .withColumn("target", F.least("full", F.col("level") * F.col("weight"))).drop("weight", "full", "level"))


def apportion(votes: DataFrame, group: list[str], key: list[str], vote: str = "votes",
              seats: str = "seats") -> DataFrame:
    """Sainte-Laguë within each group: adds ``quota``, whose sum over a group is its ``seats``.

    Rounding votes / (sum of votes / seats) gives nearly all seats; it misses the total by at
    most one for each party, so only the few quotients next to the rounding are listed and
    ranked, a number of rows in proportion to the parties.  Ties go to the smaller key.
    Groups without votes get no seats."""
    in_group = Window.partitionBy(*group)
    total, parties = F.sum(vote).over(in_group), F.count(F.lit(1)).over(in_group)
    share = F.when(F.col("_total") > 0, F.col(vote) / F.col("_total")).otherwise(0.0)
    first = (votes.withColumn("_total", total).withColumn("_parties", parties).withColumn("_share", share)
             .withColumn("_first", F.floor(F.col("_share") * F.col(seats) + 0.5))
             .withColumn("_over", F.when(F.col("_total") > 0, F.sum("_first").over(in_group) - F.col(seats)).otherwise(0)))
    reach = (F.ceil(F.col("_share") * (F.abs("_over") + F.col("_parties"))) + 2).cast("long")
    steps = (F.when((F.col("_over") > 0) & (F.col("_first") > 0),
                    F.sequence(F.greatest(F.lit(1), F.col("_first") - reach + 1).cast("long"), F.col("_first").cast("long")))
             .when((F.col("_over") < 0) & (F.col(vote) > 0),
                   F.sequence((F.col("_first") + 1).cast("long"), (F.col("_first") + reach).cast("long"))))
    quotient = F.col(vote) / (2 * F.col("_k") - 1)
    near = first.withColumn("_k", F.explode(steps))
    names = [F.col(k).asc_nulls_last() for k in key]
    back = [F.col(k).desc_nulls_first() for k in key]
    low, high = Window.partitionBy(*group).orderBy(quotient, *back), Window.partitionBy(*group).orderBy(quotient.desc(), *names)
    moved = (near.withColumn("_rank", F.when(F.col("_over") > 0, F.row_number().over(low)).otherwise(F.row_number().over(high)))
             .where(F.col("_rank") <= F.abs("_over"))
             .groupBy(*group, *[k for k in key if k not in group]).agg(F.count(F.lit(1)).alias("_moved")))
    on = list(dict.fromkeys([*group, *key]))
    right = moved.select(*[F.col(c).alias(f"_{c}_r") for c in on], "_moved")
    same = None
    for c in on:
        one = first[c].eqNullSafe(right[f"_{c}_r"])
        same = one if same is None else same & one
    joined = first.join(right, same, "left")
    quota = F.col("_first") - F.signum("_over") * F.coalesce("_moved", F.lit(0))
    return joined.withColumn("quota", quota.cast("long")).select(*votes.columns, "quota")


def seeded(seed: int) -> Column:
    """A seeded hash of a row's id and text, as hex digits.  (MD5: other engines have it as well.)"""
    return F.md5(F.concat_ws(":", F.lit(seed), "doc_id", "digest").cast("binary"))


def shard_of(shards: Column) -> Column:
    return F.pmod(F.conv(F.substring(seeded(SEED), 1, 15), 16, 10).cast("long"), shards)


def quotas(sized: DataFrame, budget: float = BUDGET, cap: float = CAP, weights=WEIGHTS) -> DataFrame:
    """One row per source and shard: the source's size and target, the shard's words and the
    words the mix takes from it.  ``sized``: ``doc_id, source, size, digest``."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    shards = F.greatest(F.ceil(F.col("_rows") / SHARD_ROWS), F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)).cast("long")
    aimed = targets(sources.withColumn("shards", shards).drop("_rows"), budget, cap, weights)
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / BLOCK_WORDS).cast("long")
    shared = apportion(aimed.withColumn("seats", blocks).withColumn("_all", F.lit(1)), ["_all"], ["source"], "target")
    shared = shared.select("source", "source_size", "target", "shards", F.col("quota").alias("blocks"))
    cells = (_with_shard(sized, shared).groupBy("source", "shards", "shard").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.first("blocks").alias("blocks")))
    cells = apportion(cells, ["source"], ["shard"], "words", "blocks")
    return cells.select("source", "shards", "shard", "source_size", "target", "words",
                        F.least(F.col("quota") * BLOCK_WORDS, F.col("words") * F.lit(int(cap))).alias("takes"))


def _with_shard(sized: DataFrame, sources: DataFrame) -> DataFrame:
    right = sources.withColumnRenamed("source", "_source")
    return (sized.join(right, sized["source"].eqNullSafe(right["_source"])).drop("_source")
            .withColumn("shard", shard_of(F.col("shards"))))


def allocate(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``taken`` to ``sized`` (``doc_id, source, size`` and any others)."""
    from_source = plan.groupBy("source").agg(F.first("shards").alias("shards"))
    placed = _with_shard(sized, from_source)
    right = plan.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "source_size", "target",
                        "words", "takes")
    joined = placed.join(right, placed["source"].eqNullSafe(right["_source"]) & (placed["shard"] == right["_shard"]))
    order = Window.partitionBy("source", "shard").orderBy(
        seeded(SEED + 1), "doc_id", "digest", "size")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    passes = F.when(F.col("words") > 0, F.expr("takes div words")).otherwise(0)
    rest = F.when(F.col("words") > 0, F.col("takes") % F.col("words")).otherwise(0)
    part = F.greatest(F.lit(0), F.least(F.col("_end"), rest) - (F.col("_end") - F.col("size")))
    return (joined.withColumn("_end", end).withColumn("taken", (passes * F.col("size") + part).cast("long"))
            .drop("_source", "_shard", "shards", "shard", "words", "takes", "_end"))


def digest() -> Column:
    return F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` and a ``digest`` of the text, which tells the rows of one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size"), digest())


def mixed(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: whole copies, and the last one if at
    least half of it is taken.  The rows' own columns may have any names."""
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size"), digest(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    n = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    return (allocate(packed, plan).select("row", F.explode(F.array_repeat(F.lit(0), n)).alias("copy"))
            .select(*[F.col(f"row.`{c}`") for c in docs.columns]))
