"""Merkle manifest of a dataset, with nested-interval labels.

A row's leaf is the digest of its fields.  Within a language the leaves stand in order of id; every eight
consecutive nodes make their parent until one is left, the language's subroot.  The subroots, in order of the
language, make the root in the same way.  ``H`` is the lowercase hex SHA-256 of its inputs joined, digests as text.

* Labels: all leaves stand in one order (language, id), so a leaf is an interval ``[rank, rank + 1)`` of
  leaf ranks and every node covers the interval of its leaves.  A language is named by its first rank
  (``tree``), and a node of level ``k`` has the bucket ``(lo - tree) div 8^k``.
* Manifest: one table of families for each level (``tree, bucket, lo, hi, digest`` and the at most eight
  ``children`` with their intervals), written before the next level is made from it.
* Proofs: from the top down, a family meets the family of the next level that covers it in a join on
  the tree and the level's bucket with the containment of the intervals as condition.  A parent's
  interval less the child's own leaves what the siblings cover: their digests, on either side of the
  child, are that level's part of the proof.  Only families move, never proofs of single leaves.
* Verification: a leaf's digest is folded with its siblings up to the root.

Everything is DataFrame work.  A hot language spreads over ranges and buckets; equal rows too.

Results for odd input: a null field counts as ``-``.  Null ids come first in their language, a null language comes
first.  Rows of one id stand in order of their digest, equal rows are leaves of their own.  Empty texts have
digests like any other.  An empty table has no root and gives no rows.  Only the five named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricfold.llm.ranks import ranked

Save = Callable[[DataFrame, str], DataFrame]

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_OUT = 8
NODE = ("tree", "n", "bucket", "lo", "hi", "digest")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    return h(*[field(F.col(c)) for c in FIELDS[:-1]], field(text))


def leaves(docs: DataFrame, changed: Column, changed_text: Column) -> DataFrame:
    """``doc_id, lang, digest, found``: the leaf as it was, and as a check finds it (null: as it was), where
    the rows that ``changed`` names have ``changed_text`` now."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", leaf_of(F.col("text")).alias("digest"),
                       F.when(changed, leaf_of(changed_text)).alias("found"))


def labelled(leaves: DataFrame, save: Save) -> DataFrame:
    """The leaves as nodes of level 0: ``NODE`` columns, with ``doc_id`` and ``found``."""
    placed = ranked(leaves, [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("digest")], save, "leaves")
    spans = placed.groupBy("part", "lang").agg(F.min("position").alias("lo"), F.count(F.lit(1)).alias("n"))
    trees = spans.groupBy("lang").agg(F.min("lo").alias("tree"), F.sum("n").alias("n"), F.collect_list("part").alias("parts"))
    # A language's rows meet its row once for each range, so that a hot language spreads.
    trees = trees.select(F.col("lang").alias("__lang"), "tree", "n", F.explode("parts").alias("__part"))
    lo = F.col("position")
    return placed.join(trees, (F.col("part") == F.col("__part")) & F.col("lang").eqNullSafe(F.col("__lang"))).select(
        "tree", "n", (lo - F.col("tree")).alias("bucket"), lo.alias("lo"), (lo + 1).alias("hi"), "digest", "doc_id", "found")


def families(nodes: DataFrame) -> DataFrame:
    """The parents of the nodes of trees that have several nodes left, with their children in order."""
    payload = [c for c in nodes.columns if c not in ("tree", "n", "bucket")]
    grouped = nodes.where("n > 1").groupBy("tree", F.ceil(F.col("n") / FAN_OUT).cast("long").alias("n"),
                                           F.floor(F.col("bucket") / FAN_OUT).cast("long").alias("bucket"))
    made = grouped.agg(F.sort_array(F.collect_list(F.struct(*payload))).alias("children"))
    return made.select("tree", "n", "bucket", F.col("children")[0]["lo"].alias("lo"), F.array_max("children.hi").alias("hi"),
                       h(F.array_join("children.digest", "")).alias("digest"), "children")


def levels(nodes: DataFrame, save: Save) -> list[DataFrame]:
    """The families of level 1, 2, ... until every tree has one node."""
    made = []
    while nodes.where("n > 1").limit(1).count():
        made.append(save(families(nodes), f"level-{len(made) + 1}"))
        nodes = made[-1].select(*NODE)
    return made


def tops(nodes: DataFrame, made: list[DataFrame]) -> DataFrame:
    """The one node that each tree ends in."""
    return reduce(DataFrame.unionByName, [level.where("n = 1").select(*NODE) for level in [nodes, *made]])


def _beside(children: Column, lo: Column, hi: Column) -> Column:
    """The digests of the children that cover the parent's interval less ``[lo, hi)``, before and after it."""
    def joined(inside: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(F.filter(children, inside), lambda x: x["digest"]), "")
    return F.struct(joined(lambda x: x["hi"] <= lo).alias("before"), joined(lambda x: x["lo"] >= hi).alias("after"))


def _under(families: DataFrame, above: DataFrame) -> DataFrame:
    """Families with the siblings in the families one level ``above`` that cover them, and those's siblings."""
    parent = above.select(*[F.col(c).alias(f"p_{c}") for c in above.columns])
    inside = ((F.col("tree") == F.col("p_tree")) & (F.floor(F.col("bucket") / FAN_OUT).cast("long") == F.col("p_bucket"))
              & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi")))
    siblings = F.concat(F.array(_beside(F.col("p_children"), F.col("lo"), F.col("hi"))), F.col("p_siblings"))
    return families.join(parent, inside).select("tree", "bucket", "lo", "hi", "children", siblings.alias("siblings"),
                                                F.col("p_subroot").alias("subroot"), F.col("p_root").alias("root"))


def children_with_siblings(made: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The children of level 1, each with ``siblings`` (an entry for each level, from the bottom), ``subroot``
    and ``root``.  ``ends`` holds the trees' last nodes with the siblings above them."""
    columns = ("tree", "bucket", "lo", "hi", "children", "siblings", "subroot", "root")
    end = ends.select(F.col("tree").alias("e_tree"), F.col("lo").alias("e_lo"), F.col("hi").alias("e_hi"), "siblings", "subroot", "root")
    covered = (F.col("tree") == F.col("e_tree")) & (F.col("lo") == F.col("e_lo")) & (F.col("hi") == F.col("e_hi"))
    above = None
    for level in reversed(made):
        here = level.where("n = 1").join(end, covered).select(*columns)
        if above is not None:
            here = here.unionByName(_under(level.where("n > 1"), above))
        above = here
    child = above.select("*", F.explode("children").alias("child"))
    own = F.concat(F.array(_beside(F.col("children"), F.col("child.lo"), F.col("child.hi"))), F.col("siblings"))
    return child.select("child.*", "tree", own.alias("siblings"), "subroot", "root")


NO_SIBLINGS = "array<struct<before:string,after:string>>"


def proofs(docs: DataFrame, save: Save, changed: Column, changed_text: Column) -> DataFrame:
    """Every leaf with its proof: ``doc_id, lo, digest, found, siblings, subroot, root``."""
    nodes = save(labelled(leaves(docs, changed, changed_text), save), "nodes")
    made = levels(nodes.select(*NODE, "doc_id", "found"), save)
    # The languages' subroots are the leaves of the tree above them.
    by_language = ranked(save(tops(nodes, made), "subroots"), [F.col("lo")], save, "languages")
    n_languages = by_language.count()
    upper = save(by_language.select(F.lit(0).cast("long").alias("tree"), F.lit(n_languages).cast("long").alias("n"),
                                    F.col("position").alias("bucket"), "lo", "hi", "digest", F.col("tree").alias("language")),
                 "upper")
    above = levels(upper, save)
    none = F.array().cast(NO_SIBLINGS)
    if above:
        last = tops(upper, above).select("tree", "lo", "hi", none.alias("siblings"), F.lit(None).cast("string").alias("subroot"),
                                         F.col("digest").alias("root"))
        ends = children_with_siblings(above, last).select(
            F.col("language").alias("tree"), "lo", "hi", "siblings", F.col("digest").alias("subroot"), "root")
    else:
        ends = upper.select(F.col("language").alias("tree"), "lo", "hi", none.alias("siblings"), F.col("digest").alias("subroot"),
                            F.col("digest").alias("root"))
    columns = ("doc_id", "lo", "digest", "found", "siblings", "subroot", "root")
    ends = save(ends, "ends")
    lone = nodes.where("n = 1").select("tree", "doc_id", "digest", "found").join(ends, "tree").select(*columns)
    if not made:
        return lone
    return children_with_siblings(made, ends).select(*columns).unionByName(lone)


def verified(docs: DataFrame, save: Save, changed: Column, changed_text: Column) -> DataFrame:
    """Each row with its proof's digest, and whether the leaf as found still leads to the root."""
    proof = h(F.array_join(F.transform("siblings", lambda s: F.concat(s["before"], s["after"])), ""))
    folded = F.aggregate("siblings", F.coalesce("found", "digest"), lambda found, s: h(s["before"], found, s["after"]))
    return proofs(docs, save, changed, changed_text).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"),
        F.col("lo").alias("leaf_rank"), F.size("siblings").alias("n_levels"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
