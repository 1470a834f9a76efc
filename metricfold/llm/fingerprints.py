"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its runs of five words (a shorter text with words is one shingle).  Its sketch holds the ``K``
smallest distinct 64-bit hashes of them (the first half of MD5, as hex), in order.

* Two sketches of parts merge by keeping the ``K`` smallest of both (``merged`` for two, ``merged_by`` for the
  sketches of a group, by ranked hashes, of which each task keeps ``K``).
* ``likeness``: of the ``K`` smallest hashes of the union, the share that both have, an estimate of
  the resemblance (Jaccard).  Exact where the texts have at most ``K`` shingles together.
* ``distinct``: the number of distinct shingles, from the place of the largest kept hash.
* ``contained``: the share of one text's shingles that the other has, from these two.

Native: DataFrame functions only.  ``with_next`` gives every row the text that follows it in descending
order of id without a window over the table: keys (id, text digest) are ranked, a first exchange attaches the ranks
to the texts and a second one puts blocks of ``BLOCK`` neighbours together, with the first row of
the next block.  Rows that are equal in id and text travel once, with their number, and come
back at the end in portions of ``PORTION``.

Results for odd input: a null text is an empty one.  Texts without words have empty sketches; two of these are
alike (1), one of them and a text with words are not (0), an empty sketch is contained in every other (1).
Null ids stand last; rows of one id stand in order of the text's digest, so of equal rows each is followed by the
next and the last one by another key's.  One row is followed by itself.  An empty table gives no rows.  A text and
its words must fit into one row's memory (about ten times the text; texts of 100 MB were not tried).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricfold.llm.ranks import ranked

Save = Callable[[DataFrame, str], DataFrame]

K = 128
SHINGLE_WORDS = 5
HASH_DIGITS = 16        # hex digits kept of a hash
FRACTION_DIGITS = 13    # of these, read as a fraction: 52 bits, exact in a double
BLOCK = 256
PORTION = 1_024
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def sketch_of(words: Column, k: int = K) -> Column:
    """The sketch of a text's words.  Elements are read by place: slices would copy the words for every shingle."""
    def shingle(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, i + j) for j in range(SHINGLE_WORDS)])     # places beyond the end are left out
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.md5(shingle(i).cast("binary")))
    least = F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(least, lambda x: F.substring(x, 1, HASH_DIGITS)))


def merged(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def likeness(a: Column, b: Column, k: int = K) -> Column:
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def distinct(sketch: Column, k: int = K) -> Column:
    place = F.conv(F.substring(F.get(sketch, F.lit(k - 1)), 1, FRACTION_DIGITS), 16, 10).cast("double") / float(16 ** FRACTION_DIGITS)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(F.lit(float(k - 1)) / place)


def contained(a: Column, b: Column, k: int = K) -> Column:
    """The share of ``a``'s shingles that ``b`` has."""
    shared = likeness(a, b, k) * distinct(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct(a, k)))


def written(sketch: Column) -> Column:
    return F.array_join(sketch, "")


def merged_by(sketches: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """``keys, sketch``: one sketch for each group of sketches.  Each task keeps the ``k`` smallest hashes of a group."""
    hashes = sketches.select(*keys, F.explode(sketch).alias("__hash")).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("__hash"))
    least = hashes.withColumn("__place", place).where(F.col("__place") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("__hash")).alias(sketch))      # k hashes at most


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.md5(text.cast("binary")).alias("digest"), text.alias("text"))


KEY = ("no_id", "id", "digest")


def with_next(docs: DataFrame, save: Save, with_own: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``doc_id, text, own, next_text, next_own, times``: every distinct row with the one that follows it, ``times`` for
    the equal rows that it stands for.  ``with_own`` adds ``own``, what is computed once for each text."""
    keyed = _keyed(docs)
    order = [F.col("no_id"), F.col("id").desc(), F.col("digest")]
    keys = ranked(keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")), order, save, "keys")
    n = keys.count()
    place = keys.select(*KEY, "rows", "position")
    texts = keyed.groupBy(*KEY).agg(F.first("text").alias("text")).join(place, list(KEY))

    def sent(block: Column, position: Column, role: str, times: Column) -> Column:
        return F.struct(block.cast("long").alias("block"), position.cast("long").alias("at"), F.lit(role).alias("role"),
                        times.cast("long").alias("times"))

    p, one = F.col("position"), F.lit(1)
    block = F.floor(p / BLOCK)
    first = F.when(p % BLOCK == 0, F.array(sent(     # also sent to the end of the block before
        F.when(p == 0, F.lit((n - 1) // BLOCK)).otherwise(block - 1), F.when(p == 0, F.lit(n)).otherwise(p), "border", one)))
    portions = F.when(F.col("rows") > 1, F.transform(     # equal rows but one are followed by their like; each portion goes its own way
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 2) / PORTION)),
        lambda i: sent(-1 - F.pmod(F.xxhash64("digest", "id", i), F.lit(1 << 31)), F.lit(0), "like",
                       F.least(F.lit(PORTION).cast("long"), F.col("rows") - 1 - i * PORTION))))
    none = F.array().cast("array<struct<block:bigint,at:bigint,role:string,times:bigint>>")
    ways = F.concat(F.array(sent(block, p, "row", one)), F.coalesce(first, none), F.coalesce(portions, none))
    dealt = texts.select("no_id", "id", "text", F.explode(ways).alias("way")).select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "text", "way.*").repartition("block")
    beside = Window.partitionBy("block").orderBy("at")
    like = F.col("role") == "like"
    return with_own(dealt).select(
        "doc_id", "text", "own", "role", "times",
        F.when(like, F.col("text")).otherwise(F.lead("text").over(beside)).alias("next_text"),
        F.when(like, F.col("own")).otherwise(F.lead("own").over(beside)).alias("next_own")).where("role <> 'border'").drop("role")


def edited(text: Column, other: Column) -> Column:
    """The last half of the code points replaced by the first as many of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the sketch of the column ``text``.  The words are a column of their own, so that they are split once."""
    return df.withColumn("__words", words(F.coalesce(F.col(text), F.lit("")))).withColumn(out, sketch_of(F.col("__words"))).drop("__words")


def compared(docs: DataFrame, save: Save) -> DataFrame:
    """``doc_id, text, edited, own, edited_sketch, next_own``: every row with its sketch, its edited text and the
    sketches of this and of the next row's text."""
    pairs = with_next(docs.select("doc_id", "text"), save, lambda df: with_sketch(df, "text", "own"))
    pairs = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    pairs = with_sketch(pairs, "edited", "edited_sketch")
    return pairs.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("__copy", "times")


def digests(docs: DataFrame, save: Save) -> DataFrame:
    """The written fingerprints of every row and its edited text, with what they tell."""
    own, other = F.col("own"), F.col("edited_sketch")
    return compared(docs, save).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(own).alias("fingerprint"), written(other).alias("edited_fingerprint"), likeness(own, other).alias("near_edited"),
        likeness(own, F.col("next_own")).alias("near_next"), distinct(own).alias("n_shingles"),
        contained(own, other).alias("kept_share"))
