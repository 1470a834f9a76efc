"""Near-duplicate documents by the Jaccard similarity of their word shingles, exactly.

A document's set: hashes of its distinct shingles (runs of ``width`` words, A-Z lower-cased; with
fewer words, all of them as one).  Two documents link when ``100 * common >= percent * union``.

1. Prefixes.  All sets are sorted in one order (frequent shingles last, by the number of documents
   that hold them, then by hash).  Linked sets share a shingle in their first n - ceil(s n) + 1, and several in a longer
   prefix.  ``shared_keys`` tells which prefix shingles two different sets have; sets with too few
   of them link with nothing.  Equal sets are one class from here on.
2. Hubs.  In every tile (the classes that share a prefix shingle) the class with the fewest
   unshared shingles is the hub; each class is compared exactly with its most frequent hub.
   Groups of near copies mostly collapse around their hub.
3. Tiles.  Where a tile still has two components, its classes meet again, unless a class has too
   few such tiles for any link.  All tiles of one hub are worked on together, so a class comes
   there once, in blocks of bounded size.  Classes are ordered by size and only sizes within
   the bound (a band) are paired.  Hashed bitmap signatures bound the overlap from above:
   ``popcount(x & y) + min(collisions)``.
4. Pairs that the bound leaves, in different components, are compared exactly: the intersection of the sorted arrays.

Components follow from the links between classes and the classes' members; copies are never
expanded into pairs.  The frequent list only orders shingles; it changes speed, not results.  Its
counts are those of all documents (``frequent_shingles``).
Shingles are compared by 64-bit hashes, classes by a 64-bit hash of the whole set and its size.

Null, empty and word-less texts have empty sets, link with nothing and are their own component.
Rows with equal ids count as one document with several texts.  A null id stays null and takes
part in no link: such a row sends no prefix and carries no set.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricfold.llm import shared_keys as sk
from metricfold.llm.components import components
from metricfold.session import scratch_dir
from metricfold.llm.text_bytes import lower_ascii, mix, slices, text_and_offsets, window_hashes, word_bounds, word_hashes

WIDTH, PERCENT = 4, 85
PART_BYTES = 16 << 20       # text whose shingles a task counts at once, about
FREQUENT = 65_536           # most shingles with a place of their own in the order
FREQUENT_FROM = 6           # documents for each part that hold a frequent shingle, on average
RARE = 2                    # documents of a part up to which a shingle is not told of at first
PRUNINGS = 2
TILE_BLOCK = 1_024          # classes of a hub's tiles that one task pairs with each other or another block
MEMBERS = ("doc_id long, text_key long, class long, n long, unshared int, n_core int, keys array<long>, "
           "shingles array<long>, signature binary")


def shingles_of(texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle, repeated ones too."""
    buf, off = text_and_offsets(texts)
    buf = lower_ascii(buf)
    starts, ends, row = word_bounds(buf, off)
    words = word_hashes(buf, starts, ends)
    counts = np.bincount(row, minlength=len(off) - 1) if len(row) else np.zeros(len(off) - 1, int)
    hashes, rows = [], []
    if len(words) >= width:
        h = window_hashes(words, width)
        same = row[:len(h)] == row[width - 1:]
        hashes.append(h[same])
        rows.append(row[:len(h)][same])
    first = np.cumsum(counts) - counts
    for size in range(1, width):            # short texts: the whole sequence
        at = np.flatnonzero(counts == size)
        if len(at):
            h = np.full(len(at), np.uint64(size))
            grid = words[first[at][:, None] + np.arange(size)]
            hashes.append(np.concatenate([window_hashes(g, size) for g in grid]) if len(at) else h)
            rows.append(at)
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


def _distinct(r: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(h):
        return r, h
    if r.max() < 1 << 16:       # sorting small numbers stably is fast
        order = np.argsort(h)
        order = order[np.argsort(r[order].astype(np.uint16), kind="stable")]
    else:
        order = np.lexsort((h, r))
    h, r = h[order], r[order]
    keep = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))
    return r[keep], h[keep]


def shingle_sets(texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, ordered by row and hash."""
    return _distinct(*shingles_of(texts, width))


def ceil_share(n: np.ndarray, percent: int) -> np.ndarray:
    return (percent * n + 99) // 100


class Sets:
    """The sets of a chunk's documents and their prefixes."""

    def __init__(self, docs: pa.Table, width: int, percent: int, frequent: np.ndarray):
        row, h = shingle_sets(docs["text"], width)
        rows = docs.num_rows
        self.n = np.bincount(row, minlength=rows).astype(np.int64)
        self.first = np.cumsum(self.n) - self.n
        self.hashes = h
        summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(1)), dtype=np.uint64)])
        total = summed[self.first + self.n] - summed[self.first]
        self.classes = mix(total + self.n.astype(np.uint64)).view(np.int64)
        # Prefixes in the common order: frequent shingles (by their place in the list) last.
        place = np.zeros(len(h), np.int64)
        if len(frequent) and len(h):
            by_hash = np.argsort(frequent)
            at = np.minimum(np.searchsorted(frequent, h, sorter=by_hash), len(frequent) - 1)
            found = frequent[by_hash[at]] == h
            place[found] = by_hash[at[found]] + 1
        order = np.lexsort((place, row))        # stable, and in order by row and hash before
        rank = np.arange(len(h)) - self.first[row]
        need = ceil_share(self.n, percent)
        self.core = np.where(self.n > 0, self.n - need + 1, 0)          # every link shares one of these
        self.extra = self.n // 10                                       # and 1 + extra of these more
        self.need = 1 + need // 10      # for the smallest set that may link
        self.known = docs["doc_id"].is_valid().to_numpy()               # rows that may link
        long = (rank < (self.core + self.extra)[row]) & self.known[row]
        self.prefix, self.prefix_row, self.prefix_rank = h[order][long], row[long], rank[long]
        self.keys, self.several = sk.distinct(self.prefix, self.classes[self.prefix_row])


def _send_prefixes(width: int, percent: int, frequent, bits: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        sets = Sets(docs, width, percent, frequent.value)
        return sk.sent(key[0].as_py(), sets.keys, sets.several, bits)
    return run


def signature(hashes: np.ndarray) -> bytes:
    """A bitmap of 16 to 32 bits for each element, a power of two of at least 64 in all."""
    width = max(64, 1 << (int(len(hashes)).bit_length() + 4))
    bits = np.zeros(width, np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _members(width: int, percent: int, frequent, bits: int):
    """A row per document; the first of a class in its chunk carries the set, if it may link."""
    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        sets = Sets(docs, width, percent, frequent.value)
        shared = sk.read_answer(replies, sets.keys, bits)[np.searchsorted(sets.keys, sets.prefix)]
        rows = docs.num_rows
        several = np.bincount(sets.prefix_row[shared], minlength=rows)
        known = np.flatnonzero(sets.known)
        _, first_row = np.unique(sets.classes[known], return_index=True)
        carries = np.zeros(rows, bool)
        carries[known[first_row]] = True
        carries &= (several >= sets.need) & (sets.n > 0)
        shared &= carries[sets.prefix_row]
        n_core = np.bincount(sets.prefix_row[shared & (sets.prefix_rank < sets.core[sets.prefix_row])], minlength=rows)
        total = np.maximum(sets.core + np.minimum(sets.extra, sets.n - sets.core), 1)
        keys = _lists(sets.prefix[shared], np.where(carries, several, 0), carries)
        of = np.repeat(carries, sets.n)
        shingles = _lists(sets.hashes[of], np.where(carries, sets.n, 0), carries)
        marks = [signature(sets.hashes[a:a + n]) if c else None for a, n, c in zip(sets.first, sets.n, carries)]
        return pa.table({
            "doc_id": docs["doc_id"], "text_key": docs["text_key"], "class": pa.array(sets.classes), "n": pa.array(sets.n),
            "unshared": pa.array((1000 * (total - several) // total).astype(np.int32)), "n_core": pa.array(n_core.astype(np.int32)),
            "keys": keys, "shingles": shingles, "signature": pa.array(marks, pa.binary())})
    return run


def _lists(values: np.ndarray, counts: np.ndarray, present: np.ndarray) -> pa.ListArray:
    offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32), mask=np.append(~present, False))
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))


def _counts(h: np.ndarray, n: np.ndarray, mask: np.ndarray | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64), mask=mask), pa.array(n, pa.int64())], ["h", "n"])


def _common(width: int, part_bytes: int):
    """The shingles in more than ``RARE`` documents of a part, and a row with a null for each part."""
    def counted(part: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(part), return_counts=True)
        values, n = values[n > RARE], n[n > RARE]
        return _counts(np.append(values, np.uint64(0)), np.append(n, 0), np.arange(len(n) + 1) == len(n))

    def run(batches):
        part, size = [], 0
        for batch in batches:
            for piece in slices(batch, "text"):
                part.append(shingle_sets(piece.column(0), width)[1])
                size += int(text_and_offsets(piece.column(0))[1][-1])
                if size >= part_bytes:
                    yield counted(part)
                    part, size = [], 0
        if size:
            yield counted(part)
    return run


def _counted(width: int, candidates):
    """In how many documents of the task each of the candidates (in order) is."""
    def run(batches):
        known = candidates.value
        total = np.zeros(len(known), np.int64)
        marks = np.zeros(1 << 20, bool)         # spares most others the search
        marks[known >> np.uint64(44)] = True
        for batch in batches:
            for piece in slices(batch, "text"):
                r, h = shingles_of(piece.column(0), width)
                near = np.flatnonzero(marks[h >> np.uint64(44)])
                r, h = r[near], h[near]
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                found = known[at] == h
                total += np.bincount(_distinct(r[found], at[found].astype(np.uint64))[1].astype(np.int64), minlength=len(known))
        yield _counts(known[total > 0], total[total > 0])
    return run


def frequent_shingles(docs: DataFrame, size: int, save, width: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """``h, n``: the shingles in at least ``FREQUENT_FROM`` documents for each part of the text, and in how many
    of all documents they are.

    Every document is counted, in two passes.  In the first, each part of about ``part_bytes`` tells the counts above
    ``RARE``.  What it leaves out is at most ``RARE`` for each part, so a shingle that reaches the bound with that
    added is a candidate, and no other can be frequent.  The counts above ``RARE`` of a candidate add up to
    ``FREQUENT_FROM - RARE`` for each part, so there are at most a quarter as many candidates as a
    part has shingles, however many parts there are.  The second pass counts the candidates in all documents.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select("text").coalesce(max(1, -(-size // part_bytes)))        # parts of a fair size
    told = save(texts.mapInArrow(_common(width, part_bytes), "h long, n long").groupBy("h").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")), "common-shingles")
    parts = told.where("h IS NULL").agg(F.sum("parts")).first()[0] or 0
    able = told.where(f"h IS NOT NULL AND n + {RARE} * ({parts} - parts) >= {FREQUENT_FROM * parts}").select("h")
    candidates = np.sort(able.toArrow()["h"].to_numpy().view(np.uint64))
    if not len(candidates):
        return told.where("false").select("h", "n")
    counted = docs.select("text").mapInArrow(_counted(width, context.broadcast(candidates)), "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_FROM * parts)


def shingle_order(docs: DataFrame, size: int, save, width: int) -> np.ndarray:
    """The ``FREQUENT`` most frequent shingles at most, rarest first."""
    most = frequent_shingles(docs, size, save, width).orderBy(F.col("n").desc(), "h").limit(FREQUENT).toArrow()
    return most["h"].to_numpy()[::-1].copy().view(np.uint64)


def _verify(percent: int):
    """Exact comparison of pairs by their sorted arrays."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])
    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the distinct pairs ``a, b`` those that link."""
    x = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y")
    return both.mapInArrow(_verify(percent), "a long, b long")


def _fold(marks: np.ndarray, width: int) -> np.ndarray:
    while marks.shape[1] > width:
        marks = marks[:, :marks.shape[1] // 2] | marks[:, marks.shape[1] // 2:]
    return marks


def _pairs_of(percent: int):
    """The pairs of a bundle (or of two of its blocks) in different components that may link."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        _, one, other = (k.as_py() for k in key)
        n = rows["n"].to_numpy()
        order = np.argsort(n, kind="stable")
        n, classes, comps = n[order], rows["class"].to_numpy()[order], rows["component"].to_numpy()[order]
        blocks, marks = rows["block"].to_numpy()[order], rows["signature"].to_pylist()
        marks = [np.frombuffer(marks[i], np.uint8) for i in order]
        sizes = np.array([len(m) for m in marks])
        found_a, found_b = [], []
        collisions = n - np.array([int(np.bitwise_count(m).sum()) for m in marks])
        for width in np.unique(sizes):          # signatures of one width, or of the next one folded
            narrow, near = np.flatnonzero(sizes == width), np.flatnonzero((sizes == width) | (sizes == 2 * width))
            grid = np.concatenate([_fold(marks[i][None, :], width) for i in near]).view(np.uint64)
            folded = np.where(sizes[near] == width, collisions[near], n[near] - np.bitwise_count(grid).sum(axis=1))
            place = {int(i): k for k, i in enumerate(near)}
            for i in narrow:
                k = place[int(i)]
                js = near[k + 1:] if width == sizes[i] else near
                end = np.searchsorted(n[js], n[i] * 100 // percent, side="right")       # band of sizes
                js, ks = js[:end], np.arange(k + 1, k + 1 + end)
                able = comps[js] != comps[i]
                if one != other:
                    able &= blocks[js] != blocks[i]
                js, ks = js[able], ks[able]
                if not len(js):
                    continue
                most = np.bitwise_count(grid[ks] & grid[k]).sum(axis=1, dtype=np.int64) + np.minimum(folded[ks], folded[k])
                pass_ = 100 * most >= percent * (n[js] + n[i] - most)
                found_a.append(np.full(int(pass_.sum()), i))
                found_b.append(js[pass_])
        a = np.concatenate(found_a) if found_a else np.zeros(0, int)
        b = np.concatenate(found_b) if found_b else np.zeros(0, int)
        return pa.table({"a": pa.array(classes[a], pa.int64()), "b": pa.array(classes[b], pa.int64())})
    return run


SALTS = 32              # places in which the classes of one component meet its row


def text_key() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.lit(13), "text")


def by_class(sets: DataFrame) -> tuple[DataFrame, str]:
    """A scratch table of the sets, bucketed by class: joins on the class do not move it again.  Its name
    in the session's catalog is to be dropped when the links are found."""
    spark = sets.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"sets_{uuid4().hex}"
    sets.write.bucketBy(buckets, "class").sortBy("class").option("path", scratch_dir(spark, name)).saveAsTable(name)
    return spark.table(name), name


def linked(docs: DataFrame, save: Callable[[DataFrame, str], DataFrame], width: int = WIDTH,
           percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The members (``doc_id, text_key, class, n``) of all classes, and the components (``class, component``) of linked ones."""
    size = sk.text_bytes(docs)
    frequent = docs.sparkSession.sparkContext.broadcast(shingle_order(docs, size, save, width))      # at most FREQUENT numbers
    own = sk.dealt(docs, size).withColumn("text_key", text_key())
    bits = sk.bucket_bits(size / 6 * 0.25 * 8)
    replies = sk.answers(own.groupBy("chunk").applyInArrow(_send_prefixes(width, percent, frequent, bits), sk.SENT))
    members = save(own.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        _members(width, percent, frequent, bits), MEMBERS), "members")

    sets, name = by_class(members.where("shingles IS NOT NULL").dropDuplicates(["class"]).drop("doc_id", "text_key"))
    need = F.expr(f"1 + (({percent} * n + 99) div 100) div 10")
    entries = sets.select("class", "unshared", need.cast("int").alias("need"), "n_core", F.posexplode("keys").alias("at", "key"))
    hubs = entries.where("at < n_core").groupBy("key").agg(
        F.min(F.struct("unshared", "class")).alias("hub"), F.count(F.lit(1)).alias("tile"))
    hubs = save(hubs.where("tile > 1").select("key", F.col("hub.class").alias("hub")), "hubs")
    home = (entries.where("at < n_core").select("key", "class").join(hubs, "key").where("class <> hub")
            .groupBy("class", "hub").agg(F.count(F.lit(1)).alias("times"))
            .groupBy("class").agg(F.max_by("hub", F.struct("times", "hub")).alias("hub")))
    first = save(verified(home.select(F.col("hub").alias("a"), F.col("class").alias("b")), sets, percent), "hub-links")
    near = components(first, save)

    # A class can only link to another component if it shares enough prefix shingles with others.
    left = entries.select("key", "class", "need", (F.col("at") < F.col("n_core")).alias("core")).join(
        near.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    for _ in range(PRUNINGS):
        tiles = left.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        open_rows = left.join(tiles.where("low <> high").select("key"), "key")
        able = open_rows.groupBy("class", "need").agg(F.count(F.lit(1)).alias("rows")).where("rows >= need").select("class")
        left = save(open_rows.join(able, "class", "left_semi"), "open-tiles")
    bundles = left.where("core").join(hubs.select("key", "hub"), "key").groupBy("hub", "class").agg(F.first("component").alias("component"))
    bundles = save(bundles, "bundles")
    sizes = bundles.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / TILE_BLOCK).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64(F.lit(5), "class"), F.col("blocks"))
    rows = (bundles.join(sizes, "hub").withColumn("block", block)
            .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("one", F.least("block", "with")).withColumn("other", F.greatest("block", "with"))
            .join(sets.select("class", "n", "signature"), "class")
            .select("hub", "one", "other", "block", "class", "component", "n", "signature"))
    pairs = rows.groupBy("hub", "one", "other").applyInArrow(_pairs_of(percent), "a long, b long").distinct()
    second = save(verified(pairs, sets, percent), "tile-links")
    found = components(first.unionByName(second), save)
    docs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    return members.select("doc_id", "text_key", "class", "n"), found


def grouped(docs: DataFrame, save, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (the smallest id reachable by links) for every row."""
    return _grouped(docs, save, width, percent).drop("text_key")


def _grouped(docs: DataFrame, save, width: int, percent: int) -> DataFrame:
    members, comps = linked(docs, save, width, percent)
    # By class first (copies are many rows of one class), then one join of the rows.  Classes
    # without links are their own component; equal sets link, but not empty ones.
    classes = members.where("n > 0 AND doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"))
    placed = classes.join(comps.withColumnRenamed("node", "class"), "class", "left")
    least = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("least_of_all"))
    # A component may hold a large share of the classes: they meet its row in SALTS places.
    salted = placed.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)))
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    of_class = save(salted.join(spread, ["component", "salt"], "left").select(
        "class", F.coalesce("least_of_all", "least").alias("least_of_all")), "class-ids")
    return members.join(of_class, "class", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("least_of_all")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, save, width: int, percent: int) -> DataFrame:
    """``docs`` without the rows that have a smaller id in their component, and one row for each id and text.
    Rows with empty sets or a null id stay, and so do other texts of an id that loses a row."""
    rows = save(_grouped(docs, save, width, percent).where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id", "text_key").agg(
        F.max(F.col("component_id") != F.col("doc_id")).alias("goes"), F.count(F.lit(1)).alias("rows")).where("goes OR rows > 1"), "drops")
    marked = rows.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "goes")
    same = (docs["doc_id"] == marked["__id"]) & (F.xxhash64(F.lit(13), docs["text"]) == marked["__key"])
    stays = docs.join(marked, same, "left_anti")
    if rows.where("NOT goes").isEmpty():
        return stays
    repeated = docs.join(marked.where("NOT goes"), same, "inner").dropDuplicates(["__id", "__key"]).select(*[docs[c] for c in docs.columns])
    return stays.unionByName(repeated)
