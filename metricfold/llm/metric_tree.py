"""Exact top-k inner products with M-trees.

Vectors become integers, ``floor(64 * x)``.  One more coordinate, ``sqrt(M - |x|^2)`` with ``M`` the largest
squared norm, turns the largest inner product with a query into the smallest Euclidean
distance: ``d(q, x)^2 = |q|^2 + M - 2 q.x``.  So a metric tree answers exactly.

* Routing: at most ``REGIONS`` pivots (a bounded sample, smallest hash of the id) cut the space; every
  vector belongs to its nearest pivot.  Regions of more than ``TREE_ROWS`` rows, also those that many
  equal vectors make, are split by a hash of the id into several trees.
* Tree: leaf pages of at most ``PAGE_ROWS`` vectors around a centre, with the covering radius, the
  centre's distance to the tree's root and every vector's distance to its centre.
* Search: a query first visits its own tree, which gives a first bound.  It then goes to every
  tree of the regions whose covering radius reaches within the bound.  In a tree, pages are
  visited best first.  Stored distances exclude pages (root distance) and vectors (centre
  distance) by the triangle inequality before any distance to them is computed.

Bounds only exclude what is strictly worse (with a margin for rounding that grows with the norm),
so results are exact and ties go to the smaller id.  Tasks hold one tree and one block of queries.

Trees hold vectors with squared norms below ``EXACT``: no sum of their products leaves the exact
integers of a double.  Larger vectors, as queries and as candidates, are compared block by block:
doubles with an error bound choose the rows that may be among the best, Python integers score
these.  Order is exact at any size; a score beyond 64 bits is null in the result.

Vectors that are null, empty, or hold null or non-finite components, and rows with a null id, take
no part; vectors of different lengths are not compared.  A row is not its own candidate; other rows with its
id are.  Rows of one id are queries of their own, and equal scores of one id stand next to each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricfold.llm.ranks import ranked

TOP = 20
EVERY = 20              # queries: ids divisible by this
REGIONS = 256
TREE_ROWS = 8_192
PAGE_ROWS = 512
QUERY_BLOCK = 8_192
EXACT = 2 ** 52         # squared norms
MARGIN = 1e-3

VECTORS = "vec_id long, dim int, norm long, v binary"
ROWS = VECTORS + ", asked boolean"          # vec_id: the row's place in order of id
TREES = "dim int, region int, salt long, root_distance double, radius double, centre binary, ids binary, vectors binary, distances binary, norms binary"
FOUND = "query_id long, vec_id long, score long"
LARGE_FOUND = FOUND + ", beyond int, digits string"


def _ints(batches):
    """Integer vectors; those for no tree have no norm and keep their components as they are."""
    for batch in batches:
        ids, dims, norms, out = [], [], [], []
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            if i is None or not x.is_valid or len(x.values) == 0 or x.values.null_count:
                continue
            x = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                v = np.floor(64.0 * x)
                norm = (v * v).sum()
            ids.append(i)
            dims.append(len(v))
            norms.append(int(norm) if norm < EXACT else None)
            out.append(v.astype(np.int32).tobytes() if norm < EXACT else x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(norms, pa.int64()), pa.array(out, pa.binary())],
            ["vec_id", "dim", "norm", "v"])


def integer_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    return embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x")).mapInArrow(_ints, VECTORS)


def _matrix(column, dim: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.int32).reshape(-1, dim).astype(np.float64)


def _distances(a: np.ndarray, a_extra: np.ndarray, b: np.ndarray, b_extra: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` to those of ``b``, the extra coordinate included."""
    a = np.concatenate([a, a_extra[:, None]], axis=1)
    b = np.concatenate([b, b_extra[:, None]], axis=1)
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _extra(norms: np.ndarray, largest: int) -> np.ndarray:
    return np.sqrt(np.maximum(float(largest) - norms, 0.0))


def _margin(largest: int, dim: int) -> float:
    """More than the rounding errors of the few distances that a bound is made of: each is a root of a
    sum of ``dim`` terms, whose error is a share of the largest squared norm."""
    return MARGIN + 6 * float(np.sqrt(4 * (dim + 4) * np.finfo(np.float64).eps * largest))


def _assign(pivots: dict[int, np.ndarray], largest: int):
    """Adds each vector's region and its distance to the region's pivot."""
    def run(batches):
        for batch in batches:
            region = np.zeros(batch.num_rows, np.int32)
            far = np.zeros(batch.num_rows)
            dims = batch.column("dim").to_numpy()
            norms = batch.column("norm").to_numpy().astype(np.float64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                p = pivots[int(dim)]
                x = _matrix(batch.column("v").take(pa.array(at)), int(dim))
                d = _distances(x, _extra(norms[at], largest), p, _extra((p * p).sum(axis=1), largest))
                region[at] = d.argmin(axis=1)
                far[at] = d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region), pa.array(far)],
                                             [*batch.schema.names, "region", "far"])
    return run


def _pages(x: np.ndarray, extra: np.ndarray, page_rows: int) -> list[np.ndarray]:
    """Rows in pages of at most ``page_rows``: split again and again by the nearer of two far-apart
    rows; rows that no split parts (equal vectors) are cut by count."""
    todo, done = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= page_rows:
            done.append(rows)
            continue
        first = _distances(x[rows[:1]], extra[rows[:1]], x[rows], extra[rows])[0]
        a = rows[[first.argmax()]]
        from_a = _distances(x[a], extra[a], x[rows], extra[rows])[0]
        b = rows[[from_a.argmax()]]
        from_b = _distances(x[b], extra[b], x[rows], extra[rows])[0]
        order = np.argsort(from_a - from_b, kind="stable")
        half = max(page_rows, -(-len(rows) // 2 // page_rows) * page_rows)      # full pages
        todo += [rows[order[:half]], rows[order[half:]]]
    return done


def _build(largest: int, page_rows: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        dim, region, salt = (k.as_py() for k in key)
        rows = rows.sort_by("vec_id")
        x, norms = _matrix(rows["v"], dim), rows["norm"].to_numpy().astype(np.float64)
        ids, extra = rows["vec_id"].to_numpy(), _extra(norms, largest)
        root = x.mean(axis=0, keepdims=True)
        root_extra = np.array([extra.mean()])
        out = []
        for page in _pages(x, extra, page_rows):
            centre, centre_extra = x[page].mean(axis=0, keepdims=True), np.array([extra[page].mean()])
            d = _distances(centre, centre_extra, x[page], extra[page])[0]
            order = np.argsort(d, kind="stable")
            page, d = page[order], d[order]
            out.append({
                "dim": dim, "region": region, "salt": salt,
                "root_distance": float(_distances(centre, centre_extra, root, root_extra)[0, 0]),
                "radius": float(d.max()), "centre": np.append(np.append(centre[0], centre_extra), np.append(root[0], root_extra)).tobytes(),
                "ids": ids[page].tobytes(), "vectors": x[page].astype(np.int32).tobytes(),
                "distances": d.tobytes(), "norms": norms[page].tobytes()})
        return pa.Table.from_pylist(out, pa.schema([
            ("dim", pa.int32()), ("region", pa.int32()), ("salt", pa.int64()), ("root_distance", pa.float64()),
            ("radius", pa.float64()), *[(c, pa.binary()) for c in ("centre", "ids", "vectors", "distances", "norms")]]))
    return run


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > k:
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Tree:
    """The pages of one tree, ready to be searched."""

    def __init__(self, pages: pa.Table, dim: int, largest: int):
        self.largest, self.margin = float(largest), _margin(largest, dim)
        centres = np.array([np.frombuffer(c, np.float64) for c in pages["centre"].to_pylist()])
        self.centres, self.root = centres[:, :dim + 1], centres[0, dim + 1:]
        self.root_distance, self.radius = pages["root_distance"].to_numpy(), pages["radius"].to_numpy()
        self.ids = [np.frombuffer(b, np.int64) for b in pages["ids"].to_pylist()]
        self.vectors = [np.frombuffer(b, np.int32).reshape(-1, dim).astype(np.float64) for b in pages["vectors"].to_pylist()]
        self.distances = [np.frombuffer(b, np.float64) for b in pages["distances"].to_pylist()]
        self.computed = 0

    def search(self, own: int, q: np.ndarray, k: int, bound: float = -np.inf):
        """The ``k`` best rows other than ``own`` with scores of at least ``bound``."""
        norm = float(q @ q) + self.largest
        reach = lambda score: np.sqrt(max(norm - 2 * score, 0.0)) + self.margin if score > -np.inf else np.inf
        point = np.append(q, 0.0)
        to_root = np.sqrt(((self.root - point) ** 2).sum())
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        limit = reach(bound)
        # Pages that the stored distance to the root does not exclude.
        open_pages = np.flatnonzero(np.abs(to_root - self.root_distance) - self.radius <= limit)
        to_centre = np.sqrt(((self.centres[open_pages] - point) ** 2).sum(axis=1))
        nearest = np.maximum(to_centre - self.radius[open_pages], 0.0)
        for at in np.argsort(nearest, kind="stable"):
            if nearest[at] > limit:
                break
            page, d = open_pages[at], to_centre[at]
            # Rows whose stored distance to the centre does not exclude them (they are sorted by it).
            stored = self.distances[page]
            lo, hi = np.searchsorted(stored, d - limit, "left"), np.searchsorted(stored, d + limit, "right")
            if lo >= hi:
                continue
            self.computed += hi - lo
            ids, scores = self.ids[page][lo:hi], self.vectors[page][lo:hi] @ q
            near = (scores >= bound) & (ids != own)
            best_ids, best = _top(np.append(best_ids, ids[near]), np.append(best, scores[near]), k)
            if len(best) == k and best[-1] > bound:
                bound = best[-1]
                limit = reach(bound)
        return best_ids, best


def _search(largest: int, k: int, only_bound: bool):
    names = ["query_id", "bound"] if only_bound else [f.split()[0] for f in FOUND.split(", ")]

    def run(key: tuple, queries: pa.Table, pages: pa.Table) -> pa.Table:
        ids, vecs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if queries.num_rows and pages.num_rows:
            dim = key[0].as_py()
            tree = Tree(pages, dim, largest)
            bounds = queries["bound"].to_pylist() if "bound" in queries.column_names else [None] * queries.num_rows
            for own, v, bound in zip(queries["vec_id"].to_pylist(), queries["v"].to_pylist(), bounds):
                q = np.frombuffer(v, np.int32).astype(np.float64)
                found, best = tree.search(own, q, k, -np.inf if bound is None else bound)
                if only_bound:
                    found, best = found[k - 1:], best[k - 1:]
                ids.append(np.full(len(found), own))
                vecs.append(found)
                scores.append(best)
        found = [np.concatenate(ids), np.concatenate(vecs), np.concatenate(scores).astype(np.int64)]
        return pa.table([pa.array(c, pa.int64()) for c in (found if not only_bound else [found[0], found[2]])], names)
    return run


def _route(pivots: dict[int, np.ndarray], reach: dict[tuple[int, int], tuple[float, int]], largest: int):
    """(query, tree) for each tree whose region may hold a row within the query's bound."""
    def run(batches):
        for batch in batches:
            rows, regions, salts = [], [], []
            for i, (dim, norm, v, bound) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("dim", "norm", "v", "bound")))):
                p = pivots[dim]
                q = np.frombuffer(v, np.int32).astype(np.float64)[None, :]
                d = _distances(q, np.zeros(1), p, _extra((p * p).sum(axis=1), largest))[0]
                limit = np.inf if bound is None else np.sqrt(max(norm + largest - 2 * bound, 0.0)) + _margin(largest, dim)
                for region in range(len(p)):
                    radius, trees = reach.get((dim, region), (0.0, 0))
                    if trees and d[region] - radius <= limit:
                        rows += [i] * trees
                        regions += [region] * trees
                        salts += range(trees)
            out = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(regions, pa.int32()), pa.array(salts, pa.int64())],
                                             [*out.schema.names, "region", "salt"])
    return run


def _whole(norm: int | None, v: bytes) -> list[int]:
    """The exact components of a row of ``VECTORS``."""
    if norm is not None:
        return np.frombuffer(v, np.int32).tolist()
    with np.errstate(over="ignore"):
        x = np.frombuffer(v, np.float64)
        scaled = np.floor(64.0 * x)
    return [int(b) if np.isfinite(b) else 64 * int(a) for a, b in zip(x.tolist(), scaled.tolist())]


def _rounded(norms: list, vectors: list) -> np.ndarray:
    """The components as doubles; infinite where 64 times a component is."""
    with np.errstate(over="ignore"):
        return np.array([np.frombuffer(v, np.int32).astype(np.float64) if n is not None
                         else np.floor(64.0 * np.frombuffer(v, np.float64)) for n, v in zip(norms, vectors)])


def _beyond(score: int) -> tuple[int | None, int, str | None]:
    """``score, beyond, digits``: numbers beyond 64 bits order by their signed bit length, then by their digits."""
    if -2 ** 63 <= score < 2 ** 63:
        return score, 0, None
    bits = abs(score).bit_length()
    digits = score if score > 0 else 2 ** bits - 1 + score
    return None, bits if score > 0 else -bits, f"{digits:0{-(-bits // 4)}x}"


def _search_large(k: int):
    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and rows.num_rows:
            ids, norms, vectors = rows["vec_id"].to_numpy(), rows["norm"].to_pylist(), rows["v"].to_pylist()
            x, whole = _rounded(norms, vectors), {}
            with np.errstate(over="ignore", invalid="ignore"):
                lengths = np.sqrt((x * x).sum(axis=1))
                for own, *q in zip(*(queries[c].to_pylist() for c in ("vec_id", "norm", "v"))):
                    y, exact = _rounded(q[:1], q[1:])[0], _whole(*q)
                    near = x @ y
                    wrong = (len(y) + 8) * np.finfo(np.float64).eps * lengths * np.sqrt((y * y).sum())
                    known = np.isfinite(near) & np.isfinite(wrong)
                    low, high = np.where(known, near - wrong, -np.inf), np.where(known, near + wrong, np.inf)
                    other = np.flatnonzero(ids != own)
                    if len(other) > k:
                        other = other[high[other] >= np.partition(low[other], len(other) - k)[len(other) - k]]
                    scored = []
                    for i in other.tolist():
                        if i not in whole:
                            whole[i] = _whole(norms[i], vectors[i])
                        scored.append((-sum(a * b for a, b in zip(whole[i], exact)), int(ids[i])))
                    out += [(own, i, *_beyond(-score)) for score, i in sorted(scored)[:k]]
        kinds = [pa.int64()] * 3 + [pa.int32(), pa.string()]
        return pa.table([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)],
                        [f.split()[0] for f in LARGE_FOUND.split(", ")])
    return run


def _large_found(vectors: DataFrame, n: int, n_large: int, n_asked: int, k: int, tree_rows: int, query_block: int) -> DataFrame:
    """The best rows of every query and block of rows, for pairs with a large vector."""
    def pairs(queries: DataFrame, n_queries: int, rows: DataFrame, n_rows: int) -> DataFrame:
        parts, blocks = max(1, -(-n_rows // tree_rows)), max(1, -(-n_queries // query_block))
        every_of = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
        at = lambda seed, m: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(m).cast("long"))
        keys = ["dim", "part", "block"]
        queries = queries.withColumn("block", at(1, blocks)).withColumn("part", every_of(parts))
        rows = rows.withColumn("part", at(2, parts)).withColumn("block", every_of(blocks))
        return queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(_search_large(k), LARGE_FOUND)

    asked, large = vectors.where("asked"), vectors.where("norm IS NULL")
    return pairs(asked.where("norm IS NULL"), n_large, vectors, n).unionByName(
        pairs(asked.where("norm IS NOT NULL"), n_asked, large, n_large))


def top_k(embeddings: DataFrame, save, k: int = TOP, every: int = EVERY, regions: int = REGIONS, tree_rows: int = TREE_ROWS,
          page_rows: int = PAGE_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows.  ``save(df, label)`` writes a table to the
    shared scratch folder and reads it back."""
    # Rows go by their place in order of id: unique, and ties between places are ties between ids.
    keyed = ranked(integer_vectors(embeddings), [F.col("vec_id")], save, "integers").select(
        F.col("position").alias("vec_id"), "dim", "norm", "v", (F.col("vec_id") % every == 0).alias("asked"), F.col("vec_id").alias("id"))
    saved = save(keyed, "vectors")
    vectors, ids = saved.drop("id"), saved.select("vec_id", "id")
    sizes = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n_all"), F.count("norm").alias("n"), F.count_if("asked").alias("n_asked"),
                                       F.max("norm").alias("largest")).collect()
    found, order = None, [F.col("score").desc(), "vec_id"]
    n, n_large, n_asked = sum(r.n_all for r in sizes), sum(r.n_all - r.n for r in sizes), sum(r.n_asked for r in sizes)
    if n > n_large:
        small = vectors.where("norm IS NOT NULL") if n_large else vectors
        found = _tree_found(small, [r for r in sizes if r.n], save, k, regions, tree_rows, page_rows, query_block)
    if n_large:
        large = _large_found(vectors, n, n_large, n_asked, k, tree_rows, query_block)
        found = large if found is None else large.unionByName(found.withColumn("beyond", F.lit(0)), allowMissingColumns=True)
        order = [F.col("beyond").desc(), F.col("score").desc(), F.col("digits").desc(), "vec_id"]
    if found is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(*order)
    top = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    asking, other = [ids.select(F.col("vec_id").alias(f"{c}_place"), F.col("id").alias(f"{c}_id")) for c in ("q", "c")]
    return (top.join(asking, F.col("query_id") == F.col("q_place")).join(other, F.col("vec_id") == F.col("c_place"))
            .select(F.col("q_id").alias("query_id"), "rank", F.col("c_id").alias("vec_id"), "score"))


TREE = ["dim", "region", "salt"]


def _dealt(queries: DataFrame, pages: DataFrame, query_block: int) -> tuple[DataFrame, DataFrame]:
    """Queries and pages with a ``block``: a tree that more than ``query_block`` queries go to is worked on in several blocks,
    and its pages are sent to these alone; those of a tree without queries stay."""
    blocks = queries.groupBy(*TREE).agg(F.ceil(F.count(F.lit(1)) / query_block).cast("long").alias("blocks"))
    dealt = queries.join(blocks, TREE).withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), "blocks")).drop("blocks")
    copied = pages.join(blocks, TREE).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    return dealt, copied


def _tree_found(vectors: DataFrame, sizes: list, save, k: int, regions: int, tree_rows: int, page_rows: int,
                query_block: int) -> DataFrame:
    """The best rows of every query and tree that it visits.  ``sizes``: rows and largest norm by length."""
    spark = vectors.sparkSession
    largest = max(r.largest for r in sizes)
    pivots = {}
    for r in sizes:          # one entry per vector length
        wanted = max(1, min(regions, -(-r.n // tree_rows)))
        sample = vectors.where(F.col("dim") == r.dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()
        pivots[r.dim] = np.unique(np.array([np.frombuffer(x.v, np.int32) for x in sample]), axis=0).astype(np.float64)
    placed = vectors.mapInArrow(_assign(pivots, largest), ROWS + ", region int, far double")
    placed = save(placed, "placed")
    # One row per region, at most `regions` for each vector length.
    reach = {(r.dim, r.region): (r.far, max(1, -(-r.n // tree_rows))) for r in placed.groupBy("dim", "region").agg(
        F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()}
    counts = spark.createDataFrame([(d, g, t) for (d, g), (_, t) in reach.items()], "dim int, region int, trees long")
    salted = placed.join(F.broadcast(counts), ["dim", "region"]).withColumn("salt", F.pmod(F.xxhash64("vec_id"), "trees"))
    pages = save(salted.select("vec_id", "dim", "norm", "v", "region", "salt").groupBy("dim", "region", "salt").applyInArrow(
        _build(largest, page_rows), TREES), "pages")
    queries = salted.where("asked").select("vec_id", "norm", "v", *TREE)
    home, copied = _dealt(queries, pages, query_block)
    keys = [*TREE, "block"]
    first = home.select("vec_id", "v", *keys).groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInArrow(
        _search(largest, k, True), "query_id long, bound long")
    bounds = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.max("bound").alias("bound"))
    bounded = queries.select("vec_id", "dim", "norm", "v").join(bounds, "vec_id", "left")
    routed = save(bounded.mapInArrow(_route(pivots, reach, largest),
                                     "vec_id long, dim int, norm long, v binary, bound long, region int, salt long"), "routed")
    sent, copied = _dealt(routed, pages, query_block)
    return sent.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInArrow(_search(largest, k, False), FOUND)
