"""Clusters around centroids (Lloyd's rounds in whole numbers), with Orchard's search for the nearest centroid.

Components become integers, ``floor(1024 * x)``.  The first centroids are the vectors with the smallest hashes of
their ids.  Every round assigns each vector to its nearest centroid (squared distance, ties to the smaller
number) and replaces each centroid that has vectors by the floor of their mean.

* Orchard's search: every centroid has the list of the others, nearest first.  A vector walks the list
  of its current centroid; a closer one, or an equal one of a smaller number, becomes current and the walk goes on
  in *its* list, passing over centroids already visited.  It stops where the list's next centroid is strictly
  more than twice as far from the current one as the vector is: by the triangle inequality none beyond can
  be closer, and one at exactly twice may tie, so it is computed.  All vectors of a batch walk together in numpy.
* A round is one scan of the integer vectors, which are written once.  Each task reduces its rows to sums
  for each centroid and component, which Spark adds up: 8 x 64 sums reach the driver, whatever the table's size.
* Whole numbers throughout.  Components up to ``SMALL`` are handled as 64-bit integers, where no squared distance
  overflows.  Vectors with larger components, and all vectors while a centroid has one, are handled
  as Python integers, and sums travel as digits of 30 bits, so nothing is rounded at any size.

Results for odd input: vectors that are null, of another length, or hold null or non-finite components take no part.
Rows of one id are rows of their own; as first centroids they stand in order of their components.  Null ids have no
hash and are first centroids only where other rows are too few.  With fewer than 8 vectors there are fewer centroids;
equal first centroids leave the later one empty, where it stays as it is.  A distance or a sum beyond 64 bits is
null in the result.  An empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
SMALL = 2 ** 27                 # components: (2 * SMALL)^2 * 64 is below 2^63
DIGIT_BITS = 30
LONG = 2 ** 63

VECTORS = "vec_id long, small binary, large string"
SUMS = "cluster int, component int, digit int, amount long"
ASSIGNED = "vec_id long, cluster int, distance long, exact string"


def _scaled(x: float) -> int:
    """floor(SCALE * x) of a finite double, also where the product leaves the doubles."""
    return int(np.floor(SCALE * x)) if abs(x) < 2.0 ** 1000 else SCALE * int(x)


def _ints(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, small, large = [], [], []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not x.is_valid or len(x.values) != dimensions or x.values.null_count:
                    continue
                x = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                ids.append(i)
                if np.abs(x).max() < SMALL / SCALE:
                    small.append(np.floor(SCALE * x).astype(np.int32).tobytes())
                    large.append(None)
                else:
                    small.append(None)
                    large.append(",".join(str(_scaled(float(v))) for v in x))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(small, pa.binary()), pa.array(large, pa.string())],
                                             ["vec_id", "small", "large"])
    return run


def integer_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and the whole numbers: packed (``small``) or, if one of them is large, as text."""
    return embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x")).mapInArrow(
        _ints(dimensions), VECTORS)


def _whole(small: bytes | None, large: str | None) -> list[int]:
    return np.frombuffer(small, np.int32).tolist() if small is not None else [int(v) for v in large.split(",")]


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest hashes of ``seed:id``, in order of the hash (``clusters`` rows at most)."""
    chosen = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(chosen.asc_nulls_last(), "large", "small").limit(clusters).collect()
    return [_whole(r["small"], r["large"]) for r in rows]


@dataclass(frozen=True)
class Centroids:
    """Centroids with, for each of them, the others by distance (squared, then by number)."""
    points: list[list[int]]

    def table(self, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points, and for every centroid the others in order of distance, and these distances."""
        c = np.array(self.points, object if exact else np.int64)
        far = ((c[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        k = len(c)
        order = np.array([sorted((j for j in range(k) if j != i), key=lambda j: (far[i, j], j)) for i in range(k)],
                         np.int64).reshape(k, k - 1)
        return c, order, np.take_along_axis(far, order, axis=1)

    @property
    def small(self) -> bool:
        return all(abs(v) < SMALL for point in self.points for v in point)


def nearest(x: np.ndarray, centroids: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid, and how many distances were computed."""
    c, order, far = centroids
    n, k = len(x), len(c)
    current = np.zeros(n, np.int64)
    best = ((x - c[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, k), bool)
    visited[:, 0] = True
    at = np.zeros(n, np.int64)              # place in the list of the current centroid
    walking = np.arange(n) if k > 1 else np.zeros(0, np.int64)
    computed = n
    while len(walking):
        here, place = current[walking], at[walking]
        # Strictly beyond twice the current distance (both squared) no centroid of the list can be as close.
        walking = walking[(far[here, place] <= 4 * best[walking]).astype(bool)]
        other = order[current[walking], at[walking]]
        at[walking] += 1
        new = ~visited[walking, other]
        rows, other = walking[new], other[new]
        visited[rows, other] = True
        d = ((x[rows] - c[other]) ** 2).sum(axis=1)
        computed += len(rows)
        closer = ((d < best[rows]) | ((d == best[rows]) & (other < current[rows]))).astype(bool)
        moved = rows[closer]
        current[moved], best[moved], at[moved] = other[closer], d[closer], 0
        walking = walking[at[walking] < k - 1]
    return current, best, computed


def _matrices(batch: pa.RecordBatch, small_centroids: bool) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Row numbers, their vectors and whether these are Python integers."""
    packed = batch.column("small")
    at = np.flatnonzero(packed.is_valid().to_numpy(zero_copy_only=False))
    if len(at):
        x = np.frombuffer(b"".join(packed.take(pa.array(at)).to_pylist()), np.int32).reshape(len(at), -1).astype(np.int64)
        yield at, x if small_centroids else x.astype(object), not small_centroids
    rest = np.flatnonzero(~packed.is_valid().to_numpy(zero_copy_only=False))
    if len(rest):
        texts = batch.column("large").take(pa.array(rest)).to_pylist()
        yield rest, np.array([[int(v) for v in t.split(",")] for t in texts], object), True


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """Digits of 30 bits with the value's sign; they add up like the values do."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << DIGIT_BITS) - 1))
        value >>= DIGIT_BITS
        place += 1


def _sums(centroids: Centroids):
    """Each task's sums for every centroid and component; component -1 counts the vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {exact: centroids.table(exact) for exact in ((False, True) if centroids.small else (True,))}
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, x, exact in _matrices(batch, centroids.small):
                cluster, _, _ = nearest(x, tables[exact])
                for j in np.unique(cluster):
                    members = x[cluster == j]
                    total[j, -1] = total.get((j, -1), 0) + len(members)
                    for component, amount in enumerate(members.sum(axis=0).tolist()):
                        total[j, component] = total.get((j, component), 0) + amount
        rows = [(int(j), component, digit, amount) for (j, component), value in total.items() for digit, amount in _digits(value)]
        columns = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            ["cluster", "component", "digit", "amount"])
    return run


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one round over all vectors."""
    sums = vectors.mapInArrow(_sums(centroids), SUMS).groupBy("cluster", "component", "digit").agg(F.sum("amount").alias("amount"))
    total: dict[tuple[int, int], int] = {}
    for r in sums.collect():        # at most one row for each centroid, component and digit
        key = (r["cluster"], r["component"])
        total[key] = total.get(key, 0) + (r["amount"] << (DIGIT_BITS * r["digit"]))
    return Centroids([[total.get((j, i), 0) // total[j, -1] for i in range(len(point))] if (j, -1) in total else point
                      for j, point in enumerate(centroids.points)])


def _assigned(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {exact: centroids.table(exact) for exact in ((False, True) if centroids.small else (True,))}
        for batch in batches:
            cluster = np.zeros(batch.num_rows, np.int32)
            distance: list[int] = [0] * batch.num_rows
            for rows, x, exact in _matrices(batch, centroids.small):
                found, d, _ = nearest(x, tables[exact])
                cluster[rows] = found
                for row, value in zip(rows.tolist(), d.tolist()):
                    distance[row] = value
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster), pa.array([d if d < LONG else None for d in distance], pa.int64()),
                 pa.array([None if d < LONG else str(d) for d in distance], pa.string())],
                ["vec_id", "cluster", "distance", "exact"])
    return run


def centroid_hash(point: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, point)).encode()).hexdigest()


def clustered(embeddings: DataFrame, save: Callable[[DataFrame, str], DataFrame], clusters: int = CLUSTERS, rounds: int = ROUNDS,
              dimensions: int = DIMENSIONS, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """Each vector with its cluster and squared distance (``vec_id, cluster, distance, exact``: the distance's text
    where it leaves 64 bits), written, and the final centroids."""
    vectors = save(integer_vectors(embeddings, dimensions), "vectors")
    centroids = Centroids(first_centroids(vectors, clusters, seed))
    for _ in range(rounds if centroids.points else 0):
        centroids = moved(vectors, centroids)
    if not centroids.points:
        return embeddings.sparkSession.createDataFrame([], ASSIGNED), []
    return save(vectors.mapInArrow(_assigned(centroids), ASSIGNED), "assigned"), centroids.points


def with_inertia(assigned: DataFrame, points: list[list[int]]) -> DataFrame:
    """Adds each cluster's and the whole inertia (null beyond 64 bits) and the hash of the centroid."""
    per_cluster = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"), F.count("exact").alias("beyond")).collect()

    def as_long(rows) -> int | None:
        total = sum(int(r["inertia"] or 0) for r in rows)
        return total if total < LONG and not any(r["beyond"] for r in rows) else None

    whole = as_long(per_cluster)
    rows = [(r["cluster"], as_long([r]), whole, centroid_hash(points[r["cluster"]])) for r in per_cluster]
    # One row for each centroid: broadcast is bounded by the number of clusters.
    facts = assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
