"""Ordinal quality classifier: cumulative-link regression on graded ratings.

Grades are ordered: 0 junk, 1 well-formed but toxic, 2 clean.  One weight vector over hashed
words and text-shape buckets is shared by all grades, and ordered thresholds cut its score:
``P(grade >= k) = sigmoid(w.x - t_k)`` with ``t_1 < t_2``.  The model gives every document an
expected grade and the tail probability used for selection.

Fitting uses at most ``sample`` labelled documents (default 8,000), those with the smallest hash of
the id: a documented bound.  Only their hashed features reach the driver.  Scoring covers
every document and whole texts, in one pass without a shuffle.

A null text counts as empty.  Labels without a document, or with a null quality, are ignored; a
document labelled several times takes its lowest grade.  Of several rows with a labelled id one counts
(smallest hash of the text).  With fewer than two grades, or no feature that tells them apart, there is no
model: a warning says so, scores are null and every document is kept.
"""

from __future__ import annotations

import warnings
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 18
GRADES = 3
SAMPLE = 8_000
KEEP_FROM = 0.5         # documents with P(clean) of this or more are kept
SCHEMA = "doc_id long, expected_grade double, p_well_formed double, p_clean double"

_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()
_UPPER, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
_SYMBOLS = b"#*$%&|<>!~^{}[]\\=_"
_LEVELS = np.array([0.002, 0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9])


def _shape(name: str, share: float) -> set[bytes]:
    """One feature for every level that the share reaches (so that neighbours share weights)."""
    return {b"\x00%s:%d" % (name.encode(), k) for k in range(int(np.searchsorted(_LEVELS, share)) + 1)}


def features(text: bytes) -> np.ndarray:
    """The distinct hashed features of a whole text."""
    words = text.translate(_SPACED).split()
    distinct = set(words)
    n = max(1, len(words))
    letters = max(1, len(text) - len(text.translate(None, _LETTERS)))
    pairs = len(set(zip(words, words[1:])))
    distinct |= (
        _shape("symbols", (len(text) - len(text.translate(None, _SYMBOLS))) / n)
        | _shape("upper", (len(text) - len(text.translate(None, _UPPER))) / letters)
        | _shape("repeated", 1 - (pairs + 1) / n)
        | {b"\x00words:%d" % min(12, n.bit_length())})
    hashed = np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct)) & np.uint32((1 << BITS) - 1)
    return np.unique(hashed).astype(np.int32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray       # float32, one per hash bucket
    thresholds: np.ndarray    # increasing, one per grade above 0

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. as columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def objective(p: np.ndarray, row: np.ndarray, col: np.ndarray, grades: np.ndarray, n: int, l2: float) -> tuple[float, np.ndarray]:
    """Penalised log likelihood and its gradient at ``p``: ``n`` weights, the first threshold and the logarithms of the
    gaps.  ``row`` and ``col`` list the features' places."""
    gaps = np.exp(p[n + 1:])
    t = p[n] + np.concatenate([[0.0], np.cumsum(gaps)])
    score = np.bincount(row, weights=p[col], minlength=len(grades))
    tail = 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -60, 60)))
    bounds = np.concatenate([np.ones((len(grades), 1)), tail, np.zeros((len(grades), 1))], axis=1)
    at = np.arange(len(grades))
    prob = np.maximum(bounds[at, grades] - bounds[at, grades + 1], 1e-9)
    slope = bounds * (1 - bounds)
    # d log prob / d (score - t_j), for the two thresholds around the grade
    d = np.zeros_like(bounds)
    d[at, grades] += slope[at, grades] / prob
    d[at, grades + 1] -= slope[at, grades + 1] / prob
    by_threshold = d[:, 1:-1]
    g_score, g_t = by_threshold.sum(axis=1), -by_threshold.sum(axis=0)
    grad = np.concatenate([
        np.bincount(col, weights=g_score[row], minlength=n) - l2 * p[:n],
        [g_t.sum()], np.cumsum(g_t[::-1])[::-1][1:] * gaps])
    return float(np.log(prob).sum() - l2 / 2 * (p[:n] ** 2).sum()), grad


def fit(rows: list[np.ndarray], grades: np.ndarray, l2: float = 0.3, steps: int = 600,
        screen: float = 4.0) -> Model | None:
    """Maximum likelihood with an L2 penalty, by Adam on all rows at each step.

    Features of fewer than 5 rows get no weight, nor do those whose rows reach each next grade
    about as often as all rows do (within ``screen`` standard errors).  None where nothing can be
    learnt: fewer than two grades, or no feature with a weight."""
    if len(rows) == 0 or len(np.unique(grades)) < 2:
        return None
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows)), sizes)
    seen = np.bincount(flat, minlength=1 << BITS)
    told = np.zeros(1 << BITS, bool)
    for k in range(1, GRADES):        # among the rows that reach grade k - 1: do those with it reach k?
        rows_k = grades >= k - 1
        share = (grades[rows_k] >= k).mean() if rows_k.any() else 0.0
        with_it = np.bincount(flat[rows_k[row]], minlength=1 << BITS)
        reach = np.bincount(flat[(grades >= k)[row]], minlength=1 << BITS)
        error = np.sqrt(np.maximum(share * (1 - share) * with_it, 0.25))
        told |= np.abs(reach - share * with_it) > screen * error
    known = np.flatnonzero(told & (seen >= 5) & (seen < len(rows)))
    if not len(known):
        return None
    column = np.full(1 << BITS, -1)
    column[known] = np.arange(len(known))
    col = column[flat]
    row, col = row[col >= 0], col[col >= 0]
    k = np.arange(1, GRADES)
    above = (grades[:, None] >= k[None, :])
    share = np.clip(above.mean(axis=0), 0.01, 0.99)
    start = -np.log(share / (1 - share))
    # Parameters: weights, first threshold, logarithms of the gaps (so that order holds).
    p = np.concatenate([np.zeros(len(known)), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    n = len(known)
    for step in range(1, steps + 1):
        _, grad = objective(p, row, col, grades, n, l2)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        p = p + 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[known] = p[:n]
    return Model(weights, p[n] + np.concatenate([[0.0], np.cumsum(np.exp(p[n + 1:]))]))


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``grade`` from the quality and toxic marks; one row per document."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce(F.col("toxic"), F.lit(0)) == 0, 2).otherwise(1)
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).alias("grade")))


def _feature_batches(batches):
    for batch in batches:
        found = [features(t.as_py() or b"") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([f.tobytes() for f in found], pa.binary())],
            ["doc_id", "grade", "features"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> Model | None:
    """The model of at most ``sample`` labelled documents, those with the smallest hashes of their ids.

    Of the rows of one id the one with the smallest hash of its text counts, chosen in Spark, so that a repeated id
    weighs as much as any other.  Without a usable model (``fit``) a warning is given and None returned:
    ``score`` marks all documents as not judged then, and ``select`` keeps them."""
    chosen = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text"))
    one_each = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")   # at most `sample` rows
                .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "grade")).alias("r")))
    labelled = one_each.select("doc_id", "r.text", "r.grade").mapInArrow(_feature_batches, "doc_id long, grade int, features binary")
    rows = sorted(labelled.collect(), key=lambda r: r.doc_id)
    model = fit([np.frombuffer(r.features, np.int32) for r in rows],
                np.array([r.grade for r in rows], np.int64), **options)
    if model is None:
        warnings.warn(f"no classifier could be fitted on {len(rows)} labelled documents: nothing is judged", stacklevel=2)
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text"))
    if model is None:
        return read.select("doc_id", *[F.lit(None).cast("double").alias(c.split()[0])
                                       for c in SCHEMA.split(", ")[1:]])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            scores = np.array([own.weights[features(t.as_py() or b"")].sum(dtype=np.float64)
                               for t in batch.column(1)])
            tails = own.tails(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, 1])],
                [c.split()[0] for c in SCHEMA.split(", ")])

    return read.mapInArrow(run, SCHEMA)


def kept() -> Column:
    return F.coalesce(F.col("p_clean") >= KEEP_FROM, F.lit(True))


def select(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their own columns (no shuffle)."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))
    at = docs.columns.index("text")

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            scores = np.array([own.weights[features((t.as_py() or "").encode())].sum(dtype=np.float64)
                               for t in batch.column(at)])
            yield batch.filter(pa.array(own.tails(scores)[:, 1] >= KEEP_FROM))

    return docs.mapInArrow(run, docs.schema)
