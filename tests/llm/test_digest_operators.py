"""Merkle manifest, fingerprints and centroid clusters against brute force, with odd rows."""

import hashlib
import random
import re
import zlib
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from metricfold.llm import fingerprints, merkle_manifest, orchard_clusters
from metricfold.llm.ranks import ranked
from metricfold.llm.scratch import save
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tree long, n long, lo long, digest string, "
          "own string, block long, at int, role string, part int, position long")
EXTRA = (1, 2, 3, "d", "o", 4, 5, "r", 6, 7)


def rows_of(pairs):
    return [(i, t, lang, "sé", n, *EXTRA) for n, (i, t, lang) in enumerate(pairs)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = "Alpha beta Gamma delta eps É zeta eta".split()
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    many = [(i, text(i % 40), f"l{i % 23}" if i % 23 else None) for i in range(200)]
    odd = [(None, "Null id text", "en"), (None, None, None), (300, "", "en"), (301, " \n\t ", "en"), (302, None, "en"),
           (303, text(30_000), "en"), (304, "x" * 100_000, "zz"), (305, "same id A", "en"), (305, "same id B", "en")]
    return rows_of([*many, *odd, *[(7, "equal Row", "en")] * 1_030, *[(None, "equal Row", "en")] * 3])


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_oracles(spark):
    con = duck(SF)
    for name in ("op11_merkle_manifest", "op12_fingerprints", "op13_orchard_clusters"):
        problems, _, n = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
        assert n and not problems, (name, problems)


def test_positions(docs):
    got = ranked(docs.select("doc_id", "text"), [F.col("doc_id").desc_nulls_last(), F.col("text")], save).collect()
    assert sorted(r["position"] for r in got) == list(range(len(got)))
    order = [(r["doc_id"] is None, -(r["doc_id"] or 0)) for r in sorted(got, key=lambda r: r["position"])]
    assert order == sorted(order)


# ---- Merkle manifest ------------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append((level[first:i], level[i + 1:first + 8]))
        i //= 8
    return out


def manifest(rows):
    languages = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        known = leaf(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        found = leaf(doc_id, source, lang, n_chars, ascii_lower(text)) if hit else known
        languages.setdefault(lang, []).append((doc_id is not None, doc_id or 0, known, found))
    order = sorted(languages, key=lambda x: (x is not None, (x or "").encode()))
    trees = [tree_of([x[2] for x in sorted(languages[lang])]) for lang in order]
    top = tree_of([t[-1][0] for t in trees])
    for j, lang in enumerate(order):
        for i, (has_id, doc_id, known, found) in enumerate(sorted(languages[lang])):
            path = path_of(trees[j], i) + path_of(top, j)
            folded = found
            for before, after in path:
                folded = H(*before, folded, *after)
            yield (doc_id if has_id else None, known, trees[j][-1][0], top[-1][0], H(*[s for b, a in path for s in b + a]), folded,
                   folded == top[-1][0])


def verified(docs):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle_manifest.verified(docs, save, changed, F.translate("text", merkle_manifest.UPPER, merkle_manifest.LOWER)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest(spark, docs, none, rows):
    assert sorted(map(tuple, verified(docs).collect()), key=str) == sorted(manifest(rows), key=str)
    assert verified(none).count() == 0
    for few in (rows[:1], rows[:9], [r for r in rows if r[2] == "zz"]):      # a lone leaf, languages of one leaf
        assert sorted(map(tuple, verified(spark.createDataFrame(few, SCHEMA)).collect()), key=str) == sorted(manifest(few), key=str)


def test_intervals_nest(docs):
    nodes = save(merkle_manifest.labelled(merkle_manifest.leaves(docs, F.lit(False), F.col("text")), save), "nodes")
    for level in merkle_manifest.levels(nodes, save):
        for r in level.collect():
            spans = [(c["lo"], c["hi"]) for c in r["children"]]
            assert (r["lo"], r["hi"]) == (spans[0][0], spans[-1][1]) and 1 <= len(spans) <= 8
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


# ---- fingerprints ---------------------------------------------------------------------------

def sketch(text, k=128):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = {" ".join(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    return sorted(hashlib.md5(s.encode()).hexdigest()[:16] for s in shingles)[:k]


def alike(a, b, k=128):
    both = sorted({*a, *b})[:k]
    return len({*both} & {*a} & {*b}) / len(both) if both else 1.0


def brute_fingerprints(rows):
    texts = [(i, t or "") for i, t, *_ in rows]
    texts.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    for (i, t), (_, other) in zip(texts, texts[1:] + texts[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + other[:half]
        a, b, c = sketch(t), sketch(edited), sketch(other)
        yield i, len(t), H(edited), "".join(a), "".join(b), alike(a, b), alike(a, c)


FIRST = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_fingerprints(spark, docs, none, rows):
    got = sorted(map(tuple, fingerprints.digests(docs, save).select(*FIRST).collect()), key=str)
    assert got == sorted(brute_fingerprints(rows), key=str)
    assert fingerprints.digests(none, save).count() == 0
    one = spark.createDataFrame(rows[30:31], SCHEMA)
    assert list(map(tuple, fingerprints.digests(one, save).select(*FIRST).collect())) == list(brute_fingerprints(rows[30:31]))


def test_fingerprints_are_native(docs):
    plan = fingerprints.digests(docs, save)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|InPandas", plan)


def test_estimates(spark):
    """Merged sketches equal the whole's; resemblance, containment and counts come near the truth."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(100_000)]
    texts = [" ".join(rng.choices(words, k=1_500)) for _ in range(8)]
    pairs = [(k, j, " ".join(texts[j:j + 2])) for k in range(2) for j in range(k, 6 + k)]
    df = fingerprints.with_sketch(spark.createDataFrame(pairs, "part int, j int, text string"), "text", "sketch")
    whole = {r["part"]: r["sketch"] for r in fingerprints.merged_by(df, ["part"]).collect()}
    for part in (0, 1):
        assert whole[part] == sorted({x for k, _, t in pairs if k == part for x in sketch(t)})[:128]
    a, b = " ".join(texts[:4]), " ".join(texts[2:4])
    one = fingerprints.with_sketch(fingerprints.with_sketch(spark.createDataFrame([(a, b)], "a string, b string"), "a", "sa"), "b", "sb")
    r = one.select(fingerprints.likeness(F.col("sa"), F.col("sb")).alias("j"), fingerprints.contained(F.col("sb"), F.col("sa")).alias("c"),
                   fingerprints.distinct(F.col("sa")).alias("n"), (fingerprints.merged(F.col("sa"), F.col("sb")) == F.col("sa")).alias("m")).first()
    assert abs(r["j"] - 0.5) < 0.15 and r["c"] > 0.7 and abs(r["n"] / 5_996 - 1) < 0.3


# ---- centroid clusters ----------------------------------------------------------------------

def brute_clusters(rows):
    vectors = [(i, [floor(Fraction(x) * 1024) for x in v]) for i, v, *_ in rows
               if v is not None and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    centroids = [v for _, v in sorted(vectors, key=lambda r: (r[0] is None, H(f"3:{r[0]}")))[:8]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in vectors]

    for _ in range(10):
        found = assign()
        for j in range(len(centroids)):
            members = [v for (_, k), (_, v) in zip(found, vectors) if k == j]
            if members:
                centroids[j] = [sum(c) // len(members) for c in zip(*members)]
    found = assign()
    fits = lambda n: n if n < 2 ** 63 else None
    return [(i, j, fits(d), fits(sum(x for x, k in found if k == j)), fits(sum(x for x, _ in found)), H(",".join(map(str, centroids[j]))))
            for (d, j), (i, _) in zip(found, vectors)]


VECTORS = "vec_id long, embedding array<double>, cluster int, distance long, small binary"


def clusters(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    return sorted(map(tuple, orchard_clusters.with_inertia(*orchard_clusters.clustered(df, save)).collect()), key=str)


def test_clusters(spark):
    rng = random.Random(2)
    usual = [(i, [rng.gauss(0, 1) for _ in range(64)], 1, 2, b"x") for i in range(90)]
    coarse = [(i, [float(rng.choice([0, 1])) for _ in range(64)], 1, 2, b"x") for i in range(12)]     # ties, equal centroids
    copies = [(1_000 + i, coarse[i % 3][1], 1, 2, b"x") for i in range(200)]
    odd = [(200, None, 1, 1, None), (201, [1.0] * 63, 1, 1, None), (202, [float("nan")] * 64, 1, 1, None), (203, [None] * 64, 1, 1, None),
           (204, [float("inf")] + [0.0] * 63, 1, 1, None), (None, [0.5] * 64, 1, 1, None), (usual[3][0], usual[3][1], 1, 1, None)]
    large = [(300, [1.7e308] * 64, 1, 1, None), (301, [-2.0 ** 20] * 64, 1, 1, None), (302, [2.0 ** 60] + [-0.3] * 63, 1, 1, None)]
    for rows in (usual + odd, coarse + copies, usual + odd + large, usual[:1], usual[:3], []):
        assert clusters(spark, rows) == sorted(brute_clusters(rows), key=str)


def test_orchard_computes_less():
    """Exact, and few distances where centroids lie far apart."""
    rng = np.random.default_rng(4)
    points = rng.integers(-10_000, 10_000, (64, 16))
    x = points[rng.integers(0, 64, 2_000)] + rng.integers(-300, 300, (2_000, 16))
    found, distance, computed = orchard_clusters.nearest(x, orchard_clusters.Centroids(points.tolist()).table(False))
    far = ((x[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    assert (found == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
    assert computed < 0.6 * far.size
