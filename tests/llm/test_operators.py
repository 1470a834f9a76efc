"""Each corpus operator against brute force, with nulls, empty and long texts, repeated rows, empty
tables and clashing column names."""

import hashlib
import os
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from metricfold.llm import (
    chat_windows,
    jaccard_join,
    license_scan,
    metric_tree,
    mixing,
    ordinal_quality,
    piece_codec,
    quality_rules,
    shared_keys,
    suffix_dedup,
    token_order,
)
from metricfold.llm.components import components
from metricfold.llm.scratch import save

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, target double, size long, shard long, chunk int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    prose = lambda n: " ".join(rng.choice(WORDS, n)) + "."
    base, passage = prose(120), prose(30)
    near = base.split()
    near[60] = "changed"
    texts = [base, None, "", " \n\t ", "one two", "one two", base, " ".join(near), prose(90) + passage, prose(80) + passage,
             "É" * 70, "x" + "É" * 70, prose(4000), "A B c\nA B c\nA B c\n" * 30, "the only, licensed under CC BY-NC 4.0.",
             "ONE two"]
    out = [(i, t, "en", "ab"[i % 2] if i % 5 else None, len(t or ""), 0.5, 7, 1, 2) for i, t in enumerate(texts)]
    return [*out, (None, base, "en", "c", 1, 0.5, 7, 1, 2), (20, base, "en", "c", 1, 0.5, 7, 1, 2)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_rules(docs, none, rows):
    got = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = list(zip(words, words[1:], words[2:]))
        n = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\v\f")]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.kept and r.base_failed)
    ledger = quality_rules.ledger(docs)
    for r in quality_rules.ablations(ledger).collect():
        mask, bit = quality_rules.mask_of(r.policy), quality_rules.BIT[r.rule]
        bits = [x.fail_bits & mask for x in ledger.collect()]
        assert (r.failed, r.failed_alone, r.kept, r.kept_without) == (
            sum(b & bit > 0 for b in bits), bits.count(bit), bits.count(0), sum(b & ~bit == 0 for b in bits))
    assert quality_rules.judged(none).count() == 0


def test_suffix_dedup(docs, none, rows):
    last = np.iinfo(np.int64).max
    first = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first[b[k:k + 50]] = min(first.get(b[k:k + 50], last), last if i is None else i)
    got = {r.doc_id: r for r in suffix_dedup.spans_removed(docs).collect()}
    left = {}
    for i, t, *_ in rows:
        b, own = (t or "").encode(), last if i is None else i
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < own:
                gone[k:k + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        left[i] = kept.decode("utf-8", "ignore")
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), i
    cleaned = suffix_dedup.cleaned(docs)
    assert cleaned.schema.names == docs.schema.names
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert 6 not in texts and 20 not in texts and 0 in texts and texts[1] is None
    assert all(t == left[i] for i, t in texts.items() if t is not None)
    assert suffix_dedup.spans_removed(none).count() == 0 and suffix_dedup.cleaned(none).count() == 0


@pytest.fixture(scope="module")
def hot_rows():
    """Rows of a null id and of one repeated id, each with most of the text, and a few that they repeat."""
    rng = np.random.default_rng(21)
    prose = lambda n: " ".join(rng.choice(WORDS, n)) + f" {rng.integers(0, 2**60)}."
    passage = prose(25)
    texts = [prose(60) + passage * (i % 3 == 0) for i in range(90)]
    texts[50], texts[70] = texts[10], texts[40]
    return [((None, 5, 100 + i)[i % 3], t) for i, t in enumerate(texts)]


def test_hot_ids_spread_over_chunks(spark, hot_rows, monkeypatch):
    monkeypatch.setattr(shared_keys, "CHUNK_BYTES", 4000)
    docs = spark.createDataFrame(hot_rows, "doc_id long, text string").repartition(3)
    size = shared_keys.text_bytes(docs)
    chunks = Counter(r.chunk for r in shared_keys.dealt(docs, size).collect())
    hot = [{r.chunk for r in shared_keys.dealt(docs, size).where(c).collect()} for c in ("doc_id IS NULL", "doc_id = 5")]
    assert len(chunks) > 5 and max(chunks.values()) < 20 and all(len(h) > 5 for h in hot)
    # The results are those of brute force, also over many chunks.
    last = np.iinfo(np.int64).max
    first, want, left = {}, Counter(), Counter()
    for i, t in hot_rows:
        for k in range(len(t) - 49):
            first[t[k:k + 50]] = min(first.get(t[k:k + 50], last), last if i is None else i)
    for i, t in hot_rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49):
            if first[t[k:k + 50]] < (last if i is None else i):
                gone[k:k + 50] = True
        kept = "".join(c for c, g in zip(t, gone) if not g)
        want[i, len(t), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()] += 1
        if kept.strip():
            left[i, kept] += 1
    got = suffix_dedup.spans_removed(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == want
    assert Counter(map(tuple, suffix_dedup.cleaned(docs).collect())) == left


def test_training_order_of_hot_ids(spark, hot_rows):
    with open(token_order.vocabulary(), "rb") as file:
        ranks = file.read()
    docs = spark.createDataFrame([(None, t) for _, t in hot_rows], "doc_id long, text string")
    shards = token_order.shards(docs, ranks, length=64, slots=8, chunk_bytes=4000).collect()
    enc = token_order.encoding(ranks)
    n = sum(len(enc.encode_ordinary(t)) + 1 for _, t in hot_rows)
    assert sum(r.n_tokens for r in shards) == n
    assert sum(r.n_slots for r in shards) > -(-n // 64)         # several chunks, each with a last sequence of its own
    again = token_order.shards(docs.repartition(5), ranks, length=64, slots=8, chunk_bytes=4000).collect()
    assert {r.sha256 for r in again} == {r.sha256 for r in shards}


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    text = np.concatenate([text, text[50:200], text])
    starts, owners = np.arange(len(text) - 49), rng.integers(0, 5, len(text) - 49)
    order, lcp = suffix_dedup.suffix_array(text, starts, owners)
    key = [(text[s:s + 50].tobytes(), owners[s]) for s in order]
    assert key == sorted(key)
    assert lcp.tolist() == [0] + [common_prefix(a[0], b[0]) for a, b in zip(key, key[1:])]


def common_prefix(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("seed", range(12))
def test_longest_previous_factors(seed):
    """Against plain search: random texts of few letters, repeated passages, ties of owners, several depths."""
    rng = np.random.default_rng(seed)
    depth, n = (8, 13, 50)[seed % 3], int(rng.integers(120, 220))
    text = rng.integers(97, 98 + seed % 4, n).astype(np.uint8)
    text[n // 2:n // 2 + 60] = text[:60]
    starts = np.arange(n - depth + 1)
    owners = rng.integers(0, 1 + seed, len(starts)).astype(np.int64)
    pieces = [text[i:i + depth].tobytes() for i in starts]
    want = [max((common_prefix(pieces[i], pieces[j]) for j in starts if owners[j] < owners[i]), default=0) for i in starts]
    assert suffix_dedup.longest_previous_factors(text, starts, owners, depth).tolist() == want
    whole = suffix_dedup.longest_previous_factors(text, starts, owners, depth, least=depth)
    assert whole.tolist() == [w if w == depth else 0 for w in want]
    assert len(suffix_dedup.longest_previous_factors(text, starts[:0], owners[:0], depth)) == 0


def brute_groups(rows, width, percent):
    sets = {}
    for i, t, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = set(zip(*[words[k:] for k in range(width)]))
        sets[i] = grams if len(words) >= width else {tuple(words)} if words else set()
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if None not in (a, b) and sets[a] and 100 * common >= percent * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    return {i: (len(s), group[i]) for i, s in sets.items()}


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_jaccard_join(docs, none, rows, width, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.grouped(docs, save, width, percent).collect()}
    assert got == brute_groups(rows, width, percent)
    kept = jaccard_join.one_of_each(docs, save, width, percent)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, g) in got.items() if i == g or i is None}
    if width == 4:
        assert jaccard_join.grouped(none, save).count() == 0


def test_frequent_shingles_are_counted_in_all_documents(spark):
    """Shingles on and below the bound, dealt evenly to the parts or all in one, against a plain count."""
    phrase = {c: " ".join(f"{c}{i}" for i in range(6)) for c in "abcde"}       # three windows each
    rows = []
    for i in range(300):                # five parts of 60: the bound is 30 documents
        part, at = divmod(i, 60)
        inside = ["a", "a"] if at >= 20 else []
        inside += ["b"] * (part == 4 and at < 30) + ["c"] * (part == 1 and at < 29) + ["d"] * (at < 6) + ["e"] * (at < 2)
        rows.append((i, " x ".join([f"own{i} and{i} more{i} of{i}", *(phrase[c] for c in inside)])))
    rows += [(300, None), (301, "")]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows[:300], 5).union(
        spark.sparkContext.parallelize(rows[300:], 1)), "doc_id long, text string")
    want = Counter(jaccard_join.shingle_sets(pa.array([t for _, t in rows]), 4)[1].view(np.int64).tolist())
    size = sum(len(t or "") for _, t in rows)
    assert {10, 29, 30, 200} <= set(want.values())
    for part_bytes, least in ((1, 30), (1 << 20, 6)):
        got = {r.h: r.n for r in jaccard_join.frequent_shingles(frame, size, save, 4, part_bytes).collect()}
        assert got == {h: n for h, n in want.items() if n >= least}
    order = jaccard_join.shingle_order(frame, size, save, 4)
    assert [want[h] for h in order.view(np.int64).tolist()] == sorted(n for n in want.values() if n >= 6)
    assert len(jaccard_join.shingle_order(frame.limit(0), 0, save, 4)) == 0


def test_null_ids_bridge_nothing_and_other_texts_stay(spark):
    """A null-id text near to two that do not link, and an id with one near copy and one text of its own."""
    words = [f"w{i}" for i in range(100)]
    left, right = ["x1", *words[1:]], [*words[:-1], "x2"]
    far = [f"v{i}" for i in range(100)]
    texts = {"left": left, "middle": words, "right": right, "far": far, "near far": [*far[:-1], "x3"], "own": [f"u{i}" for i in range(100)]}
    rows = [(5, "left"), (None, "middle"), (6, "right"), (None, "left"), (7, "far"), (8, "near far"), (8, "own"), (None, "own")]
    # Shares of 97 windows: left and middle, middle and right have 96 in common, left and right 95.
    frame = spark.createDataFrame([(i, " ".join(texts[t])) for i, t in rows], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.grouped(frame, save, 4, 97).collect())
    assert got == Counter({(5, 97, 5): 1, (6, 97, 6): 1, (None, 97, None): 3, (7, 97, 7): 1, (8, 97, 7): 1, (8, 97, 8): 1})
    for width, percent, gone in ((4, 97, (8, "near far")), (4, 99, None)):
        kept = Counter(map(tuple, jaccard_join.one_of_each(frame, save, width, percent).collect()))
        assert kept == Counter((i, " ".join(texts[t])) for i, t in rows if (i, t) != gone), percent


def test_jaccard_join_with_blocks_and_few_hub_links(spark, monkeypatch):
    """Near copies that mostly do not link with their hub, in bundles of several blocks."""
    monkeypatch.setattr(jaccard_join, "TILE_BLOCK", 8)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        words = list(base) if i % 2 else list(rows[i // 3][1].split()) if rows else list(base)
        for at in rng.choice(100, rng.integers(0, 5), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.grouped(frame, save).collect()}
    assert got == brute_groups(rows, 4, 85) and len({g for _, g in got.values()}) > 1


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), save).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_metric_tree(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(300, 8)).astype(np.float32)
    vectors[100:160] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(1000, None), (1020, []), (1040, [float("nan")] * 8), (1060, [None] + [1.0] * 7), (None, [1.0] * 8), (1080, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in metric_tree.top_k(frame, save, tree_rows=64, page_rows=16, query_block=4).collect()]
    ints = np.floor(64 * vectors.astype(np.float64)).astype(np.int64)
    want = []
    for q in range(0, 300, 20):
        scores = ints @ ints[q]
        order = [j for j in np.lexsort((np.arange(300), -scores)) if j != q][:20]
        want += [(q, k + 1, int(j), int(scores[j])) for k, j in enumerate(order)]
    assert sorted(got) == sorted(want)
    assert metric_tree.top_k(frame.limit(0), save).count() == 0


def test_metric_tree_keeps_every_finite_vector(spark):
    """Vectors of any size as queries and candidates, against Python integers; scores beyond 64 bits are null."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(200, 8))
    x[::7] *= 3e5                       # 2^24 and more after scaling
    x[40:50] *= 2.0 ** 21
    x[60:64] = 2.0 ** 23 + rng.integers(0, 2, (4, 8)) / 64      # scores that differ in their last bits
    x[80], x[81] = 3e38, -3e38
    x[100], x[101] = 1e308, 1e308 * np.eye(8)[0]
    ints = [[64 * int(c) if abs(c) > 1e300 else int(np.floor(64 * c)) for c in v] for v in x.tolist()]
    want = []
    for q in range(0, 200, 20):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), j) for j, v in enumerate(ints) if j != q)[:20]
        want += [(q, k + 1, j, -s if -2**63 <= -s < 2**63 else None) for k, (s, j) in enumerate(scores)]
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(200, [float("inf")] * 8), (220, [float("nan")] * 8), (None, [1e6] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = metric_tree.top_k(frame, save, tree_rows=64, page_rows=16, query_block=4)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == want
    assert any(s is None for *_, s in want) and any(s and abs(s) > 2**53 for *_, s in want)
    only = metric_tree.top_k(frame.where("vec_id = 80 OR vec_id = 81"), save).collect()
    assert [tuple(r) for r in only] == [(80, 1, 81, None)]


def test_mixing(docs, none):
    sized = save(mixing.sizes(docs), "sized")
    out = mixing.allocate(sized, save(mixing.quotas(sized), "quotas")).collect()
    assert len(out) == docs.count()
    total, by = sum(r["size"] for r in out), {}
    for r in out:
        assert 0 <= r.taken <= 2 * r["size"]
        by.setdefault(r.source, [r.source_size, r.target, 0])[2] += r.taken
    names = sorted(k for k in by if k is not None) + [None]
    weights, full = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, set()
    while True:
        rest = 1.5 * total - sum(2 * by[s][0] for s in full)
        share = {s: rest * weights[s] / sum(weights[x] for x in names if x not in full) for s in names if s not in full}
        over = {s for s, t in share.items() if t > 2 * by[s][0]}
        if not over:
            break
        full |= over
    for s in names:
        target = 2 * by[s][0] if s in full else share[s]
        assert by[s][1] == pytest.approx(target) and abs(by[s][2] - target) <= mixing.BLOCK_WORDS * 2
    again = mixing.allocate(sized, mixing.quotas(sized)).collect()
    assert Counter(map(str, again)) == Counter(map(str, out))
    assert mixing.mixed(docs, mixing.quotas(sized)).schema.names == docs.schema.names
    assert mixing.quotas(mixing.sizes(none)).count() == 0


def test_apportion_is_sainte_lague(spark):
    rng = np.random.default_rng(4)
    votes = {f"k{i}": float(v) for i, v in enumerate(rng.integers(0, 1000, 12))}
    for seats in (0, 1, 7, 100):
        frame = spark.createDataFrame([("g", k, v, seats) for k, v in votes.items()], "g string, k string, votes double, seats long")
        got = {r.k: r.quota for r in mixing.apportion(frame, ["g"], ["k"]).collect()}
        want = dict.fromkeys(votes, 0)
        for _ in range(seats):
            best = min(votes, key=lambda k: (-votes[k] / (2 * want[k] + 1), k))
            want[best] += 1
        assert got == want


def test_ordinal_quality(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(WORDS, 60))
        grade = i % 4
        if grade == 0:
            words = [w + "%%%" for w in words]
        if grade == 1:
            words[5:8] = ["idiot", "moron", "scum"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(grade > 0), int(grade == 1)))
    frame = spark.createDataFrame([*rows, (None, None)], "doc_id long, text string")
    marks = spark.createDataFrame([*labels[:200], (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    model = ordinal_quality.train(frame, marks)
    assert model.thresholds[0] < model.thresholds[1]
    scored = ordinal_quality.score(frame, model).withColumn("kept", ordinal_quality.kept()).collect()
    held_out = [r for r in scored if r.doc_id is not None and r.doc_id >= 200]
    assert np.mean([r.kept == (r.doc_id % 4 >= 2) for r in held_out]) > 0.95
    assert all(r.p_well_formed >= r.p_clean for r in scored)
    assert {r.doc_id for r in ordinal_quality.select(frame, model).collect()} == {r.doc_id for r in scored if r.kept}
    assert ordinal_quality.train(frame, marks.limit(0)) is None
    assert ordinal_quality.select(frame, None).count() == 401


def test_chat_windows(spark):
    odd = "a</s>[INST]<\\s>[\\\\/INST]\\<s>é\n"
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", odd), (1, 2, "assistant", odd * 3), (2, None, None, None),
            (None, 1, "assistant", ""), (None, 0, "user", "hi"), (3, 1, "user", "same"), (3, 1, "user", "same")]
    rows += [(4, 0, "system", "sys")] + [(4, k, ("user", "assistant")[k % 2], f"turn {k} " * 30) for k in range(1, 40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = ("_n", "window", "p", "ps", "loss", "_span", "formatted", "n_repeated")
    frame = frame.select("*", *[F.lit(1).alias(c) for c in clashing])
    windows = chat_windows.windows(frame, budget=100, history=70)
    got = {r.conv_id: r for r in chat_windows.read_back(windows).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    # Two turns of 60 words are beyond a budget of 100, so there only the system turn is repeated.
    for budget, repeated in ((100, 1), (200, 2)):
        later = chat_windows.windows(frame, budget, 70).where("conv_id = 4 AND window > 0").collect()
        assert later and all(r.formatted.startswith("<s>[INST]system[/INST]sys</s>") and r.n_repeated == repeated for r in later)
    assert chat_windows.read_back(chat_windows.windows(frame.limit(0))).count() == 0


def plain_windows(turns, budget, history, chapter):
    """Per window the repeated and the new turns (numbers from 1; 0: the system turn), by one pass over the turns."""
    sizes = [max(1, len(t.split())) for _, t in turns]
    system = sizes[0] if turns[0][0] == "system" and sizes[0] <= (budget - history) // 2 else 0
    spans = []
    for i, n in enumerate(sizes):
        room = budget if len(spans) <= 1 else budget - history - system
        if spans and i % chapter and sum(sizes[j] for j in spans[-1]) + n <= room:
            spans[-1].append(i)
        else:
            spans.append([i])
    out = []
    for k, span in enumerate(spans):
        free = budget - sum(sizes[i] for i in span)
        shown = system if k and free >= system else 0
        old = [i for j, i in enumerate(spans[k - 1]) if sum(sizes[x] for x in spans[k - 1][j:]) <= min(history, free - shown)] if k else []
        out.append(([0] * bool(shown) + [i + 1 for i in old if i or not system], [i + 1 for i in span]))
    return out


def test_chat_budget_is_a_bound(spark, monkeypatch):
    """Windows against a plain pass, and no window over the budget unless one of its turns is."""
    monkeypatch.setattr(chat_windows, "CHAPTER", 16)
    rng = np.random.default_rng(4)
    convs = {k: [("system" if not i and k % 3 else ("assistant", "user")[i % 2], "w " * int(rng.choice([0, 3, 30, 90, 120])))
                 for i in range(int(rng.integers(1, 50)))] for k in range(40)}
    convs[90] = [("user", "w " * n) for n in (383, 384, 100, 384)]
    convs[91] = [("system", "s " * 3000)] + [("user", "w " * 50)] * 20
    convs[92] = [("user", "w " * 700), ("assistant", "a " * 5), ("user", "w " * 380)]
    rows = [(k, i, r, t) for k, ts in convs.items() for i, (r, t) in enumerate(ts)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {}
    for r in chat_windows.windows(frame, 384, 128).orderBy("conv_id", "window").collect():
        parts = [p.split("[/INST]") for p in r.formatted.split("</s>")[:-1]]
        got.setdefault(r.conv_id, []).append(([p[1] for p in parts[:r.n_repeated]], [p[1] for p in parts[r.n_repeated:]]))
    for k, ts in convs.items():
        text = [ts[0][1], *[t for _, t in ts]]
        want = plain_windows(ts, 384, 128, 16)
        assert got[k] == [([text[i] for i in old], [text[i] for i in new]) for old, new in want]
        for old, new in got[k]:
            total = sum(max(1, len(t.split())) for t in (*old, *new))
            assert total <= 384 or (len(new) == 1 and not old)
    assert [len(new) for _, new in got[90]] == [1, 1, 1, 1] and all(old != ["s " * 3000] for old, _ in got[91])


def test_license_scan(docs, none):
    scanner = license_scan.Scanner()
    text = "This work is licensed under the GNU General Public License, version 3. All rights reserved. CC-BY all rights reserved"
    n_words, n_base, first, last, base, labels, score, spans = scanner.scan(text.encode())
    assert (n_base, first, last, base) == (4, 7, 17, "cc-by,gpl,reserved") and "gpl-3.0" in labels and score == 1.0
    assert scanner.scan(b"") == (0, 0, None, None, "", "", 0.0, "")
    rng = np.random.default_rng(8)
    vocabulary = [w.decode() for w in scanner.vocabulary] + ["other"]
    for _ in range(200):       # matching statistics and base places against plain search
        words = list(rng.choice(vocabulary, 25))
        at = rng.integers(0, 20)
        words[at:at + 3] = "all rights reserved".split() if rng.random() < 0.5 else "under cc by".split()
        ids = [scanner.vocabulary.get(w.encode()) for w in words]
        got = {end: length for end, _, length in scanner.automaton.statistics(ids)}
        phrases = [p.split() for _, p in (*license_scan.BASE, *license_scan.TEMPLATES)]
        inside = {tuple(p[a:b]) for p in phrases for a in range(len(p)) for b in range(a + 1, len(p) + 1)}
        want = {e: max((e - s for s in range(e) if tuple(words[s:e]) in inside), default=0) for e in range(1, len(words) + 1)}
        assert got == {e: n for e, n in want.items() if n}
        places = [i for _, p in license_scan.BASE for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert scanner.scan(" ".join(words).encode())[1] == len(places)
    columns = license_scan.SCHEMA.replace(",", " ").split()[2::2]
    got = Counter(tuple(r) for r in license_scan.scan(docs).select("doc_id", *columns).collect())
    assert got == Counter((r.doc_id, *scanner.scan((r.text or "").encode())) for r in docs.collect())
    assert license_scan.scan(none).count() == 0


def plain_chains(words, templates, base):
    """Chains by search alone: the longest piece of a template that ends at each word, its places in each template."""
    phrases = [p.split() for p in (*base, *[t for _, t in templates])]
    inside = {tuple(p[a:b]) for p in phrases for a in range(len(p)) for b in range(a + 1, len(p) + 1)}
    longest = [max((e - s for s in range(e) if tuple(words[s:e]) in inside), default=0) for e in range(len(words) + 1)]
    matches = [e for e in range(1, len(words) + 1) if longest[e] >= license_scan.MIN_MATCH
               and (e == len(words) or longest[e + 1] != longest[e] + 1)]
    places = {e: [[b for b in range(longest[e], len(p) + 1) if p[b - longest[e]:b] == words[e - longest[e]:e]]
                  for p in phrases[len(base):]] for e in matches}
    out = []
    for k, (label, template) in enumerate(templates):
        size, chains = len(template.split()), []
        for e in matches:
            if not places[e][k]:
                continue
            after = [b for b in places[e][k] if chains and b > chains[-1][2]]
            at = after[0] if after else places[e][k][0]
            alone = {templates[j][0] for j, found in enumerate(places[e]) if found} == {label}
            telling = alone and (at == size if size <= license_scan.SHORT else longest[e] >= license_scan.IDENTIFYING)
            if after and e - longest[e] <= chains[-1][1] + license_scan.MAX_GAP:
                a, end, last, covered, known = chains[-1]
                chains[-1] = [a, e, at, covered + max(0, min(longest[e], at - last, e - end)), known or telling]
            else:
                chains.append([e - longest[e], e, at, longest[e], telling])
        out += [(label, a, e, covered / size) for a, e, _, covered, known in chains
                if known and covered / size >= license_scan.MIN_COVERED]
    return out


def test_license_chains_against_search():
    templates = license_scan.TEMPLATES[:6] + license_scan.TEMPLATES[-30:]
    base = [p for _, p in license_scan.BASE]
    scanner = license_scan.Scanner(templates)
    rng, labelled = np.random.default_rng(12), 0
    for _ in range(150):
        words = []
        for _ in range(rng.integers(1, 4)):         # notices with words lost, changed and put in
            for w in templates[rng.integers(len(templates))][1].split()[:40]:
                luck = rng.random()
                words += [] if luck < 0.03 else ["other"] if luck < 0.06 else [w, "other"] if luck < 0.09 else [w]
        want = plain_chains(words, templates, base)
        *_, labels, score, spans = scanner.scan(" ".join(words).encode())
        assert Counter(spans.split(";") if spans else []) == Counter(f"{n}:{a}-{b}:{share:.3f}" for n, a, b, share in want)
        assert score == max([share for *_, share in want], default=0.0) and {n for n, *_ in want} <= set(labels.split(","))
        labelled += bool(want)
    assert 30 < labelled < 150


def test_license_labels_need_identifying_words():
    scanner = license_scan.Scanner()
    unknown = ["licensed under the terms of the agreement", "Licensed under the Zlib license", "Licensed under CC BY-ND 3.0",
               "Licensed under CC BY-SA 3.0", "released under the MIT and others", "released under the MIT and Harvard joint imprint", "Licensed under the Apache License, Version 1.1",
               "released under the terms of the board", "This work is licensed under the GNU General Public License",
               "Licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License",
               "This work is licensed under the terms of use", "Permission is hereby granted, free of charge, to any person "
               "obtaining a copy of the Font Software, to use it", "Permission to use, copy, modify, and distribute this software "
               "and its documentation for any purpose, without fee, and without a written agreement is hereby granted",
               "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1"]
    for text in unknown:
        _, _, _, _, base, labels, score, spans = scanner.scan(text.encode())
        assert (labels, score, spans) == (base, 0.0, ""), text
    known = {"Licensed under the terms of the MIT license": "mit", "Licensed under the Apache License 2.0": "apache-2.0",
             "This work is licensed under the GNU General Public License v2": "gpl-2.0",
             "Licensed under CC BY-ND 4.0": "cc-by-nd-4.0", "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa-4.0",
             "under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc-4.0",
             "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa-4.0",
             "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
             "This work is licensed under the GNU Lesser General Public License version 3": "lgpl",
             "Neither the name of Acme nor the names of its contributors may be used to endorse or promote products derived "
             "from this software without specific prior written permission.": "bsd-3-clause",
             **{"you can redistribute it and/or modify it under the terms of the GNU %s License as published by the Free "
                "Software Foundation; either version %s of the License, or (at your option) any later version." % (name, v): label
                for name, v, label in (("General Public", "2", "gpl-2.0"), ("General Public", "3", "gpl-3.0"),
                                       ("Lesser General Public", "2.1", "lgpl"), ("Affero General Public", "3", "agpl"))},
             "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted": "isc"}
    for text, label in known.items():
        *_, base, labels, score, _ = scanner.scan(text.encode())
        assert set(labels.split(",")) - set(base.split(",")) == {label} and score >= license_scan.MIN_COVERED, text
    for label, template in license_scan.TEMPLATES:
        *_, labels, score, spans = scanner.scan(template.encode())
        assert label in labels.split(",") and score == 1.0 and f"{label}:0-{len(template.split())}:1.000" in spans.split(";")


def test_piece_codec(docs, none):
    with open(piece_codec.model_path(), "rb") as file:
        model = file.read()
    own = piece_codec.codec(model)
    texts = ["", " ", "  a  b ", "tab\tand\nline", "héß\U0001F600 \x00 <s> </s> <unk>", "▁a", "z" * 3000, "a ", "▁▁"]
    flat, sizes, back, parity = own.encode(texts)
    ids = [flat[e - n:e].tolist() for e, n in zip(np.cumsum(sizes), sizes)]
    assert ids == [own.own.encode(t) for t in texts] and back.all() and parity.all()
    assert piece_codec.decode_texts(ids[2:6], model) == texts[2:5] + [" a"]
    out = piece_codec.encode(docs, model).collect()
    assert len(out) == docs.count() and all(r.round_trip and r.parity for r in out if r.ids is not None)
    assert sum(r.ids is None for r in out) == 1 and piece_codec.encode(none, model).count() == 0


def test_unigram_model(spark):
    """Scores, byte fallback, control strings in texts and pieces over word starts, whole texts both ways."""
    with open(piece_codec.model_path(), "rb") as file:
        proto = piece_codec.parse(file.read())
    kept = [(p.piece, p.score, p.type) for p in proto.pieces if p.type not in (piece_codec.NORMAL, piece_codec.USER)]
    rng = np.random.default_rng(2)
    words = "▁ a b c d e f g ▁a ▁b ab abc bc cd de ▁ab ▁abc ▁de ef fg efg é ▁é bé ▁▁ a▁b".split(" ")
    proto.trainer_spec.model_type = 1
    del proto.pieces[:]
    for piece, score, kind in [*kept, *[(w, float(-1.5 - 6 * rng.random()), piece_codec.NORMAL) for w in words]]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    model = proto.SerializeToString()
    own = piece_codec.codec(model)
    assert not own.cuts
    texts = ["", "abc abcdefg", "  a b  c", "x日本 \U0001F600", "abcdefg" * 3000, "a\tb\nc", "<s> a </s><unk>", "▁a▁▁b"]
    texts += ["".join(rng.choice(list("abcdefg é日<s>"), 40)) for _ in range(200)]
    flat, sizes, back, parity = own.encode(texts)
    ids = [flat[e - n:e].tolist() for e, n in zip(np.cumsum(sizes), sizes)]
    assert ids == own.own.encode(texts) and parity.all() and back.all()
    assert piece_codec.decode_texts(ids[:7], model) == texts[:7]
    frame = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in piece_codec.encode(frame, model).collect()}
    assert [got[i].ids for i in range(len(texts))] == ids and got[None].ids is None


def test_training_order(docs, none, rows, workdir):
    for n in (1, 2, 5, 1000, 4097):
        assert sorted(token_order.permute(np.arange(n), n, 9).tolist()) == list(range(n))
    with open(token_order.vocabulary(), "rb") as file:
        ranks = file.read()
    shards = token_order.shards(docs, ranks, length=64, slots=8, chunk_bytes=4000)
    folder = f"file://{workdir}"
    manifest = token_order.write(shards, folder).orderBy("shard").collect()
    total = sum(r.n_slots for r in manifest)
    assert [r.first_slot for r in manifest] == [8 * r.shard for r in manifest]
    read = list(token_order.read_slots(folder, 0, total, 64, 8))
    assert len(read) == total and np.array_equal(read[5], next(token_order.read_slots(folder, 5, 1, 64, 8)))
    enc = token_order.encoding(ranks)
    end = enc.max_token_value + 1
    want = Counter(t for r in rows for t in [*enc.encode_ordinary(r[1] or ""), end])
    got = Counter(np.concatenate(read).tolist())
    assert all(got[t] == n for t, n in want.items() if t != end) and sum(r.n_tokens for r in manifest) == sum(want.values())
    again = token_order.shards(docs.repartition(5), ranks, length=64, slots=8, chunk_bytes=4000)
    assert {r.sha256 for r in again.collect()} == {r.sha256 for r in manifest}
    assert token_order.shards(none, ranks).count() == 0


HELD_BY_A_TASK = """
import re
import numpy as np, pyarrow as pa
from metricfold.llm import piece_codec

def held():
    with open("/proc/self/smaps_rollup") as file:
        return int(re.search(r"Anonymous:\\s+(\\d+)", file.read())[1]) // 1024

def batch(rows):
    words = np.random.default_rng(rows).integers(97, 123, (rows * 100, 9), dtype=np.uint8)
    texts = [" ".join(w.tobytes().decode() for w in words[i::rows]) for i in range(rows)]
    return pa.RecordBatch.from_pydict({"doc_id": list(range(rows)), "text": texts})

piece_codec.KEPT_WORDS = 0
with open(piece_codec.model_path(), "rb") as file:
    run = piece_codec._encoder(file.read(), 2)
small, large = batch(10), batch(1000)
for x in run([small]):
    pass
before, rows = held(), 0
for x in run([large]):
    rows += x.num_rows
del x
print(rows, held() - before)
"""


def test_piece_codec_gives_memory_back():
    done = subprocess.run([sys.executable, "-c", HELD_BY_A_TASK], capture_output=True, text=True, check=True, timeout=300,
                          env=os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p)})
    rows, held = map(int, done.stdout.split())
    assert rows == 1000 and held < 50       # MB that a worker holds after a task of 100,000 new words


def test_piece_codec_works_on_pieces(monkeypatch):
    seen = []
    monkeypatch.setattr(piece_codec, "_coded", lambda own, rows: seen.append(rows.num_rows) or rows)
    monkeypatch.setattr(piece_codec, "PIECE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": ["abcd", "abcd", "abcd", None, "", "x" * 50]})
    with open(piece_codec.model_path(), "rb") as file:
        run = piece_codec._encoder(file.read(), 1)
    assert pa.Table.from_batches(list(run([batch]))).equals(pa.Table.from_batches([batch])) and seen == [2, 3, 1]
