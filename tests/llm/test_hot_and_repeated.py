"""Repeated ids, hot ids and models that cannot be fitted; the pipeline's stages against plain Python."""

import warnings
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from metricfold.llm import jaccard_join, metric_tree, mixing, ordinal_quality
from metricfold.llm.components import components
from metricfold.llm.scratch import save
from metricfold.llm.sql import OP6
from tests.llm.test_operators import WORDS, brute_groups
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op4_suffix_dedup", "op5_jaccard_join", "op6_source_mix"])
def test_oracle(spark, name):
    problems, _, rows = compare(spark, duck(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert rows and not problems


# ---- metric tree --------------------------------------------------------------------------------

def test_rows_of_one_id_are_queries_of_their_own(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(60, 8))
    rows = [(20 if i in (3, 9) else i, v.tolist(), 1, 2, 3) for i, v in enumerate(vectors) if i != 20]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, position long, part int, id long").repartition(3)
    got = Counter(tuple(r) for r in metric_tree.top_k(frame, save, tree_rows=16, page_rows=4, query_block=2).collect())
    ints = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v, *_ in rows]
    want = Counter()
    for at, (q, x) in enumerate(ints):
        if q % 20 == 0:
            best = sorted((-int(x @ y), c) for n, (c, y) in enumerate(ints) if n != at)[:20]
            want.update((q, k + 1, c, -s) for k, (s, c) in enumerate(best))
    assert got == want and sum(n for (q, *_), n in got.items() if q == 20) == 40


def test_pages_go_only_where_queries_go(spark):
    """With many small blocks a page is sent as often as its tree has blocks of queries, not to all blocks."""
    pages = spark.createDataFrame([(8, r, 0, r) for r in range(50)], "dim int, region int, salt long, page int")
    queries = spark.createDataFrame([(i, 8, 7 if i < 90 else 9, 0) for i in range(100)], "vec_id long, dim int, region int, salt long")
    dealt, copied = metric_tree._dealt(queries, pages, 10)
    assert Counter(r.region for r in copied.collect()) == {7: 9, 9: 1}
    assert {(r.region, r.block) for r in dealt.collect()} <= {(r.region, r.block) for r in copied.collect()} and dealt.count() == 100


# ---- classifier ---------------------------------------------------------------------------------

def graded_rows(n):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(n):
        words = list(rng.choice(WORDS, 60))
        if i % 3 == 0:
            words = [w + "%%%" for w in words]
        if i % 3 == 1:
            words[5:8] = ["idiot", "moron", "scum"]
        rows.append((i, " ".join(words)))
    return rows, [(i, int(i % 3 > 0), int(i % 3 == 1)) for i in range(n)]


def test_a_repeated_labelled_id_weighs_as_one(spark):
    rows, labels = graded_rows(120)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    once = ordinal_quality.train(spark.createDataFrame(rows, "doc_id long, text string"), marks, sample=100)
    often = spark.createDataFrame([*rows, *[rows[k] for k in (0, 1, 2) for _ in range(1_000)]], "doc_id long, text string").repartition(4)
    again = ordinal_quality.train(often, marks, sample=100)
    assert (once.weights == again.weights).all() and (once.thresholds == again.thresholds).all()
    kept = Counter(r.doc_id for r in ordinal_quality.select(often, again).collect())
    assert kept[2] == 1_001 and 0 not in kept and 1 not in kept


def test_without_a_learnt_feature_nothing_is_judged(spark):
    rows, labels = graded_rows(11)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for few in (labels[:1], labels[1:3], [(2, 1, 0), (5, 1, 0)], []):
        marks = spark.createDataFrame(few, "doc_id long, quality int, toxic int")
        with pytest.warns(UserWarning, match="nothing is judged"):
            model = ordinal_quality.train(docs, marks)
        assert model is None and ordinal_quality.select(docs, model).count() == 11
        assert ordinal_quality.score(docs, model).where("p_clean IS NOT NULL").count() == 0


def test_no_documents(spark):
    rows, labels = graded_rows(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert ordinal_quality.train(docs.limit(0), marks) is None
    model = ordinal_quality.train(docs, marks)
    assert ordinal_quality.score(docs.limit(0), model).count() == ordinal_quality.select(docs.limit(0), model).count() == 0


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(3)
    n, k = 6, 40
    row, col = np.repeat(np.arange(k), 3), rng.integers(0, n, 3 * k)
    grades = rng.integers(0, 3, k)
    p = rng.normal(size=n + 2) * 0.4
    value, grad = ordinal_quality.objective(p, row, col, grades, n, 0.3)
    for i in range(len(p)):
        step = np.zeros_like(p)
        step[i] = 1e-6
        up, down = (ordinal_quality.objective(p + s * step, row, col, grades, n, 0.3)[0] for s in (1, -1))
        assert grad[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


# ---- mix ------------------------------------------------------------------------------------------

def test_hot_ids_spread_over_shards_and_layouts_agree(spark):
    rng = np.random.default_rng(4)
    rows = [(None if i % 2 else 7 if i % 5 == 0 else i, "one", " ".join(rng.choice(WORDS, rng.integers(1, 30))) + f" {i}") for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sized = save(mixing.sizes(docs), "sized")
    shards = Counter(r.shard for r in sized.select(mixing.shard_of(F.lit(10)).alias("shard")).collect())
    assert len(shards) == 10 and max(shards.values()) < 2 * sorted(shards.values())[5]
    plan = save(mixing.quotas(sized), "quotas")
    taken = [Counter(map(tuple, mixing.mixed(layout, plan).collect())) for layout in (docs, docs.orderBy(F.rand(3)).repartition(5))]
    assert taken[0] == taken[1] and sum(taken[0].values()) > len(rows)


# ---- near duplicates ------------------------------------------------------------------------------

def test_one_row_for_each_id_and_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [*[(7, text, 1)] * 5, (8, text, 1), (9, "a text of its own", 1), *[(9, "another text of that id", 1)] * 2, *[(None, text, 1)] * 2, *[(3, "", 1)] * 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, goes int").repartition(3)
    kept = Counter(tuple(r) for r in jaccard_join.one_of_each(docs, save, 5, 80).collect())
    assert kept == Counter({rows[0]: 1, rows[6]: 1, rows[7]: 1, (None, text, 1): 2, (3, "", 1): 2})
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("sets_")]


def test_giant_component(spark):
    """A star and a chain; the star's nodes all have one label."""
    links = [(0, i) for i in range(1, 3_000)] + [(i, i + 1) for i in range(5_000, 5_100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), save).collect()}
    assert got == {i: 0 for i in range(3_000)} | {i: 5_000 for i in range(5_000, 5_101)}


# ---- pipeline ---------------------------------------------------------------------------------------

def removed(rows):
    """Texts without the bytes of 50-byte strings that start in a text of a smaller id as well."""
    first = {}
    for i, t in rows:
        b = t.encode()
        for k in range(len(b) - 49):
            first[b[k:k + 50]] = min(first.get(b[k:k + 50], i), i)
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < i:
                gone[k:k + 50] = True
        yield i, bytes(np.frombuffer(b, np.uint8)[~gone]).decode("utf-8", "ignore")


def test_pipeline_stages_against_plain_python(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = corpus_pipeline.table(spark, SF, "documents")
    judged = save(stages["quality_classifier"](spark, docs, SF), "judged")
    rows = sorted((r.doc_id, r.text) for r in judged.collect())
    singles = save(stages["jaccard_join"](spark, judged, SF), "singles")
    want = [(i, t) for i, t in rows if brute[i][1] == i] if (brute := brute_groups(rows, 5, 80)) else []
    assert sorted((r.doc_id, r.text) for r in singles.collect()) == want and len(want) < len(rows)
    cut = save(stages["suffix_dedup"](spark, singles, SF), "cut")
    left = [(i, t) for i, t in removed(want) if t.strip()]
    got = sorted((r.doc_id, r.text, r.n_chars) for r in cut.collect())
    assert [g[:2] for g in got] == left and all(n == len(t) for _, t, n in got)
    mixed = stages["source_mix"](spark, cut, SF)
    con = duck(SF)
    con.execute("DROP VIEW documents")
    con.register("documents", cut.toPandas())
    copies = Counter({(i,): int(taken / size + 0.5) for i, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({OP6})").fetchall() if taken * 2 >= size > 0})
    assert Counter((r.doc_id,) for r in mixed.select("doc_id").collect()) == copies
    ran = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id,) for r in ran.select("doc_id").collect()) == copies


ODD = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_with_odd_rows(spark, tmp_path):
    base = corpus_pipeline.table(spark, SF, "documents")
    labels = corpus_pipeline.table(spark, SF, "labels")
    one = base.orderBy("doc_id").first()
    odd = spark.createDataFrame([(None, None, None, None, None), (None, one.text, "en", None, 1), (9_001, "", "en", "s", 0),
                                 *[(one.doc_id, one.text, one.lang, one.source, one.n_chars)] * 3], ODD)
    for name, docs in (("odd", base.select(*[c.split()[0] for c in ODD.split(", ")]).unionByName(odd)), ("none", base.limit(0))):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            out = corpus_pipeline.run(spark, folder)
        assert (out.count() > 0) == (name == "odd")
