"""Shared reductions, spread joins and ranks: the same results, and the plans they are there for."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from metricfold.operators.joins import attach
from metricfold.operators.ranking import rank_spread, rank_within
from metricfold.operators.reductions import Reduction, reduced, reduced_together, unpacked
from metricfold.operators.skew import attach_spread, hot_keys
from metricfold.plans import flights, metrics as M
from metricfold.plans.runner import full_recompute, results, run_metrics
from metricfold.plans.state import StateStore
from metricfold.sinks.files import save
from metricfold.sources.tables import Tables
from metricfold.streaming import apply_batch
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.test_plans import formatted
from tests.test_skew import HOT, skewed_lines


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- one scan for several metrics -----------------------------------------------------------

def test_reductions_together_equal_each_alone(spark):
    rows = spark.createDataFrame(
        [(1, "a", 5), (1, "a", None), (1, "b", 0), (None, "b", 7), (2, None, 9)], "k int, c string, v int")
    rs = {
        "by_k": Reduction(keys=lambda: {"k": F.col("k")}, sums=lambda: {"n": F.lit(1)}),
        "by_c": Reduction(keys=lambda: {"c": F.col("c"), "k2": F.col("k")}, sums=lambda: {"n": F.lit(1), "v": F.col("v")},
                          where=lambda: F.col("v") > 0),
        "all": Reduction(keys=dict, sums=lambda: {"v": F.col("v")}),
    }
    for df in (rows, rows.limit(0)):
        together = reduced_together(df, rs)
        for name, r in rs.items():
            assert bag(unpacked(together, rs, name)) == bag(reduced(df, r)), name
            assert unpacked(together, rs, name).schema.simpleString() == reduced(df, r).schema.simpleString()


@pytest.mark.parametrize("source", ["lineitem", "events"])
def test_one_scan_serves_all_metrics_of_a_fact_table(spark, source):
    tables = Tables(spark, SF_SMALL)
    rs = {s.name: s.reduction for s in M.ALL_METRICS if s.source == source}
    assert len(rs) == {"lineitem": 4, "events": 2}[source]
    text = formatted(reduced_together(tables[source], rs))
    tree = text.partition("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 1 and tree.count("HashAggregate") == 2


def test_flight_metrics_share_a_scan():
    assert all(spec.reduction is not None for spec in flights.FLIGHT_METRICS)


def test_facts_are_read_once_a_run(spark, workdir, monkeypatch):
    """The partials are finished from the written reductions, not from the facts, and these are deleted."""
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    finished = []
    original = M.MetricSpec.finished
    monkeypatch.setattr(M.MetricSpec, "finished", lambda self, t, rows: finished.append((self.name, rows.inputFiles())) or original(self, t, rows))
    run_metrics(spark, tables, list(M.ALL_METRICS), store)
    assert {name for name, _ in finished} == set(M.BY_NAME)
    assert all("/staging/" in f for _, files in finished for f in files)
    assert not any(store.exists(f.split("/reduced-")[0]) for _, files in finished for f in files)
    merged = results(tables, list(M.ALL_METRICS), store)
    for spec in M.ALL_METRICS:
        assert bag(merged[spec.name].top) == bag(full_recompute(tables, spec)), spec.name


def test_lead_plan_moves_lines_once(spark, no_broadcast):
    tables = Tables(spark, SF_SMALL)
    tree = formatted(M.MEAN_LEAD_BY_WEEKDAY.partial(tables, tables["lineitem"])).partition("\n\n")[0]
    assert tree.count("Exchange") == 3      # lines by order, orders, the totals


def test_lead_of_odd_rows(spark):
    """Lines without a day, orders without a day, lines without an order, a hot order."""
    lines = spark.sql("""SELECT * FROM VALUES (1L, TIMESTAMP_NTZ'2024-01-01'), (1L, TIMESTAMP_NTZ'2024-01-01'), (1L, NULL), (2L, TIMESTAMP_NTZ'2024-01-02'),
                      (9L, TIMESTAMP_NTZ'2024-01-03'), (NULL, TIMESTAMP_NTZ'2024-01-03') AS t(l_orderkey, l_shipdate)""")
    orders = spark.sql("SELECT * FROM VALUES (1L, DATE'2023-12-30'), (2L, CAST(NULL AS DATE)) AS t(o_orderkey, o_orderdate)")
    got = bag(M.MEAN_LEAD_BY_WEEKDAY.partial({"orders": orders}, lines))
    assert got == sorted([(1, 4, 2), (2, None, 0), (None, None, 0)], key=str)


# ---- hot keys ---------------------------------------------------------------------------------

def test_hot_supplier_is_spread_at_default_thresholds(spark, no_broadcast):
    t = Tables(spark, SF_ORACLE)
    lines = skewed_lines(t).select("l_orderkey", "l_linenumber", "l_suppkey")
    hot = hot_keys(lines, ["l_suppkey"])["l_suppkey"]
    assert set(hot) == {HOT} and hot[HOT] > 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def by_task(join):
            joined = join.select("l_orderkey", "origin", F.spark_partition_id().alias("task"))
            return sorted(r["n"] for r in joined.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect())

        spread = by_task(attach_spread(lines, t["supplier"], "l_suppkey", "s_suppkey", {"s_nationkey": "origin"}, hot))
        plain = by_task(attach(lines, t["supplier"], "l_suppkey", "s_suppkey", {"s_nationkey": "origin"}))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(spread) == sum(plain) == lines.count()
    assert spread[-1] <= 3 * statistics.median(spread) < plain[-1]


def test_routes_are_whole_with_hot_keys(spark, no_broadcast):
    t = Tables(spark, SF_ORACLE)
    lines = skewed_lines(t).withColumn("l_partkey", F.when(F.col("l_linenumber") == 1, F.lit(3).cast("bigint")).otherwise(F.col("l_partkey")))
    joined = (lines.filter("l_tax = 0").join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
              .join(t["part"], F.col("l_partkey") == F.col("p_partkey")))
    want = joined.groupBy("s_nationkey", "p_brand", "c_nationkey").agg(F.count(F.lit(1)).alias("flights"))
    assert bag(M.routes_partial(t, lines)) == bag(want)


# ---- ranks of a large group ---------------------------------------------------------------------

@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_rank_spread_equals_the_window(spark, direction):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(40)]), i % 700) for i in range(3_000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_spread(df, ["g"], "v", save, "r", direction)
        assert bag(got) == bag(rank_within(df, ["g"], "v", "r", direction))
        groups = got.inputFiles()
        assert len(groups) > 4          # written by several tasks ...
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    text = formatted(got)
    assert "hashpartitioning(__part" in text and bag(rank_spread(df.limit(0), ["g"], "v", save)) == []


# ---- one list for both rankings -------------------------------------------------------------------

def test_both_rankings_need_no_outer_join(spark):
    tables = Tables(spark, SF_SMALL)
    routes = save(M.routes_partial(tables, tables["lineitem"]), "routes")
    text = formatted(M.departures_finalize(tables, routes, 3, "asc"))
    tree = text.partition("\n\n")[0]
    assert "FullOuter" not in text and tree.count(" Exchange") <= 4
    small = spark.createDataFrame([(1, "c1", 7, 5), (1, "c1", 8, 5), (1, "c2", 7, 9), (2, None, None, 3)],
                                  "origin int, carrier string, destination int, flights long")
    got = bag(M.rank_and_pair(small, None))
    assert got == sorted([(1, 1, "c1", 10, 1, 7, 14, 1), (1, 2, "c2", 9, 2, 8, 5, 2), (2, 1, None, 3, 1, None, 3, 1)], key=str)
    last = bag(M.rank_and_pair(small, 1, "desc"))
    assert last == sorted([(1, 1, "c2", 9, 2, 8, 5, 2), (2, 1, None, 3, 1, None, 3, 1)], key=str)


# ---- one mode per store ---------------------------------------------------------------------------

@pytest.mark.parametrize("spec", M.ALL_METRICS, ids=lambda s: s.name)
def test_a_store_refuses_the_other_mode(spark, workdir, spec):
    tables = Tables(spark, SF_SMALL)
    apply_batch(tables[spec.source], 0, spec.source, tables, [spec], StateStore(spark, workdir))
    with pytest.raises(ValueError, match="fed by a stream"):
        run_metrics(spark, tables, [spec], StateStore(spark, workdir))
    other = workdir + "-batch"
    run_metrics(spark, tables, [spec], StateStore(spark, other))
    with pytest.raises(ValueError, match="fed by batch runs"):
        apply_batch(tables[spec.source], 1, spec.source, tables, [spec], StateStore(spark, other))
