"""Top-N from the heads of the windows equals the top of all merged keys."""

import datetime as dt
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from metricfold.plans import metrics as M
from metricfold.plans import state as state_module
from metricfold.plans.heads import top_rows
from metricfold.plans.runner import compact, full_recompute, results, run_metrics
from metricfold.plans.state import MetricState, StateStore
from metricfold.sources.tables import Tables
from tests.conftest import SF_SMALL
from tests.test_plans import formatted

SCHEMA = "key long, n long"


def filled(spark, root, windows):
    store = StateStore(spark, root)
    names = [f"w{i}" for i in range(len(windows))]
    for name, rows in zip(names, windows):
        store.write_partial("m", name, spark.createDataFrame(rows, SCHEMA), "n")
    store.commit([MetricState("m", 10, "desc", liveWindows=tuple(names))])
    return store


def merged(windows):
    total = Counter()
    for rows in windows:
        for key, n in rows:
            total[key] += n
    return total


def held(store, n, known=lambda rows: rows):
    rows = top_rows(store, "m", ["key"], "n", n, known)
    return None if rows is None else {r["key"]: r["n"] for r in rows.groupBy("key").agg(F.sum("n").alias("n")).collect()}


def leading(total, n):
    """The keys of the n largest totals, with all ties of the last one."""
    least = sorted(total.values(), reverse=True)[n - 1]
    return {key: v for key, v in total.items() if v >= least}


@pytest.mark.parametrize("seed", range(3))
def test_windows_against_a_plain_merge(spark, workdir, monkeypatch, seed):
    monkeypatch.setattr(state_module, "HEAD_ROWS", 6)
    draw = random.Random(seed)
    windows = [[(key, draw.choice([0, 1, 2, 3, 5, 8, 40])) for key in draw.sample(range(60), 40)] for _ in range(4)]
    windows[0].append((None, 30))
    store, total = filled(spark, workdir, windows), merged(windows)
    for n in (1, 3, 6):
        found = held(store, n)
        want = leading(total, n)
        assert {k: found.get(k) for k in want} == want
        assert all(total[k] == v for k, v in found.items())        # found keys are merged whole


def test_a_leader_that_no_head_holds(spark, workdir, monkeypatch):
    """Key 7 is second in every window, each window's first is another key: heads of one row miss it."""
    monkeypatch.setattr(state_module, "HEAD_ROWS", 1)
    windows = [[(100 + i, 10), (7, 9), (200 + i, 1)] for i in range(5)]
    store = filled(spark, workdir, windows)
    found = held(store, 1)
    assert found == {7: 45, **{100 + i: 10 for i in range(5)}}


def test_no_bound(spark, workdir, monkeypatch):
    monkeypatch.setattr(state_module, "HEAD_ROWS", 2)
    store = filled(spark, workdir, [[(1, 5), (2, 4), (3, 3)], [(1, 1)]])
    assert held(store, 3) is None                                   # heads hold two keys only
    assert held(store, 2) == {1: 6, 2: 4, 3: 3}                     # 4 over two windows: keys of 2 or more in one
    assert held(store, 2, known=lambda rows: rows.filter("key = 1")) is None
    assert held(store, 0) is None
    store.write_partial("m", "old", spark.createDataFrame([(3, 9)], SCHEMA))
    store.commit([replace(store.latest()["m"], liveWindows=("w0", "w1", "old"))])
    assert held(store, 1) is None                                   # a window without a head
    zeros = filled(spark, workdir + "-zeros", [[(1, 0), (2, 0)]])
    assert held(zeros, 1) is None
    empty = filled(spark, workdir + "-empty", [[]])
    assert held(empty, 1) is None


def test_metrics_read_heads_first(spark, workdir):
    tables, specs = Tables(spark, SF_SMALL), [M.TOP_ORIGINS, M.ON_TIME_SUPPLIERS]
    store = StateStore(spark, workdir)
    run_metrics(spark, tables, specs, store, cut={"lineitem": dt.date(1996, 12, 31)})
    run_metrics(spark, tables, specs, store)
    for folded in (False, True):
        if folded:
            compact(store, specs, 2)
        res = results(tables, specs, store)
        for spec in specs:
            assert store.read_heads(spec.name) is not None
            want = [tuple(r) for r in full_recompute(tables, spec).collect()]
            assert [tuple(r) for r in res[spec.name].top.collect()] == want
            scan = formatted(res[spec.name].top)
            assert f"GreaterThanOrEqual({spec.ranked}," in scan
            assert "left_semi" in scan.lower() or "LeftSemi" in scan
