"""Micro-batches folded into the metrics equal one full computation."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from metricfold.plans import metrics as M
from metricfold.plans.runner import full_recompute, results, run_metrics
from metricfold.plans.state import StateStore
from metricfold.sources.tables import Tables
from metricfold.streaming import apply_batch, start_metric_stream
from tests.conftest import SF_SMALL


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_file_stream_two_arrivals(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    events = tables["events"]
    inbox = os.path.join(workdir, "inbox")
    cut = "2024-01-15"
    events.filter(f"ts < '{cut}'").write.parquet(os.path.join(inbox, "part=1"))
    specs = [M.FIRST_REASON_COUNTS, M.SHARE_BY_REASON]
    store = StateStore(spark, os.path.join(workdir, "store"))
    checkpoint = os.path.join(workdir, "checkpoint")

    def run_stream():
        stream = spark.readStream.schema(events.schema).parquet(inbox + "/*")
        q = start_metric_stream(spark, stream, "events", tables, specs, store, checkpoint)
        q.awaitTermination(300)
        assert q.exception() is None

    run_stream()
    first = store.latest_version()
    events.filter(f"ts >= '{cut}'").write.parquet(os.path.join(inbox, "part=2"))
    run_stream()
    assert store.latest_version() > first
    merged = results(tables, specs, store)
    for spec in specs:
        assert _sorted(merged[spec.name].top) == _sorted(full_recompute(tables, spec)), spec.name
    state = store.latest()[M.FIRST_REASON_COUNTS.name]
    assert state.dateFrom == dt.date(2024, 1, 1)


def test_replayed_batch_is_not_counted_twice(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    batch = tables["events"]
    apply_batch(batch, 0, "events", tables, [M.FIRST_REASON_COUNTS], store)
    apply_batch(batch, 0, "events", tables, [M.FIRST_REASON_COUNTS], store)   # replay
    merged = results(tables, [M.FIRST_REASON_COUNTS], store)[M.FIRST_REASON_COUNTS.name].top
    assert _sorted(merged) == _sorted(full_recompute(tables, M.FIRST_REASON_COUNTS))


def counts(spark, tables, store):
    return _sorted(results(tables, [M.FIRST_REASON_COUNTS], store)[M.FIRST_REASON_COUNTS.name].top)


def halves(tables):
    events = tables["events"]
    return events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")


def test_user_days_split_over_batches(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    for number, part in enumerate(halves(tables)):
        apply_batch(part, number, "events", tables, [M.FIRST_REASON_COUNTS], store)
    assert counts(spark, tables, store) == _sorted(full_recompute(tables, M.FIRST_REASON_COUNTS))


def test_replay_after_compaction(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    parts = halves(tables)
    for number, part in enumerate(parts):
        apply_batch(part, number, "events", tables, [M.FIRST_REASON_COUNTS], store, compact_after=2)
    assert [w.split("-")[0] for w in store.committed_windows("first_reason_counts")] == ["compact"]
    apply_batch(parts[1], 1, "events", tables, [M.FIRST_REASON_COUNTS], StateStore(spark, workdir))
    want = _sorted(full_recompute(tables, M.FIRST_REASON_COUNTS))
    assert counts(spark, tables, StateStore(spark, workdir)) == want


def test_new_checkpoint_adds_to_what_is_stored(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    for number, part in enumerate(halves(tables)):
        apply_batch(part, 0, "events", tables, [M.FIRST_REASON_COUNTS], store, query_id=f"query{number}")
    assert counts(spark, tables, store) == _sorted(full_recompute(tables, M.FIRST_REASON_COUNTS))


def test_undated_and_empty_batches(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    events = tables["events"]
    undated = events.withColumn("ts", F.lit(None).cast(events.schema["ts"].dataType))
    apply_batch(events.limit(0), 0, "events", tables, [M.SHARE_BY_REASON], store)
    assert store.latest_version() is None
    apply_batch(undated, 1, "events", tables, [M.SHARE_BY_REASON], store)
    want = _sorted(full_recompute(tables, M.SHARE_BY_REASON))
    assert _sorted(results(tables, [M.SHARE_BY_REASON], store)["share_by_reason"].top) == want
    assert store.latest()["share_by_reason"].dateTo is None


def test_one_mode_per_store(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    apply_batch(tables["events"], 0, "events", tables, [M.FIRST_REASON_COUNTS], StateStore(spark, workdir))
    with pytest.raises(ValueError, match="fed by a stream"):
        run_metrics(spark, tables, [M.FIRST_REASON_COUNTS], StateStore(spark, workdir))
    batch_store = workdir + "-batch"
    run_metrics(spark, tables, [M.FIRST_REASON_COUNTS], StateStore(spark, batch_store))
    with pytest.raises(ValueError, match="fed by batch runs"):
        apply_batch(tables["events"], 0, "events", tables, [M.FIRST_REASON_COUNTS],
                    StateStore(spark, batch_store))
