"""M5 as keyed streaming state: the stored differences add up to one full computation."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from metricfold.plans import metrics as M
from metricfold.plans.runner import full_recompute, results, run_metrics
from metricfold.plans.state import StateStore
from metricfold.sources.tables import Tables
from metricfold.streaming import apply_changes, keyed_sums, reason_changes, start_reason_stream
from tests.conftest import SF_SMALL

EVENTS = "event_id long, user_id long, ts timestamp_ntz, event_type string, value double"
NAME = M.FIRST_REASON_COUNTS.name


class Feed:
    """A folder of arrivals, a store and a checkpoint; every arrival is one run of the stream."""

    def __init__(self, spark, root, schema):
        self.spark, self.schema, self.inbox = spark, schema, os.path.join(root, "inbox")
        self.root, self.tables, self.arrivals = root, Tables(spark, SF_SMALL), 0
        self.store = StateStore(spark, os.path.join(root, "store"))

    def arrive(self, rows, checkpoint="checkpoint"):
        rows.write.parquet(os.path.join(self.inbox, f"part={self.arrivals}"))
        self.arrivals += 1
        self.run(checkpoint)

    def run(self, checkpoint="checkpoint"):
        stream = self.spark.readStream.schema(self.schema).parquet(self.inbox + "/*")
        query = start_reason_stream(self.spark, stream, self.tables, self.store, os.path.join(self.root, checkpoint))
        query.awaitTermination(300)
        assert query.exception() is None

    def full(self):
        rows = results(self.tables, [M.FIRST_REASON_COUNTS], self.store)[NAME].full.collect()
        return sorted(tuple(r) for r in rows)


def made(spark, *rows):
    day = dt.datetime(2024, 1, 1, 12)
    return spark.createDataFrame([(i, user, None if ts is None else day + dt.timedelta(days=ts), kind, value)
                                  for i, (user, ts, kind, value) in enumerate(rows)], EVENTS)


def test_arrivals_that_split_user_days(spark, workdir):
    events = Tables(spark, SF_SMALL)["events"]
    feed = Feed(spark, workdir, events.schema)
    for part in range(3):
        feed.arrive(events.filter(F.col("event_id") % 3 == part))
        seen = {**{name: feed.tables[name] for name in ("nation",)}, "events": events.filter(F.col("event_id") % 3 <= part)}
        want = full_recompute(seen, M.FIRST_REASON_COUNTS, top=100).collect()
        assert feed.full() == sorted(tuple(r) for r in want)
    state = feed.store.latest()[NAME]
    assert state.mode == "keyed" and state.dateFrom == dt.date(2024, 1, 1)
    # What is read does not grow with the user-days: a row per reason and window.
    for window in feed.store.committed_windows(NAME):
        assert feed.store.read_partials(NAME, [window]).count() <= 5


def test_reason_moves_with_late_rows(spark, workdir):
    feed = Feed(spark, workdir, made(spark).schema)
    feed.arrive(made(spark, (1, 0, "view", 1.0), (1, 1, "view", 1.0), (2, 0, "signup", 0.0), (3, 0, "view", -2.0)))
    assert feed.full() == [("view", 2)]
    feed.arrive(made(spark, (1, 0, "click", 1.0), (3, 0, "view", 3.0)))       # view -> click, nothing -> view
    assert feed.full() == [("click", 1), ("view", 2)]
    feed.arrive(made(spark, (1, 0, "click", -1.0), (1, 0, "view", -1.0), (1, 1, "view", -5.0), (3, 0, "error", 1.0)))
    assert feed.full() == [("error", 1)]                                       # reasons that all left are not listed


def test_nulls_are_keys_and_a_hot_user_day_is_one(spark, workdir):
    feed = Feed(spark, workdir, made(spark).schema)
    feed.arrive(made(spark, (None, 0, "view", 1.0), (None, None, "view", 1.0), (4, None, "error", 2.0), (5, 0, None, 1.0),
                     (6, 0, "click", None), (7, 0, "view", 0.01)))
    feed.arrive(made(spark, (None, 0, "view", 1.0), (None, None, "click", 1.0)).unionByName(
        spark.range(30000).select("id", F.lit(7).cast("long").alias("user_id"),
                                  F.lit("2024-01-01 08:00:00").cast("timestamp_ntz").alias("ts"),
                                  F.lit("purchase").alias("event_type"), F.lit(0.5).alias("value"))
        .withColumnRenamed("id", "event_id")))
    assert feed.full() == [("click", 1), ("error", 1), ("purchase", 1), ("view", 1)]
    feed.run()                                                                 # nothing new: nothing changes
    assert feed.full() == [("click", 1), ("error", 1), ("purchase", 1), ("view", 1)]


def test_user_days_are_summed_without_python(spark, workdir):
    """No call of Python for a user-day: the sums and the reasons before and after are Spark's expressions."""
    rows = made(spark, (1, 0, "view", 1.0), (1, 0, "click", 2.0), (2, 0, "signup", 0.0), (None, None, "error", 1.0), (1, 1, "view", -1.0))
    rows.write.parquet(workdir)
    stream = keyed_sums(spark.readStream.schema(rows.schema).parquet(workdir))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert stream.isStreaming and "Aggregate" in plan and not any(word in plan for word in ("Pandas", "Python", "InArrow", "WithState"))
    day = dt.date(2024, 1, 1)
    first = reason_changes(keyed_sums(rows))            # a batch without earlier ones
    assert {tuple(r) for r in first.collect()} == {
        (day, 2, None, "click"), (day, 1, None, None), (None, 1, None, "error"), (day + dt.timedelta(days=1), 1, None, None)}
    later = made(spark, (1, 0, "click", -2.0), (None, None, "click", 1.0))
    kept = keyed_sums(rows.unionByName(later)).where("kept AND user_id IS DISTINCT FROM 2 AND (user_id IS NULL OR day = '2024-01-01')")
    second = reason_changes(kept.unionByName(keyed_sums(later).where("NOT kept")))
    assert {tuple(r) for r in second.collect()} == {(day, 1, "click", "view"), (None, 1, "error", "click")}


def test_replayed_batch_is_skipped(spark, workdir):
    tables, store = Tables(spark, SF_SMALL), StateStore(spark, workdir)
    changes = spark.createDataFrame([(dt.date(2024, 1, 1), 3, None, "view"), (dt.date(2024, 1, 2), 1, "view", "click")],
                                    "day date, rows long, was string, now string")
    for _ in range(2):
        apply_changes(changes, 0, tables, store, "query")
    assert store.read_partials(NAME).select("reason", "days").collect() == [("click", 1)]
    assert len(store.committed_windows(NAME)) == 1
    with pytest.raises(ValueError, match="checkpoint of streaming query"):
        apply_changes(changes, 1, tables, store, "another query")
    with pytest.raises(ValueError, match="keyed state"):
        run_metrics(spark, tables, [M.FIRST_REASON_COUNTS], store)


def test_run_cut_off_before_its_commit_is_noted(spark, workdir, monkeypatch):
    """The store committed a batch, the query stopped before noting it: the replay changes nothing."""
    from metricfold.streaming import keyed_reasons

    feed = Feed(spark, workdir, made(spark).schema)
    feed.arrive(made(spark, (1, 0, "view", 1.0)))
    apply = keyed_reasons.apply_changes

    def then_stop(*args, **kwargs):
        apply(*args, **kwargs)
        raise RuntimeError("stopped here")

    monkeypatch.setattr(keyed_reasons, "apply_changes", then_stop)
    with pytest.raises(Exception, match="stopped here"):
        feed.arrive(made(spark, (1, 0, "click", 1.0), (2, 0, "view", 1.0)))
    monkeypatch.setattr(keyed_reasons, "apply_changes", apply)
    feed.run()
    assert feed.full() == [("click", 1), ("view", 1)]
    feed.arrive(made(spark, (2, 0, "click", 1.0)))
    assert feed.full() == [("click", 2)]
