"""M5 as a keyed stream: every user-day's amounts are kept as state, only changes of its reason are stored.

``micro_batch`` stores the amounts of each batch's user-days and classifies all of them again on
every read.  Here a user-day's five sums live in the streaming state store (one state row for each
user-day, on the executors, in the query's checkpoint): a streaming aggregate adds a micro-batch to
them.  For each user-day of the batch its sums so far and what the batch added give the reason before
and after, and what is committed is one small window of ``(reason, days)`` differences.  So a read merges at most one row per reason and window, however many
user-days there are, and late rows still move their user-day to its right reason.

All of this is in Spark's own expressions, with no call of Python for a user-day.  Rows are summed inside the tasks
before they are exchanged by user-day, so a user-day with a third of
all rows arrives as one row for each task.  Null users and days are keys like others, as in a batch run.

A batch that is replayed finds the state of the batch before it, gives the same differences, and is
skipped by the store if they were committed.  The sums live in the checkpoint, so a store
takes the batches of one streaming query: a stream with a new checkpoint, and the other
modes, are refused.  Checkpoints of the earlier form (a state function in Python) cannot be
gone on with: their state has other columns, and Spark refuses them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from metricfold.operators.validate import require_tables
from metricfold.plans.analogues import REASON_COLUMNS, reason_sums, user_day
from metricfold.plans.facts import Span
from metricfold.plans.metrics import FIRST_REASON_COUNTS
from metricfold.plans.runner import (
    COMPACT_AFTER_WINDOWS,
    KEYED,
    commit_increments,
    compact,
    current_states,
    require_mode,
)
from metricfold.plans.state import StateStore
from metricfold.streaming.micro_batch import batch_window

KEYS = ("user_id", "day")
AMOUNTS = tuple(REASON_COLUMNS.values())
SUMMED = (*AMOUNTS, "rows")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What is committed: the differences, which add up like the batch run's counts.
REASON_DIFFERENCES = replace(
    FIRST_REASON_COUNTS, reduction=None, finish=None, streamed=None,
    custom=lambda tables, summed: summed.filter("reason IS NOT NULL AND days <> 0").select("reason", "days"),
    description="changes of the user-days' reasons")


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUMMED]


def keyed_sums(events: DataFrame) -> DataFrame:
    """Stream of ``user_id, day``, amounts, ``rows, kept``: each user-day's sums so far, as kept in the state, if a micro-batch
    touches it (``kept``), and the amounts of the batch's own rows (not ``kept``)."""
    amounts = events.select(*[c.alias(name) for name, c in user_day().items()],
                            *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in reason_sums().items()],
                            F.lit(1).cast("long").alias("rows"))
    kept = amounts.groupBy(*KEYS).agg(*_sums())
    return kept.withColumn("kept", F.lit(True)).unionByName(amounts.withColumn("kept", F.lit(False)))


def _reason(sums: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(sums[amount] > 0, F.lit(reason)) for reason, amount in REASON_COLUMNS.items()])


def reason_changes(batch: DataFrame) -> DataFrame:
    """``day, rows, was, now`` of a micro-batch of ``keyed_sums``: for each user-day in it, its reason before and after."""
    def side(kept: Column) -> list[Column]:
        return [F.sum(F.when(kept, F.col(c)).otherwise(0)) for c in SUMMED]

    so_far, added = side(F.col("kept")), side(~F.col("kept"))
    both = batch.groupBy(*KEYS).agg(*[c.alias(f"{name}_so_far") for name, c in zip(SUMMED, so_far)],
                                    *[c.alias(f"{name}_added") for name, c in zip(SUMMED, added)])
    before = {c: F.col(f"{c}_so_far") - F.col(f"{c}_added") for c in AMOUNTS}
    after = {c: F.col(f"{c}_so_far") for c in AMOUNTS}
    return both.select("day", F.col("rows_added").alias("rows"), _reason(before).alias("was"), _reason(after).alias("now"))


def summed_changes(changes: DataFrame) -> DataFrame:
    """``reason, days`` differences with the bounds and row counts of the batch: at most a row per reason and one of null."""
    sides = F.array(F.struct(F.col("was").alias("reason"), F.lit(-1).cast("long").alias("days"), "rows"),
                    F.struct(F.col("now").alias("reason"), F.lit(1).cast("long").alias("days"),
                             F.lit(0).cast("long").alias("rows")))
    return changes.select("day", F.inline(sides)).groupBy("reason").agg(
        F.sum("days").alias("days"), F.sum("rows").alias("rows"),
        F.min("day").alias("first"), F.max("day").alias("last"))


def apply_changes(changes: DataFrame, batch_id: int, tables: Mapping[str, DataFrame], store: StateStore,
                  query_id: str, compact_after: int | None = COMPACT_AFTER_WINDOWS) -> None:
    """Commit the ``reason_changes`` of one micro-batch as an increment; a batch committed before changes nothing.

    ValueError where the store's user-days are held by another query or it is fed in another mode.
    """
    spec = REASON_DIFFERENCES
    require_mode(store, [spec], KEYED)
    states = current_states(store, [spec])
    batches = states[spec.name].lastBatches
    if batches and query_id not in batches:
        raise ValueError(f"the sums behind metric {spec.name!r} are in the checkpoint of streaming query {[*batches]}: "
                         "go on with that checkpoint, or begin a new store")
    with store.scratch() as folder:
        # The one pass over the batch.  A replayed one needs it too: it writes the query's state.
        summed_changes(changes).coalesce(1).write.parquet(folder)
        if batches.get(query_id, -1) >= batch_id:
            return
        summed = changes.sparkSession.read.parquet(folder)
        rows, first, last = summed.agg(F.sum("rows"), F.min("first"), F.max("last")).first()
        if not rows:
            return
        window = batch_window(query_id, batch_id, uuid.uuid4().hex[:8])
        commit_increments(tables, [spec], store, states, {spec.name: summed}, {spec.name: window},
                          {spec.name: Span(rows, first, last)}, batch=(query_id, batch_id), mode=KEYED)
    if compact_after:
        compact(store, [spec], compact_after)


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB: user-days need not fit into executor memory."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_reason_stream(spark: SparkSession, stream: DataFrame, tables: Mapping[str, DataFrame], store: StateStore,
                        checkpoint: str, available_now: bool = True,
                        processing_time: str | None = None) -> StreamingQuery:
    """Start a query that keeps M5 from a stream of events; ``checkpoint`` must be shared storage."""
    require_tables({**tables, FIRST_REASON_COUNTS.source: stream}, FIRST_REASON_COUNTS.required)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply_changes(reason_changes(batch), batch_id, tables, store, query_id)

    writer = (keyed_sums(stream).writeStream.outputMode("update").foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    with _state_on_disk(spark):
        return writer.start()
