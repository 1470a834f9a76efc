"""Structured Streaming trigger for the incremental metrics.

New fact rows arrive as a stream (for example Parquet or CSV files landing in a
directory).  Each micro-batch is one increment, committed with a new state version exactly as
a batch run's.  The state notes the last batch of each streaming query, in the same commit as
its rows, so a batch that Structured Streaming replays is known and skipped, also after a
compaction.  A stream with a new checkpoint is a new query: its batches add to what is stored.
Unlike the day-watermark batch runs, no row is dropped for arriving late or for having no day:
every row of a micro-batch is counted once.

A micro-batch may hold any part of a day, so a metric whose batch partial adds up only over
whole days is stored in its ``streamed`` form.

Use one mode per store: either day-watermark batch runs or this stream.  The state notes the mode of each
metric and the other one is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from metricfold.operators.validate import require_tables
from metricfold.plans.facts import FACT_TABLES, FactTable, span
from metricfold.plans.metrics import MetricSpec
from metricfold.plans.runner import (
    COMPACT_AFTER_WINDOWS,
    STREAM,
    commit_increments,
    compact,
    current_states,
    require_mode,
)
from metricfold.plans.state import StateStore


def batch_window(query_id: str, batch_id: int, attempt: str) -> str:
    return f"batch-{query_id}-{batch_id:012d}.{attempt}"


def apply_batch(batch: DataFrame, batch_id: int, source: str, tables: Mapping[str, DataFrame],
                specs: Sequence[MetricSpec], store: StateStore,
                facts: Mapping[str, FactTable] = FACT_TABLES, query_id: str = "direct",
                compact_after: int | None = COMPACT_AFTER_WINDOWS) -> None:
    """Commit one micro-batch of ``source`` rows as an increment of every spec reading it.

    A batch that ``query_id`` already committed, and an empty one, change nothing.
    """
    bound = dict(tables)
    bound[source] = batch
    chosen = [spec.streamed or spec for spec in specs if spec.source == source]
    for spec in chosen:
        require_tables(bound, spec.required)
    require_mode(store, chosen, STREAM)
    states = current_states(store, chosen)
    due = [s for s in chosen if states[s.name].lastBatches.get(query_id, -1) < batch_id]
    if not due:
        return
    seen = span(facts[source], batch)
    if seen.rows == 0:
        return
    window = batch_window(query_id, batch_id, uuid.uuid4().hex[:8])
    commit_increments(bound, due, store, states, {s.name: batch for s in due},
                      {s.name: window for s in due}, {s.name: seen for s in due},
                      batch=(query_id, batch_id))
    if compact_after:
        compact(store, chosen, compact_after)


def start_metric_stream(spark: SparkSession, stream: DataFrame, source: str,
                        tables: Mapping[str, DataFrame], specs: Sequence[MetricSpec],
                        store: StateStore, checkpoint: str, available_now: bool = True,
                        processing_time: str | None = None) -> StreamingQuery:
    """Start a query that folds every micro-batch of ``stream`` into the metrics.

    ``checkpoint`` must be on storage every executor and the driver can reach (the
    stream's offsets and commit log live there).
    """
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply_batch(batch, batch_id, source, tables, specs, store, query_id=query_id)

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
