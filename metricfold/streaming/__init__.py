"""Streaming trigger: fold micro-batches of new fact rows into the metrics."""

from metricfold.streaming.keyed_reasons import apply_changes, keyed_sums, reason_changes, start_reason_stream
from metricfold.streaming.micro_batch import apply_batch, batch_window, start_metric_stream

__all__ = ["apply_batch", "apply_changes", "batch_window", "keyed_sums", "reason_changes", "start_metric_stream",
           "start_reason_stream"]
