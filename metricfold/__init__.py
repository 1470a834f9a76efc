"""Incremental business metrics on PySpark.

A metric is a declarative :class:`~metricfold.plans.metrics.MetricSpec`: a partial
aggregate over the rows newer than the metric's stored watermark, a generic
additive merge with earlier partials, and a finalizer that derives the user
facing result (names attached, ranks, means, shares, top-N).  Everything runs
on Spark SQL built-ins; no Python UDFs are used.
"""

from metricfold.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
