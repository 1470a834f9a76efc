"""Metric specifications, the incremental runner and its versioned state.

* :mod:`metricfold.plans.metrics`: ``MetricSpec`` and the six metrics on the driver's tables
* :mod:`metricfold.plans.flights`: the six metrics on the flight data model, and the CSV job
* :mod:`metricfold.plans.runner`: ``run_metrics``, ``results``, ``run_job``, ``compact``,
  ``full_recompute``
* :mod:`metricfold.plans.state`: ``StateStore`` (state versions, partial windows)
* :mod:`metricfold.plans.facts`: how fact tables are cut into increments by day
* :mod:`metricfold.plans.queries` / :mod:`metricfold.plans.oracle`: registered queries and SQL
"""
