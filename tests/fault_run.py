"""Run the incremental metrics while the first attempt of some tasks fails.

Started by ``tests/test_faults.py`` in its own process, because task retries need
a ``local[N, maxFailures]`` master.  Prints ``OK`` when the merged results equal a
full recomputation and the state bounds are right.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str) -> None:
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    spark = (SparkSession.builder.master("local[4,3]").appName("metricfold-faults")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="metricfold-fault-ckpt-"))

    # Test-only fault injection: the first attempt of partition 0 of every stage
    # that evaluates this column fails after the task has started.
    @F.udf(T.BooleanType())
    def survive(_):
        ctx = TaskContext.get()
        if ctx is not None and ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return True

    from metricfold.plans import metrics as M
    from metricfold.plans.runner import full_recompute, results, run_metrics
    from metricfold.plans.state import StateStore
    from metricfold.session import scratch_dir
    from metricfold.sources.tables import Tables

    clean = Tables(spark, sf_dir)
    faulty = clean.replace("lineitem", clean["lineitem"].filter(survive(F.col("l_orderkey"))))
    faulty = faulty.replace("events", clean["events"].filter(survive(F.col("event_id"))))
    specs = list(M.ALL_METRICS)
    store = StateStore(spark, scratch_dir(spark, "faults"))
    run_metrics(spark, faulty, specs, store, cut={"lineitem": dt.date(1998, 12, 31),
                                                   "events": dt.date(2024, 1, 15)})
    run_metrics(spark, faulty, specs, store)
    merged = results(clean, specs, store)
    for spec in specs:
        got = sorted(tuple(r) for r in merged[spec.name].top.collect())
        want = sorted(tuple(r) for r in full_recompute(clean, spec).collect())
        assert got == want, spec.name
    state = store.latest()["top_origins"]
    bounds = clean["lineitem"].agg(F.min(F.to_date("l_shipdate")), F.max(F.to_date("l_shipdate"))).first()
    assert (state.dateFrom, state.dateTo) == (bounds[0], bounds[1]), (state, bounds)
    spark.stop()
    print("OK")


if __name__ == "__main__":
    main(sys.argv[1])
