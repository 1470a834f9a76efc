"""Merge law: run(<= cut) then run(> cut) equals one full computation; reruns change nothing."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from metricfold.plans import metrics as M
from metricfold.plans.runner import full_recompute, results, run_metrics
from metricfold.plans.state import StateStore
from metricfold.session import scratch_dir
from metricfold.sources.tables import Tables
from tests.conftest import SF_SMALL


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(ship_cut=st.dates(dt.date(1994, 12, 1), dt.date(2002, 1, 1)),
       event_cut=st.dates(dt.date(2023, 12, 30), dt.date(2024, 2, 2)))
def test_two_increments_equal_one_pass(spark, ship_cut, event_cut):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, scratch_dir(spark, "merge-law"))
    specs = list(M.ALL_METRICS)
    run_metrics(spark, tables, specs, store, cut={"lineitem": ship_cut, "events": event_cut})
    run_metrics(spark, tables, specs, store)
    version = store.latest_version()
    merged = results(tables, specs, store)
    for spec in specs:
        assert _sorted(merged[spec.name].top) == _sorted(full_recompute(tables, spec)), spec.name
    run_metrics(spark, tables, specs, store)
    assert store.latest_version() == version
