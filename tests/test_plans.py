"""Physical-plan properties that matter at scale."""

import datetime as dt
import re

import pytest

import __spark_entry__ as entry
from metricfold.plans import metrics as M
from metricfold.plans.facts import FACT_TABLES
from metricfold.plans.runner import increment_of, run_metrics
from metricfold.plans.state import StateStore
from metricfold.sources.tables import Tables
from tests.conftest import SF_SMALL

QUERIES = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: formatted(fn(spark, SF_SMALL)) for name, fn in QUERIES.items()}


def test_no_cartesian_products(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def single_partition_inputs(text: str) -> list[str]:
    """For every ``Exchange SinglePartition``, the operator that feeds it."""
    tree, _, details = text.partition("\n\n")
    ids = re.findall(r"\((\d+)\) Exchange\nInput \[\d+\]: \[[^\n]*\]\nArguments: SinglePartition",
                     details)
    lines = tree.splitlines()
    feeders = []
    for node in ids:
        for i, line in enumerate(lines):
            if re.search(rf"Exchange \({node}\)$", line):
                feeders.append(re.sub(r"^[\s:|+-]*", "", lines[i + 1]))
    return feeders


def test_single_partition_only_for_partial_aggregates(plans):
    # A global aggregate ends in one partition fed by one partial row per task, which is
    # fine; raw rows must never be moved into a single task (e.g. a whole-table window).
    for name, text in plans.items():
        for feeder in single_partition_inputs(text):
            assert feeder.startswith("HashAggregate"), (name, feeder)
        assert "Window [max(" not in text and "Window [min(" not in text, name


def test_increment_filter_reaches_the_scan(plans):
    text = plans["increment_after"]
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,1999-01-01T00:00)]" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_columns_pruned_at_scan(plans):
    text = plans["count_then_name"]
    assert "ReadSchema: struct<l_suppkey:bigint>" in text


def test_top_n_and_group_limit(plans):
    assert "TakeOrderedAndProject" in plans["sql_view_top"]
    assert "TakeOrderedAndProject" in plans["limit_then_join"]
    assert "WindowGroupLimit" in plans["top_per_origin"]


def test_checked_broadcast_of_dimensions(plans):
    assert "BroadcastHashJoin" in plans["count_then_name"]
    assert "BroadcastHashJoin" in plans["route_counts"]


def test_merge_hint_forces_sort_merge(plans):
    assert "SortMergeJoin" in plans["merge_join_hint"]


def test_only_live_windows_are_read(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    run_metrics(spark, tables, [M.TOP_ORIGINS], store)
    live = store.committed_windows("top_origins")
    store.write_partial("top_origins", "none.dead", store.read_partials("top_origins"))
    files = store.read_partials("top_origins").inputFiles()
    assert live and all(f"window_start={live[0]}/" in file for file in files)


def test_partial_jobs_push_their_filters(spark):
    tables = Tables(spark, SF_SMALL)
    lines = increment_of(tables, FACT_TABLES["lineitem"], dt.date(1998, 12, 31), dt.date(1999, 12, 31))
    for spec, condition in ((M.ON_TIME_SUPPLIERS, "EqualTo(l_discount,0.0)"),
                            (M.ON_TIME_DEPARTURES, "EqualTo(l_tax,0.0)")):
        text = formatted(spec.partial(tables, lines))
        scan = next(part for part in text.split("\n\n") if condition in part)
        assert "PushedFilters" in scan and "l_shipdate" in scan.split("PushedFilters")[1]


def test_shuffle_path_when_dimensions_are_large(spark, no_broadcast):
    routes = formatted(QUERIES["route_counts"](spark, SF_SMALL))
    assert "SortMergeJoin" in routes and "BroadcastHashJoin" not in routes
