"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import pytest

import __spark_entry__ as entry
from metricfold.plans.queries import QUERIES as METRIC_QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle_compare import compare, duck

# The metric engine's queries.  Those of the corpus operators have their own tests.
QUERIES = {name: fn for name, fn in entry.queries().items() if name in METRIC_QUERIES}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in METRIC_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_ORACLE)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["origin", "origin_name", "departures"]
    assert 0 < df.count() <= 10


def test_shuffle_join_paths_match_oracle(spark, no_broadcast):
    """The same answers when no dimension may be broadcast (the large-table plans)."""
    con = duck(SF_SMALL)
    for name in ["route_counts", "metric_top_origins", "metric_mean_lead_by_weekday",
                 "count_then_name", "metric_on_time_departures"]:
        problems, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
        assert not problems, (name, problems)


# Spark type -> DuckDB type name, for the types the registered queries produce.
DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def test_column_types_match_the_oracle(spark):
    con = duck(SF_SMALL)
    for name, fn in QUERIES.items():
        spark_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in fn(spark, SF_SMALL).schema.fields}
        duck_types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
        assert spark_types == duck_types, name
