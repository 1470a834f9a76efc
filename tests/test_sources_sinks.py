"""Sources and sinks: catalogue lookups, CSV scans and exports."""

import os

import pytest

from metricfold.schemas import CATALOG, struct
from metricfold.sinks import as_view, write_csv_dir, write_single_csv
from metricfold.sources import exactly_one, path_for, read_csv, read_csv_inferred
from metricfold.sources.catalog import CatalogLookupError


def test_path_for_exactly_one(spark):
    cat = spark.createDataFrame([("a", "/x/a"), ("b", "/x/b"), ("b", "/x/b2")], CATALOG)
    assert path_for(cat, "a") == "/x/a"
    with pytest.raises(CatalogLookupError, match="no row"):
        path_for(cat, "zzz")
    with pytest.raises(CatalogLookupError, match="more than one"):
        path_for(cat, "b")
    assert exactly_one(cat.filter("name = 'a'"), "a")["path"] == "/x/a"


def test_single_csv_keeps_header_when_empty(spark, workdir):
    df = spark.createDataFrame([], "a int, b string")
    path = write_single_csv(df, os.path.join(workdir, "empty"))
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    with open(os.path.join(path, files[0])) as fh:
        assert fh.read().strip() == "a,b"


def test_csv_round_trip_with_separator_and_quotes(spark, workdir):
    rows = [(1, 'say "hi", then go', None), (2, "plain", 2.5)]
    schema = struct("k int, text string, x double")
    df = spark.createDataFrame(rows, schema)
    back = read_csv(spark, write_csv_dir(df, os.path.join(workdir, "q")), schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
    single = read_csv(spark, write_single_csv(df, os.path.join(workdir, "s")), schema)
    assert sorted(tuple(r) for r in single.collect()) == sorted(rows)


def test_semicolon_separator_and_clock_strings(spark, workdir):
    path = os.path.join(workdir, "semi.csv")
    os.makedirs(workdir, exist_ok=True)
    with open(path, "w") as fh:
        fh.write("code;clock;n\nA;0005;3\nB;1230;4\n")
    typed = read_csv(spark, path, struct("code string, clock string, n int"), sep=";")
    assert [r.clock for r in typed.orderBy("code").collect()] == ["0005", "1230"]
    inferred = read_csv_inferred(spark, path, sep=";")
    assert dict(inferred.dtypes)["clock"] == "int"        # why typed scans are the default


def test_view_registration(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    name = as_view(df, "metricfold_test_view")
    assert spark.sql(f"SELECT sum(a) AS s FROM {name}").first().s == 3
