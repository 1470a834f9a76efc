"""Unit tests of the operators on hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricfold.functions.columns import day_from_parts, first_positive, iso_weekday, percent_of
from metricfold.operators import (
    MissingColumnsError,
    after,
    as_of,
    attach,
    bounds,
    column_totals,
    count_by,
    count_non_null,
    drop_incomplete,
    mean_from_parts,
    mean_parts,
    merge_sums,
    only_zero,
    rank_within,
    require_columns,
    roll_up,
    side_by_side,
    share_of_total,
    top_n,
    top_per_group,
)
from metricfold.operators.ranking import check_direction
from metricfold.plans.facts import FACT_TABLES


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_missing_columns_message(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert require_columns(df, ["a"]) is df
    with pytest.raises(MissingColumnsError) as err:
        require_columns(df, ["a", "c", "d"])
    assert str(err.value) == "The [c, d] columns are not in the DF with columns: [a, b]"


def test_first_positive_priority_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 5, 7), (0, 3, None), (None, 0, 2), (0, 0, 0), (None, None, None), (-1, None, 4)],
        "a int, b int, c int",
    )
    out = df.select(first_positive({"A": "a", "B": "b", "C": "c"}).alias("r"))
    assert [r.r for r in out.collect()] == ["A", "B", "C", None, None, "C"]


def test_only_zero_drops_nulls(spark):
    df = spark.createDataFrame([(0,), (None,), (3,), (0,)], "d int")
    assert only_zero(df, "d").count() == 2


def test_count_non_null_drops_null_category(spark):
    df = spark.createDataFrame([("x",), (None,), ("x",), ("y",)], "k string")
    assert rows(count_non_null(df, "k"), "k", "n") == [("x", 2), ("y", 1)]


def test_mean_parts_merge_like_one_mean(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (1, 7), (2, 4)], "k int, v int")
    a = mean_parts(df.filter("v < 5 or v is null"), ["k"], "v", "s", "c")
    b = mean_parts(df.filter("v >= 5"), ["k"], "v", "s", "c")
    merged = mean_from_parts(merge_sums([a, b], ["k"], ["s", "c"]), "s", "c", "m")
    assert rows(merged, "k", "m") == [(1, 4.5), (2, 4.0)]


def test_share_of_total_and_zero_total(spark):
    totals = spark.createDataFrame([(1, 3), (0, 4)], "x bigint, y bigint")
    out = dict(rows(share_of_total(totals, {"X": "x", "Y": "y"}), "reason", "percent"))
    assert out == {"X": 12.5, "Y": 87.5}
    zero = spark.createDataFrame([(0, 0)], "x bigint, y bigint")
    assert rows(share_of_total(zero, {"X": "x", "Y": "y"}), "reason", "percent") == [
        ("X", None), ("Y", None)]


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0)], "a bigint, b bigint")
    assert df.select(percent_of("a", "b").alias("p")).first().p is None


def test_column_totals_one_row(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    assert column_totals(df, ["a", "b"]).collect()[0].asDict() == {"a": 3, "b": 5}


def test_top_n_deterministic_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 5), ("d", 9)], "k string, n int")
    assert [r.k for r in top_n(df, ["n"], 2, "desc", tie_break=["k"]).collect()] == ["d", "a"]
    assert [r.k for r in top_n(df, ["n"], 2, "asc", tie_break=["k"]).collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        check_direction("desc; drop table x")


def test_dense_rank_and_group_limit(spark):
    df = spark.createDataFrame(
        [("o1", "a", 5), ("o1", "b", 5), ("o1", "c", 3), ("o1", "d", 1), ("o2", "a", 2)],
        "g string, k string, n int",
    )
    ranked = rows(rank_within(df, ["g"], "n", "r"), "g", "k", "r")
    assert ranked == [("o1", "a", 1), ("o1", "b", 1), ("o1", "c", 2), ("o1", "d", 3), ("o2", "a", 1)]
    top = top_per_group(df, ["g"], "n", 2, "r")
    assert rows(top, "g", "k") == [("o1", "a"), ("o1", "b"), ("o1", "c"), ("o2", "a")]


def test_side_by_side_is_linear(spark):
    long = spark.createDataFrame([(1, 1, 0, "a"), (1, 2, 0, "b"), (1, 1, 1, "x"), (2, 1, 1, "y")], "g int, p int, kind int, m string")
    out = rows(side_by_side(long, ["g", "p"], [(F.col("kind") == 0, "m", "x"), (F.col("kind") == 1, "m", "y")]), "g", "p", "x", "y")
    assert sorted(out, key=str) == sorted([(1, 1, "a", "x"), (1, 2, "b", None), (2, 1, None, "y")], key=str)


def test_after_and_as_of_on_each_day_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2020-01-01 23:59:59', DATE'2020-01-01', 2020, 1, 1),"
        " (TIMESTAMP_NTZ'2020-01-02 00:00:00', DATE'2020-01-02', 2020, 1, 2),"
        " (TIMESTAMP_NTZ'2021-01-01 00:00:00', DATE'2021-01-01', 2021, 1, 1) AS t(ts, d, YEAR, MONTH, DAY)"
    )
    wm = dt.date(2020, 1, 1)
    assert after(df, "ts", wm).count() == 2
    assert after(df, "d", wm).count() == 2
    assert after(df, "ts", None).count() == 3
    assert as_of(df, "ts", wm).count() == 1
    parts = FACT_TABLES["flights"]
    assert parts.after(df, wm).count() == 2
    assert parts.after(df, dt.date(2020, 12, 31)).count() == 1
    assert parts.as_of(df, wm).count() == 1
    assert bounds(df, "ts") == (dt.date(2020, 1, 1), dt.date(2021, 1, 1))
    assert bounds(df.limit(0), "ts") == (None, None)


def test_day_from_parts_and_weekday(spark):
    df = spark.createDataFrame([(2015, 1, 1), (2015, 13, 1)], "y int, m int, d int")
    lenient = [r.day for r in df.select(day_from_parts("y", "m", "d", lenient=True).alias("day")).collect()]
    assert lenient == [dt.date(2015, 1, 1), None]
    wd = df.limit(1).select(iso_weekday(day_from_parts("y", "m", "d")).alias("w")).first().w
    assert wd == 4          # 2015-01-01 was a Thursday


def test_attach_drops_unknown_keys(spark):
    facts = spark.createDataFrame([("A", 3), ("Z", 1)], "code string, n bigint")
    dim = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "IATA_CODE string, NAME string")
    out = attach(facts, dim, "code", "IATA_CODE", {"NAME": "name"})
    assert rows(out, "code", "name", "n") == [("A", "Alpha", 3)]


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a int, b int")
    assert drop_incomplete(df).count() == 1
    assert drop_incomplete(df, ["a"]).count() == 2


@pytest.mark.parametrize("pre_aggregate", [True, False])
def test_roll_up_same_result_both_paths(spark, pre_aggregate):
    facts = spark.createDataFrame([(1, 10, 1), (1, 11, 1), (2, 10, 1), (3, 12, 1)],
                                  "sk bigint, pk bigint, w int")
    dim = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "s_key bigint, nation int")
    out = roll_up(facts, "sk", dim, "s_key", {"nation": "origin"}, sums=["w"],
                  pre_aggregate=pre_aggregate)
    agg = out.groupBy("origin").agg(F.sum("w").alias("w"))
    assert rows(agg, "origin", "w") == [(7, 3), (8, 1)]
