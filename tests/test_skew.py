"""A hot key holding a large share of the rows: results stay whole, and the plan splits it."""

import pytest
from pyspark.sql import functions as F

from metricfold.operators.joins import roll_up
from metricfold.plans import metrics as M
from metricfold.sources.tables import Tables
from tests.conftest import SF_ORACLE

HOT = 7


def skewed_lines(t):
    # The first two lines of every order go to one supplier: about 30% of all lines.
    lines = t["lineitem"]
    return lines.withColumn("l_suppkey", F.when(F.col("l_linenumber") <= 2, F.lit(HOT).cast("bigint"))
                            .otherwise(F.col("l_suppkey")))


def brute_force_origins(t, lines):
    s = t["supplier"]
    return sorted(tuple(r) for r in lines.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
                  .groupBy(F.col("s_nationkey").alias("origin")).count().collect())


@pytest.mark.parametrize("broadcast", [True, False])
def test_hot_supplier_counts_are_whole(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    t = Tables(spark, SF_ORACLE)
    lines = skewed_lines(t)
    hot_share = lines.filter(F.col("l_suppkey") == HOT).count() / lines.count()
    assert hot_share > 0.2
    got = sorted(tuple(r) for r in M.TOP_ORIGINS.partial(t, lines).collect())
    assert got == brute_force_origins(t, lines)


def test_aqe_splits_the_hot_partition(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        t = Tables(spark, SF_ORACLE)
        # AQE splits a skewed partition along map-task boundaries; the fixture is one
        # small file (one map task), so spread it over several tasks as a large table is.
        lines = skewed_lines(t).repartition(16).select("l_suppkey", "l_orderkey",
                                                       "l_extendedprice", F.lit(1).alias("n"))
        rows = roll_up(lines, "l_suppkey", t["supplier"], "s_suppkey", {"s_nationkey": "origin"},
                       sums=["n"], pre_aggregate=False)
        result = rows.groupBy("origin").agg(F.sum("n").alias("n"),
                                            F.max("l_orderkey").alias("last_order"))
        got = sorted((r.origin, r.n) for r in result.collect())
        assert got == brute_force_origins(t, skewed_lines(t))
        final = result._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in final or "skew=true" in final
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionFactor")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
