import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from metricfold.session import build_session

    spark = build_session("local[*]", app_name="metricfold-tests", shuffle_partitions=8)
    # Tests own their checkpoint folder (a cluster names a shared one instead).
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="metricfold-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def workdir(spark):
    from metricfold.session import scratch_dir

    return scratch_dir(spark, "test")


@pytest.fixture()
def no_broadcast(spark):
    """Force the shuffle-join paths: no dimension counts as small."""
    old_auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_auto)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
