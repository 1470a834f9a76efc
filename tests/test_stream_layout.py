"""The registered stream reads its table whether it is one file or a directory of part files."""

from metricfold.plans.queries import metric_first_reason_counts, stream_first_reason_counts
from metricfold.sources import Tables
from tests.conftest import SF_SMALL


def test_stream_of_a_directory_table(spark, workdir):
    t = Tables(spark, SF_SMALL)
    for name in t:
        t[name].repartitionByRange(3, t[name].columns[0]).write.parquet(f"{workdir}/{name}.parquet")
    want = sorted(map(tuple, metric_first_reason_counts(spark, SF_SMALL).collect()))
    assert sorted(map(tuple, stream_first_reason_counts(spark, workdir).collect())) == want
    assert sorted(map(tuple, stream_first_reason_counts(spark, SF_SMALL).collect())) == want
