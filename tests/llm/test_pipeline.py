"""The pipeline's stages take effect one after another, and the registered queries match their SQL."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from metricfold.llm.scratch import save
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = save(stage(spark, docs, SF), name)
        assert docs.columns == columns
        if name != "source_mix":
            assert 0 < docs.count() <= before
            before = docs.count()
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert ids.count() == docs.count() and ids.where("NOT parity OR NOT round_trip").count() == 0


@pytest.mark.parametrize("name", ["op1_metric_tree_top_k", "op2_rule_ledger"])
def test_oracle(spark, name):
    problems, _, rows = compare(spark, duck(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert rows and not problems
