"""The corpus pipeline: five stages from raw documents to token ids.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's documents.  All but the last keep the columns of ``documents``.

1. quality_classifier: the ordinal classifier is fitted on the labelled documents; those that
   it rejects go.
2. jaccard_join: one document of each group of near duplicates stays (the smallest id; five-word
   shingles, similarity of 0.8 or more).
3. suffix_dedup: byte strings of 50 or more that an earlier document has are cut from ``text`` and
   documents of which nothing is left go.  ``n_chars`` follows the text.
4. source_mix: documents are taken as often as the mix by source targets says (0, 1 or 2 times).
5. piece_codec: the texts' SentencePiece ids, with the round-trip and parity checks.

Nulls, empty texts and empty tables follow the operators' rules: an empty table gives an empty
result, null texts count as empty, and rows with null ids are never grouped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.llm import jaccard_join, mixing, ordinal_quality, piece_codec, suffix_dedup
from metricfold.llm.queries import table
from metricfold.llm.scratch import save

SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = ordinal_quality.train(docs, table(spark, sf_dir, "labels"))
    return ordinal_quality.select(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, save, SHINGLE_WORDS, SIMILARITY_PERCENT)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return suffix_dedup.cleaned(docs).withColumn("n_chars", n_chars)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plan = save(mixing.quotas(save(mixing.sizes(docs), "sized")), "quotas")
    return mixing.mixed(docs, plan)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with open(piece_codec.model_path(), "rb") as file:
        return piece_codec.encode(docs, file.read())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", near_duplicates),
    ("suffix_dedup", repeated_spans),
    ("source_mix", source_mix),
    ("piece_codec", token_ids),
]

# A trained classifier, suffix arrays and a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
