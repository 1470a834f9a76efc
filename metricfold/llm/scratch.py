"""Tables in the shared scratch folder (``spark.checkpoint.dir``): they cut lineage and outlive executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from metricfold.session import scratch_dir


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch area and read it back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
