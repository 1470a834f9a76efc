"""Result sinks.

* Full results: Parquet directories written by all tasks in parallel.
* Small results (top-N): one CSV file, written by a single task after
  ``coalesce(1)``.  Only bounded results (a top-N of known size) go this way;
  nothing is collected on the driver.
* SQL access: a temporary view with a caller-chosen, per-metric name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from metricfold.session import scratch_dir

CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"'}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: tuple[str, ...] = ()) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def save(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh folder of the shared scratch area and read back (cuts the lineage)."""
    path = write_parquet(df, scratch_dir(df.sparkSession, label), mode="errorifexists")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv_dir(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Distributed CSV: one file per task, header in each, quotes doubled.  [K2]"""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One CSV file (inside directory ``path``) for a small, bounded result.

    Keeps the header when the result is empty, quotes values containing the
    separator and escapes quotes by doubling them, and keeps column order.  [K3, K4]
    """
    df.coalesce(1).write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def as_view(df: DataFrame, name: str) -> str:
    """Register ``df`` as a temporary view and return the view name.  [K7]"""
    df.createOrReplaceTempView(name)
    return name
