"""Row filters and projections (pushed to the scan by Catalyst where possible)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def only_zero(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is exactly 0; nulls are dropped (SQL comparison).  [P3]"""
    return df.filter(F.col(column) == 0)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null in ``columns`` (all columns when None).  [P8]"""
    return df.na.drop(how="any", subset=list(columns) if columns else None)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column projection.  [P5]"""
    return df.select(*columns)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename of every column (``toDF``).  [P9]"""
    return df.toDF(*names)
