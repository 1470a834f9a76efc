"""Incremental selection: rows newer than a stored day, and the bounds of a batch.

The watermark is a calendar day.  A row belongs to the increment when its day is
strictly later than the watermark; with no watermark (first run) every row does.
Rows that arrive late, with a day at or before the watermark, are not picked up;
that is the documented contract of the stored-date protocol.

The comparison is written against the *stored* column (``ts >= day + 1``) rather
than against a derived day, so Catalyst hands it to the Parquet scan as a pushed
filter and row groups outside the increment are skipped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _typed_literal(value: dt.date | dt.datetime, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.lit(value if not isinstance(value, dt.datetime) else value.date())
    if isinstance(value, dt.datetime):
        stamp = value
    else:
        stamp = dt.datetime(value.year, value.month, value.day)
    text = stamp.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    return F.expr(f"TIMESTAMP '{text}'")


def day_after(column: str, kind: T.DataType, watermark: dt.date) -> Column:
    """Predicate ``day(column) > watermark`` written on the raw column."""
    if isinstance(kind, T.DateType):
        return F.col(column) > _typed_literal(watermark, kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(column) >= _typed_literal(watermark + dt.timedelta(days=1), kind)
    raise TypeError(f"column {column} of type {kind.simpleString()} is not a date or timestamp")


def day_at_or_before(column: str, kind: T.DataType, cut: dt.date) -> Column:
    """Predicate ``day(column) <= cut`` written on the raw column."""
    return ~day_after(column, kind, cut)


def after(df: DataFrame, column: str, watermark: dt.date | None) -> DataFrame:
    """Rows whose day is strictly later than ``watermark``; all rows if it is None.  [P2]"""
    if watermark is None:
        return df
    return df.filter(day_after(column, df.schema[column].dataType, watermark))


def as_of(df: DataFrame, column: str, cut: dt.date | None) -> DataFrame:
    """The table as it stood at the end of day ``cut``: rows on or before it.

    Rows without a day are included: a later increment (``day > watermark``) can
    never select them, so they belong to the first window and are counted once.
    """
    if cut is None:
        return df
    kind = df.schema[column].dataType
    return df.filter(day_at_or_before(column, kind, cut) | F.col(column).isNull())


def bounds_frame(df: DataFrame, column: str) -> DataFrame:
    """One-row frame with the first and last day present in ``column``.

    A global aggregate: partial min/max per task, one tiny final merge.  Never a
    window over the whole table (that would move every row into one partition).
    """
    day = F.to_date(F.col(column))
    return df.agg(F.min(day).alias("min_day"), F.max(day).alias("max_day"))


def bounds(df: DataFrame, column: str) -> tuple[dt.date | None, dt.date | None]:
    """First and last day of the increment, fetched as two scalars.  [A9, W1, R2]"""
    row = bounds_frame(df, column).collect()[0]
    return row["min_day"], row["max_day"]
