"""Fact tables that drive increments: how to cut them by day and find their bounds.

A fact table either stores its day in one date/timestamp column (the driver's
``lineitem.l_shipdate``, ``events.ts``) or spreads it over integer
``YEAR``/``MONTH``/``DAY`` columns (flights).  For the latter the increment is
written as a lexicographic comparison on the three integers, which a Parquet
scan accepts as pushed filters and which prunes ``YEAR``/``MONTH`` partition
directories, instead of a filter on a derived date that no scan can use.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricfold.functions.columns import day_from_parts, is_day
from metricfold.operators import increment as inc


@dataclass(frozen=True)
class FactTable:
    name: str
    after: Callable[[DataFrame, dt.date | None], DataFrame]     # rows with day > watermark
    as_of: Callable[[DataFrame, dt.date | None], DataFrame]     # rows with day <= cut
    day: Callable[[], Column]                                   # the row's day


def stamped(name: str, column: str) -> FactTable:
    """Fact table whose day is the calendar day of one date/timestamp column."""
    return FactTable(
        name=name,
        after=lambda df, wm: inc.after(df, column, wm),
        as_of=lambda df, cut: inc.as_of(df, column, cut),
        day=lambda: F.to_date(F.col(column)),
    )


def _later_than(day: dt.date, y: str, m: str, d: str) -> Column:
    Y, M, D = F.col(y), F.col(m), F.col(d)
    return (Y > day.year) | ((Y == day.year) & ((M > day.month) | ((M == day.month) & (D > day.day))))


def from_parts(name: str, year: str = "YEAR", month: str = "MONTH", day: str = "DAY") -> FactTable:
    """Fact table whose day is assembled from integer year, month and day columns.

    Rows whose parts are missing or form no date (``is_day``) have no day: they belong to the
    first window alone, whatever their parts say, and do not move the bounds.
    """
    def after(df, wm):
        if wm is None:
            return df
        return df.filter(_later_than(wm, year, month, day) & is_day(year, month, day))

    def as_of(df, cut):
        if cut is None:
            return df
        return df.filter(~_later_than(cut, year, month, day) | ~is_day(year, month, day))

    return FactTable(name=name, after=after, as_of=as_of,
                     day=lambda: day_from_parts(year, month, day, lenient=True))


@dataclass(frozen=True)
class Span:
    """What an increment holds: its number of rows, and its first and last day (None: no day)."""
    rows: int
    first: dt.date | None
    last: dt.date | None


def span(table: FactTable, df: DataFrame) -> Span:
    """The span of ``df`` in one global aggregate over the day's columns (three scalars)."""
    day = table.day()
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.min(day).alias("first"), F.max(day).alias("last")).first()
    return Span(row["rows"], row["first"], row["last"])


# The driver's fact tables.
FACT_TABLES = {
    "lineitem": stamped("lineitem", "l_shipdate"),
    "events": stamped("events", "ts"),
    "flights": from_parts("flights"),
}
