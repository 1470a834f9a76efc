"""Scalar column expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
expression stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_day(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """Whether three integers form a calendar day of the years 1 to 9999; false for nulls."""
    y, m, d = _col(year), _col(month), _col(day)
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    last = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return F.coalesce(y.between(1, 9999) & m.between(1, 12) & d.between(1, last), F.lit(False))


def day_from_parts(year: str | Column, month: str | Column, day: str | Column,
                   lenient: bool = False) -> Column:
    """Calendar day from integer year, month and day columns.  [P1]

    ``make_date`` raises on an impossible date under ANSI mode; ``lenient=True``
    yields null for it instead, like a permissive CSV parse.
    """
    y, m, d = _col(year), _col(month), _col(day)
    made = F.make_date(y, m, d)
    return F.when(is_day(y, m, d), made) if lenient else made


def first_positive(labelled: Mapping[str, str | Column]) -> Column:
    """Label of the first column, in the given order, whose value is > 0; else null.  [P7]

    Mirrors a ``CASE WHEN a > 0 THEN 'a' WHEN b > 0 THEN 'b' ... END`` without ELSE:
    null and non-positive values fall through.
    """
    expr = None
    for label, column in labelled.items():
        cond = _col(column) > 0
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        raise ValueError("first_positive needs at least one column")
    return expr


def iso_weekday(c: str | Column) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7, as int."""
    return (F.weekday(_col(c)) + 1).cast("int")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division that yields null instead of failing on a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent_of(part: str | Column, total: str | Column) -> Column:
    """``part / total * 100`` as double; null when the total is 0 or null."""
    return ratio(part, total) * F.lit(100.0)


def cents(value: str | Column) -> Column:
    """Exact integer hundredths of a two-decimal amount."""
    return F.round(_col(value) * 100).cast("bigint")
