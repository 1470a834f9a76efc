"""Logical-name lookups in small configuration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


class CatalogLookupError(LookupError):
    pass


def exactly_one(df: DataFrame, what: str) -> Row:
    """The single row of ``df``; an error if there is none or more than one.

    Fetches at most two rows to the driver.  [T5]
    """
    rows = df.limit(2).collect()
    if not rows:
        raise CatalogLookupError(f"no row for {what}")
    if len(rows) > 1:
        raise CatalogLookupError(f"more than one row for {what}")
    return rows[0]


def path_for(catalog: DataFrame, name: str) -> str:
    """Location of the table called ``name`` in a ``(name, path)`` catalogue.  [S4, P4]"""
    row = exactly_one(catalog.filter(F.col("name") == F.lit(name)).select("path"), f"table {name!r}")
    return row["path"]
