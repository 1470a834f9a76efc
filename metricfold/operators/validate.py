"""Column presence checks (plan-time only: they read the schema, never the data)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


class MissingColumnsError(ValueError):
    """Raised when a DataFrame lacks columns a metric needs."""


def missing_columns_message(missing: Iterable[str], present: Iterable[str]) -> str:
    # Fixed value: wording of the error, kept as users of the original job see it.
    return (
        f"The [{', '.join(missing)}] columns are not in the DF with columns: "
        f"[{', '.join(present)}]"
    )


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged if it has every required column, else raise.  [V1]"""
    present = df.columns
    have = set(present)
    missing = [c for c in required if c not in have]
    if missing:
        raise MissingColumnsError(missing_columns_message(missing, present))
    return df


def require_tables(tables: Mapping[str, DataFrame], required: Mapping[str, Iterable[str]]) -> None:
    """Check a per-table list of required columns (a metric's input contract).  [V2]"""
    for name, cols in required.items():
        if name not in tables:
            raise MissingColumnsError(f"table {name!r} is not available")
        require_columns(tables[name], cols)
