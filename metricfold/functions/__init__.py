"""Column expressions shared by operators and metrics (all JVM-side built-ins)."""

from metricfold.functions.columns import (
    cents,
    day_from_parts,
    first_positive,
    is_day,
    iso_weekday,
    percent_of,
    ratio,
)

__all__ = ["cents", "day_from_parts", "first_positive", "is_day", "iso_weekday", "percent_of", "ratio"]
