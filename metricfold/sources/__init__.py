"""Table sources: typed CSV scans, Parquet tables, catalogue lookups."""

from metricfold.sources.catalog import exactly_one, path_for
from metricfold.sources.csv import cast_to, read_csv, read_csv_inferred
from metricfold.sources.tables import DRIVER_TABLES, Tables

__all__ = [
    "DRIVER_TABLES", "Tables", "cast_to", "exactly_one", "path_for", "read_csv",
    "read_csv_inferred",
]
