"""Result sinks: Parquet, CSV directory, single-file CSV, SQL view."""

from metricfold.sinks.files import as_view, write_csv_dir, write_parquet, write_single_csv

__all__ = ["as_view", "write_csv_dir", "write_parquet", "write_single_csv"]
