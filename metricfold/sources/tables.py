"""Named Parquet tables under one directory.

Scans are lazy; Catalyst prunes each to the columns and row groups a query
touches (``ReadSchema`` / ``PushedFilters`` in the plan).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class Tables(Mapping[str, DataFrame]):
    """Mapping ``name -> DataFrame`` over ``<root>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, root: str, names=DRIVER_TABLES):
        self.spark = spark
        self.root = root.rstrip("/")
        self._names = tuple(names)
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = read_parquet(self.spark, self.path(name))
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def replace(self, name: str, df: DataFrame) -> "Tables":
        """A copy in which ``name`` resolves to ``df`` (e.g. an as-of view)."""
        other = Tables(self.spark, self.root, self._names)
        other._frames = dict(self._frames)
        other._frames[name] = df
        return other
