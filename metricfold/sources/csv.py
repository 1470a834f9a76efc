"""CSV scans.

The default is a typed scan: an explicit schema, bound to the file by its header's names, no
inference pass over the data, and values that do not fit their type become null
(``PERMISSIVE``).  Inference is offered for ad-hoc use only; it costs an extra pass over the
file and turns clock strings like ``0005`` into ``5``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricfold.operators.validate import require_columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             sep: str = ",", header: bool = True, infer: bool = False,
             complete: bool = True) -> DataFrame:
    """CSV scan with header and separator options, typed by ``schema``.  [S1]

    Columns are found by the names in the header, in any order; others in the file are left
    out.  With ``complete`` a column the file lacks is an error (``MissingColumnsError``),
    else it is left out.  All files of a folder must have the first one's header (Spark checks
    it).  Without a header columns go by position.  A file without any line has no rows.
    """
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("escape", '"').option("mode", "PERMISSIVE"))
    if schema is None:
        return reader.option("inferSchema", infer).csv(path)
    found = reader.csv(path) if header else None          # reads the first line
    if found is None or not found.columns:
        return reader.schema(schema).csv(path)
    if complete:
        require_columns(found, schema.names)
    declared = {f.name: f.dataType for f in schema.fields}
    in_file = T.StructType([T.StructField(c, declared.get(c, T.StringType())) for c in found.columns])
    typed = reader.option("enforceSchema", False).schema(in_file).csv(path)
    return typed.select(*[c for c in schema.names if c in found.columns])


CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class CheckedScan:
    """Typed rows, and the rows that do not fit (``file``, ``reason``, ``record`` and the columns that could be read)."""
    rows: DataFrame
    quarantine: DataFrame

    def counts(self) -> DataFrame:
        """``file, reason, n``: malformed rows."""
        return self.quarantine.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))


def _headers(spark: SparkSession, path: str, names: list[str], sep: str) -> tuple[dict[tuple[str, ...], list[str]], list[str]]:
    """Files by their header, and the files without one.

    A header is a line that holds every declared name; it is looked for by content, in one scan of the text that
    only keeps such lines, and only headers and file names reach the driver.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    fields = F.transform(F.split("value", re.escape(sep)), lambda x: F.btrim(x, F.lit('" \r')))
    is_header = F.forall(F.array(*[F.lit(n) for n in names]), lambda n: F.array_contains(fields, n))
    per_file = lines.groupBy("file").agg(F.max(F.when(is_header, F.array_join(fields, "\x00"))).alias("header")).collect()
    found: dict[tuple[str, ...], list[str]] = {}
    for r in per_file:
        if r["header"] is not None:
            found.setdefault(tuple(r["header"].split("\x00")), []).append(r["file"])
    return found, [r["file"] for r in per_file if r["header"] is None]


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> CheckedScan:
    """Typed scan of CSV files with headers that keeps what does not fit apart.  [S1, V1]

    Files are grouped by their header and each group is bound by its own names, so the files of one folder may
    order their columns differently and have columns of their own.  A row goes to quarantine when it has
    another number of fields than its header, or a value that is not of its column's type; all rows of a file
    without the declared columns do.  Rows plus quarantine are all rows of the files.
    """
    found, unbound = _headers(spark, path, schema.names, sep)
    declared = {f.name: f.dataType for f in schema.fields}
    read = spark.read.option("sep", sep).option("escape", '"').option("mode", "PERMISSIVE")
    good, bad = [], []
    for header, files in sorted(found.items()):
        in_file = T.StructType([T.StructField(c if header.index(c) == i else f"{c}__{i}", declared.get(c, T.StringType()))
                                for i, c in enumerate(header)] + [T.StructField(CORRUPT, T.StringType())])
        rows = (read.option("header", True).option("enforceSchema", True).option("columnNameOfCorruptRecord", CORRUPT)
                .schema(in_file).csv(files)).select("*", F.col("_metadata.file_path").alias("__file"))
        # The parser judges only the columns that a plan asks for.  This condition (always true, not folded away) asks for
        # all declared ones, so that a count finds the same malformed rows as a full read.
        rows = rows.filter(F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.names])) >= 0)
        good.append(rows.filter(F.col(CORRUPT).isNull()).select(*schema.names))
        bad.append(rows.filter(F.col(CORRUPT).isNotNull()).select(
            F.col("__file").alias("file"), F.lit("malformed").alias("reason"), F.col(CORRUPT).alias("record"), *schema.names))
    if unbound:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        bad.append(spark.read.text(unbound).select(F.col("_metadata.file_path").alias("file"), F.lit("no header").alias("reason"),
                                                   F.col("value").alias("record"), *nothing))
    empty = spark.createDataFrame([], schema)
    none = empty.select(F.lit("").alias("file"), F.lit("").alias("reason"), F.lit("").alias("record"), "*")
    return CheckedScan(reduce(DataFrame.unionByName, good, empty), reduce(DataFrame.unionByName, bad, none))


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",",
                      header: bool = True) -> DataFrame:
    """CSV scan with inferred column types (one extra pass over the data).  [S3]"""
    return read_csv(spark, path, schema=None, sep=sep, header=header, infer=True)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind columns by name and cast them to ``schema``'s types, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
