"""Raw CSV files: every column as text, nothing rejected for its type or column count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_raw(
    spark: SparkSession, path: str, columns: Sequence[str], header: bool = False
) -> DataFrame:
    """The first columns of a CSV file, or of all files below a folder, as strings.

    Further columns are ignored and missing ones are NULL.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.csv(
        path,
        schema=schema,
        header=header,
        mode="PERMISSIVE",
        enforceSchema=True,
        recursiveFileLookup=True,
    )
