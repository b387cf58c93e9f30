"""Results that are costly to compute and read more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetmeter.session import work_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    What follows survives a lost executor without computing ``df`` again.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
