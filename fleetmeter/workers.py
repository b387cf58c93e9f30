"""Python on the executors."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SENT = "_fleetmeter_sent"


def send_package(spark: SparkSession) -> None:
    """Lets executors import this package. Spark hands out the archive, once per context."""
    context = spark.sparkContext
    if getattr(context, _SENT, False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(os.path.realpath(tempfile.mkdtemp()), "fleetmeter"),
        "zip",
        root_dir=os.path.dirname(package),
        base_dir=os.path.basename(package),
    )
    context.addPyFile(archive)
    setattr(context, _SENT, True)


def map_batches(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """``mapInArrow`` by a function that may use this package."""
    send_package(df.sparkSession)
    return df.mapInArrow(work, schema)
