"""Stored tables: Parquet directories with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def append(table: DataFrame, path: str) -> None:
    table.write.mode("append").parquet(path)


def _place(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def ensure_folder(spark: SparkSession, folder: str) -> None:
    """Create a folder if need be, so that a stream can start on it before its first file."""
    files, path = _place(spark, folder)
    files.mkdirs(path)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    files, path = _place(spark, folder)
    return files.exists(path)


def child_folders(spark: SparkSession, folder: str) -> list[str]:
    """The names of the folders in a folder, none if it is not there."""
    files, path = _place(spark, folder)
    if not files.exists(path):
        return []
    return sorted(x.getPath().getName() for x in files.listStatus(path) if x.isDirectory())


def rename(spark: SparkSession, old: str, new: str) -> None:
    files, path = _place(spark, old)
    if not files.rename(path, _place(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that this package made."""
    files, path = _place(spark, folder)
    files.delete(path, True)
