"""The stored silver and gold tables, batch by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.schemas import GOLD, GOLD_HISTORY, GOLD_PARTIALS, SILVER_BY_DAY, SILVER_STORED
from fleetmeter.sources.commits import publish, read_committed, remove_unnamed


def _batch() -> Column:
    return F.col("commit_id").cast("long")


def append_silver(silver: DataFrame, path: str, batch_id: int) -> None:
    """Add hourly rows as a batch, by day.

    The rebalance gathers each day before the write, so that not every task writes a
    file of every day, and splits a day that is too large for one task.
    """
    by_day = silver.withColumn("day", F.col("hour_bucket").cast("date"))
    publish(by_day.hint("rebalance", "day"), path, str(batch_id), ["day"])


def read_silver(spark: SparkSession, path: str, only: DataFrame | Column | None = None) -> DataFrame:
    """Stored hourly rows with ``batch_id`` and ``day``."""
    rows = read_committed(spark, path, SILVER_BY_DAY, only)
    return rows.withColumn("batch_id", _batch()).select(*SILVER_STORED.names)


def append_history(gold: DataFrame, path: str, batch_id: int) -> None:
    """Add one batch of versions."""
    publish(gold, path, str(batch_id))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions with their ``batch_id``."""
    rows = read_committed(spark, path, GOLD)
    return rows.withColumn("batch_id", _batch()).select(*GOLD_HISTORY.names)


def store_state(state: DataFrame, path: str, batch_id: int) -> None:
    """Add the state after a batch, a version of its own."""
    publish(state.drop("batch_id"), path, str(batch_id))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a state that are still there, with their ``batch_id``."""
    rows = read_committed(spark, path, GOLD_PARTIALS[:-1])
    return rows.withColumn("batch_id", _batch()).select(*GOLD_PARTIALS.names)


def drop_states_before(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove the versions before that of a batch."""
    remove_unnamed(spark, path, _batch() >= batch_id)
