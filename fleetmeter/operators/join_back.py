"""Joins of many rows with a table that is usually, but not surely, small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import cut_lineage

# 100,000 narrow rows are a few megabytes, safe to hold on every executor.
BROADCAST_ROWS = 100_000
SALTS = 64


def computed_and_counted(table: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """The table, computed once, and whether it has at most ``limit`` rows."""
    table = cut_lineage(table)
    return table, table.limit(limit + 1).count() <= limit


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    spread_by: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Left join of ``rows`` with ``groups``, which has one row per ``key``, NULL included.

    ``groups`` is computed once and counted. Few groups are broadcast, so the rows do not
    move at all. With more groups both sides are shuffled on the key and a salt taken from
    the ``spread_by`` columns, so that the rows of one hot key go to many tasks.
    """
    groups, few = computed_and_counted(groups.withColumnRenamed(key, "_key"), broadcast_rows)
    same = F.col(key).eqNullSafe(F.col("_key"))
    if few:
        return rows.join(F.broadcast(groups), same, "left").drop("_key")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    salted = groups.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = rows.withColumn("_salt", salt).join(
        salted, same & (F.col("_salt") == F.col("_copy")), "left"
    )
    return joined.drop("_key", "_salt", "_copy")
