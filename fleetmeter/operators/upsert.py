"""Keyed upsert without a table format that supports row updates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same_key(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Key equality between two aliased sides; NULL equals NULL only if ``null_safe``."""

    def equal(key: str) -> Column:
        a, b = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(and_, [equal(key) for key in keys])


def has_full_key(keys: Sequence[str]) -> Column:
    """True for rows plain key equality can match: no key column is NULL."""
    return reduce(and_, [F.col(key).isNotNull() for key in keys])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Source rows, one per key, replace target rows of that key; all others are kept.

    With plain equality a row with a NULL key matches nothing and is added again by every run.
    Both sides are read once and shuffled together on the keys; Spark drops target rows that
    lose to a source row of the same task before the shuffle.
    """
    side = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)))
    same = [F.col(key) for key in keys]
    if not null_safe:
        # Rows without a full key never meet the other side's.
        same.append(F.when(~has_full_key(keys), F.col("_new")))
    order = Window.partitionBy(*same).orderBy(F.col("_new").desc())
    ranked = side.withColumn("_rank", F.rank().over(order))
    return ranked.filter(F.col("_rank") == 1).drop("_rank", "_new")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    deleted: str,
    null_safe: bool = False,
) -> DataFrame:
    """``upsert`` with deletes: source rows whose column ``deleted`` is true remove the target row
    of their key, and are not added themselves. The column is not in the result."""
    marked = target.withColumn(deleted, F.lit(False))
    merged = upsert(marked, source.select(*marked.columns), keys, null_safe)
    return merged.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
