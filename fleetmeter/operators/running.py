"""Totals over all rows before a row, for groups of any size.

Rows are summed by bucket first, buckets by hundreds of buckets, and only then added up in order,
so that no window holds more than one bucket, or one run of buckets, of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RUN_OF_BUCKETS = 1024


def _before(partition: list[str], order: list[Column | str], value: str) -> Column:
    window = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def bucket_offsets(rows: DataFrame, group: str, bucket: str, value: str, name: str) -> DataFrame:
    """One row per ``group`` and ``bucket``: the sum of ``value`` over smaller buckets."""
    sums = rows.groupBy(group, bucket).agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_run", F.floor(F.col(bucket) / RUN_OF_BUCKETS))
    runs = sums.groupBy(group, "_run").agg(F.sum("_sum").alias("_run_sum"))
    runs = runs.select(
        F.col(group).alias("_group"),
        F.col("_run").alias("_of_run"),
        _before([group], ["_run"], "_run_sum").alias("_before_run"),
    )
    within = sums.withColumn("_before", _before([group, "_run"], [bucket], "_sum"))
    same = (F.col(group) == F.col("_group")) & (F.col("_run") == F.col("_of_run"))
    return within.join(runs, same).select(
        group, bucket, (F.col("_before") + F.col("_before_run")).cast("long").alias(name)
    )


def with_total_before(
    rows: DataFrame,
    group: str,
    bucket: str,
    order: list[Column | str],
    value: str,
    name: str,
    of_group: DataFrame | None = None,
) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over the rows of the group that come earlier:
    by ``bucket``, then by ``order``. ``group`` and ``bucket`` must not be NULL. The columns of
    ``of_group``, a table with one row per group, are added too: they come with the buckets, so
    the rows of a large group do not meet in one task."""
    offsets = bucket_offsets(rows, group, bucket, value, "_offset")
    if of_group is not None:
        offsets = offsets.join(of_group, group)
    offsets = offsets.withColumnsRenamed({group: "_g", bucket: "_b"})
    within = rows.withColumn("_within", _before([group, bucket], order, value))
    same = (F.col(group) == F.col("_g")) & (F.col(bucket) == F.col("_b"))
    return (
        within.join(offsets, same)
        .withColumn(name, (F.col("_within") + F.col("_offset")).cast("long"))
        .drop("_within", "_offset", "_g", "_b")
    )
