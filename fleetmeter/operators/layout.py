"""Table layouts that let filters skip files, and how good a layout is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.session import cut_lineage


def write_silver_layout(silver: DataFrame, path: str) -> None:
    """Store silver by day, each day's files sorted by site and hour.

    The ranges also use hour and device, so that a site that holds most of a day is cut
    into several files instead of one.
    """
    day = F.col("hour_bucket").cast("date")
    order = ["day", "site_id", "hour_bucket", "device_id"]
    ranged = silver.withColumn("day", day).repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("day").parquet(path)


def write_gold_layout(gold: DataFrame, path: str) -> None:
    """Store gold in files that each cover a range of hours and sites."""
    order = ["analysis_hour", "site_id"]
    ranged = gold.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").parquet(path)


def with_file(table: DataFrame) -> DataFrame:
    """A table read from files, with the path of each row's file."""
    return table.withColumn("file", F.col("_metadata.file_path"))


def file_ranges(table: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    """Smallest and largest key of each file: ``(file, low, high)``.

    The distinct keys of each file are found first, by hashing; only those are ordered.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in key]
    parts = [c.alias(f"k{i}") for i, c in enumerate(columns)]
    names = [f"k{i}" for i in range(len(columns))]
    distinct = table.select("file", *parts).distinct()
    value = F.struct(*names)
    return distinct.groupBy("file").agg(F.min(value).alias("low"), F.max(value).alias("high"))


def file_depths(ranges: DataFrame) -> DataFrame:
    """``(file, overlap, depth)`` for a stored table of ``(file, low, high)``.

    The overlap of a file is the number of other files whose key range meets its own. Its
    depth is the number of files that cover its smallest key. Both follow from two running
    counts over the key values: files that begin at or before a value, and files that end
    before it. No pairs of files are built. The values are dealt out by ranges; the counts run
    within each range, and only the totals, one row for each range, are put in one order.
    Runs at once, when it is called, to keep the dealt values.
    """
    ends = ranges.select(
        F.explode(
            F.array(
                F.struct(F.col("low").alias("at"), F.lit(1).alias("begins"), F.lit(0).alias("ends")),
                F.struct(F.col("high").alias("at"), F.lit(0).alias("begins"), F.lit(1).alias("ends")),
            )
        ).alias("e")
    ).select("e.*")
    per_value = ends.groupBy("at").agg(
        F.sum("begins").alias("begins"), F.sum("ends").alias("ends")
    )
    dealt = per_value.repartitionByRange("at").withColumn("part", F.spark_partition_id())
    per_value = cut_lineage(dealt)

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_value.groupBy("part").agg(
        F.sum("begins").alias("begins"), F.sum("ends").alias("ends")
    )
    carried = per_part.select(
        "part",
        F.coalesce(F.sum("begins").over(earlier), F.lit(0)).alias("begins_carried"),
        F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("ends_carried"),
    )

    within = Window.partitionBy("part").orderBy("at")
    up_to = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    running = (
        per_value.withColumn("begun", F.sum("begins").over(up_to))
        .withColumn("ended", F.coalesce(F.sum("ends").over(before), F.lit(0)))
        .join(carried, "part")
        .select(
            "at",
            (F.col("begun") + F.col("begins_carried")).alias("begun"),
            (F.col("ended") + F.col("ends_carried")).alias("ended"),
        )
    )
    low = running.select(F.col("at").alias("low_at"), "begun", "ended")
    high = running.select(F.col("at").alias("high_at"), F.col("begun").alias("begun_by_high"))
    return (
        ranges.join(low, F.col("low").eqNullSafe(F.col("low_at")))
        .join(high, F.col("high").eqNullSafe(F.col("high_at")))
        .select(
            "file",
            (F.col("begun_by_high") - F.col("ended") - 1).alias("overlap"),
            (F.col("begun") - F.col("ended")).alias("depth"),
        )
    )


def layout_health(table: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    """One row: number of files, and their mean overlap and depth in key order, as
    ``file_depths`` has them. Runs at once to keep the file ranges and the dealt values."""
    measured = file_depths(cut_lineage(file_ranges(table, key)))
    return measured.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.avg("overlap").alias("average_overlap"),
        F.avg("depth").alias("average_depth"),
    )
