"""Breach episodes: runs of readings over a limit without a good reading between them.

Rows are dealt out by ranges of (device, time), so the readings of one device lie in as many tasks
as they need. Runs are found within each piece; of each piece only its first and last run can go on
in another, and only those are put together over the pieces of a device.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.session import cut_lineage
from fleetmeter.sources import commits

EPISODES = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("first_at", T.TimestampNTZType()),
        T.StructField("last_at", T.TimestampNTZType()),
        T.StructField("peak", T.DoubleType()),
        T.StructField("readings", T.LongType()),
        T.StructField("is_open", T.BooleanType()),
    ]
)
# An episode as a batch knows it, with its alert: the start and the batch it was first told with.
TOLD = T.StructType(
    [
        *EPISODES,
        T.StructField("alert_at", T.TimestampNTZType()),
        T.StructField("alert_batch", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)
ALERT = "struct<alert_at: timestamp_ntz, alert_batch: bigint>"


def _marked(readings: DataFrame, limit: float) -> DataFrame:
    """Readings that can be judged, as runs of one without an alert."""
    known = readings.filter("device_id IS NOT NULL AND reading_time IS NOT NULL AND temperature IS NOT NULL")
    return known.select(
        F.col("device_id").cast("string").alias("device_id"),
        F.col("reading_time").alias("at"),
        F.col("reading_id").cast("long").alias("id"),
        (F.col("temperature") > limit).alias("breach"),
        F.col("reading_time").alias("first_at"),
        F.col("temperature").cast("double").alias("peak"),
        F.lit(1).cast("long").alias("readings"),
        F.lit(None).cast(ALERT).alias("alert"),
    )


def _runs(rows: DataFrame) -> DataFrame:
    """The runs of breaching rows, with ``is_open`` (no later row of the device) and the ``alert``
    of the earlier run that one of their rows may stand for. Runs at once to keep the dealt rows."""
    order = ["at", "id", "peak"]
    dealt = rows.repartitionByRange("device_id", *order).withColumn("part", F.spark_partition_id())
    dealt = cut_lineage(dealt)

    ends = F.struct(*order, "breach")
    pieces = dealt.groupBy("device_id", "part").agg(
        F.min(ends).getField("breach").alias("begins"), F.max(ends).getField("breach").alias("ends")
    )
    by_part = W.partitionBy("device_id").orderBy("part")
    pieces = pieces.select(
        "device_id",
        "part",
        (F.col("begins") & F.lag("ends", 1, False).over(by_part)).alias("goes_on"),
        F.lead("part").over(by_part).isNull().alias("is_last"),
    )

    piece = W.partitionBy("part", "device_id").orderBy(*order, "breach")
    place = (
        dealt.withColumn("good", F.sum((~F.col("breach")).cast("long")).over(piece.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("all_good", F.sum((~F.col("breach")).cast("long")).over(W.partitionBy("part", "device_id")))
        .filter("breach")
    )
    # Rows of one run have the same number of good rows before them.
    local = place.groupBy("device_id", "part", "good").agg(
        F.min("first_at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.max("peak").alias("peak"),
        F.sum("readings").alias("readings"),
        F.max("alert").alias("alert"),
        F.first("all_good").alias("all_good"),
    )
    local = local.join(pieces, ["device_id", "part"]).withColumns(
        {
            "at_start": F.col("good") == 0,
            "at_end": F.col("good") == F.col("all_good"),
            "is_open": F.col("is_last") & (F.col("good") == F.col("all_good")),
        }
    )
    at_border = F.col("at_start") | F.col("at_end")
    inside = local.filter(~at_border)
    order_of_runs = W.partitionBy("device_id").orderBy("part", "good")
    new = (~(F.col("at_start") & F.col("goes_on"))).cast("long")
    border = local.filter(at_border).withColumn("run", F.sum(new).over(order_of_runs))
    joined = border.groupBy("device_id", "run").agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.max("peak").alias("peak"),
        F.sum("readings").alias("readings"),
        F.max("is_open").alias("is_open"),
        F.max("alert").alias("alert"),
    )
    joined = joined.drop("run")
    return joined.unionByName(inside.select(*joined.columns))


def breach_episodes(readings: DataFrame, limit: float) -> DataFrame:
    """One row per episode: ``(device_id, first_at, last_at, peak, readings, is_open)``.

    A reading breaches if its temperature is above ``limit``. Readings of a device are taken by
    time, then by ``reading_id``; one that repeats as a whole counts again. Readings without
    device, time or temperature neither begin nor end an episode. No row, no episode. An episode
    is open if the device has no later reading. Runs a job at once.
    """
    return _runs(_marked(readings, limit)).select(*EPISODES.names)


def open_episodes(spark: SparkSession, path: str) -> DataFrame:
    """The episodes that were open after the last batch that was taken into ``path``."""
    stored = commits.read_committed(spark, path, TOLD)
    # Of the markers, not of the rows: the last batch may have no episode.
    done = commits.commits(spark, path).select(F.max(F.substring_index("commit_id", "-", -1).cast("long")).alias("newest"))
    last = F.broadcast(done)
    return stored.join(last, F.col("batch") == F.col("newest")).filter("is_open").select(*TOLD.names)


def take_batch(spark: SparkSession, path: str, batch: int, readings: DataFrame, limit: float) -> bool:
    """Carry the open episodes on with one more batch and publish what is known of them then.

    Batches have rising numbers from 0. Published are the episodes of the batch and all that were
    open before. An episode that no earlier batch has told of is an alert: its ``alert_batch`` is
    this ``batch``. A batch that is there already changes nothing and gives False, so a replay
    alerts nothing twice. An open episode counts as one row at its last reading: a late reading is
    sorted before it, may begin an episode of its own or add to it, and does not cut it.
    """
    if not commits.commits(spark, path).filter(F.col("commit_id") == f"batch-{batch}").isEmpty():
        return False
    carried = open_episodes(spark, path).select(
        "device_id",
        F.col("last_at").alias("at"),
        F.lit(None).cast("long").alias("id"),
        F.lit(True).alias("breach"),
        "first_at",
        "peak",
        "readings",
        F.struct("alert_at", "alert_batch").cast(ALERT).alias("alert"),
    )
    runs = _runs(_marked(readings, limit).unionByName(carried))
    this = F.lit(batch).cast("long")
    alert = F.coalesce("alert", F.struct(F.col("first_at").alias("alert_at"), this.alias("alert_batch")))
    rows = runs.select(
        *EPISODES.names,
        alert.getField("alert_at").alias("alert_at"),
        alert.getField("alert_batch").alias("alert_batch"),
        this.alias("batch"),
    )
    return commits.publish(rows, path, f"batch-{batch}")


def alerts(spark: SparkSession, path: str) -> DataFrame:
    """One row per episode, as it was first told of: ``(device_id, alert_at, alert_batch)``."""
    told = commits.read_committed(spark, path, TOLD).filter("batch = alert_batch")
    return told.select("device_id", "alert_at", "alert_batch")


def told_episodes(spark: SparkSession, path: str) -> DataFrame:
    """Each episode as its newest batch knows it."""
    stored = commits.read_committed(spark, path, TOLD)
    newest = F.max_by(F.struct(*EPISODES.names[1:]), "batch").alias("newest")
    told = stored.groupBy("device_id", "alert_at", "alert_batch").agg(newest)
    return told.select("device_id", "newest.*", "alert_at", "alert_batch")
