"""Readings to hourly rows per device and site.

The hourly row is built in two steps. ``hourly_partials`` keeps sums and counts, which
can be added up again; ``finish_hourly`` turns them into averages. Late or split hours
are therefore repaired exactly by adding partial rows, without reading the readings again.
All partial values are plain sums, counts, minima and maxima, so Spark combines them
before the shuffle and one hot device or site costs no more than any other key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.times import TimeLike, as_ntz, hour_bucket, utc_now
from fleetmeter.functions.values import out_of_range
from fleetmeter.schemas import SILVER, SILVER_KEYS


@dataclass(frozen=True)
class Thresholds:
    """Alert bounds; a value outside raises the flag. Defaults are fixed values."""

    temperature_low: float = 2
    temperature_high: float = 8
    humidity_low: float = 30
    humidity_high: float = 70


# What the hourly rows are computed from.
READING_COLUMNS = [
    "device_id",
    "site_id",
    "reading_time",
    "temperature",
    "humidity",
    "battery_pct",
    "signal_rssi",
    "uptime_hours",
    "data_usage_mb",
]

# (partial column, how partial rows are added up)
_PARTIALS = {
    "sum_temperature": F.sum,
    "n_temperature": F.sum,
    "min_temperature": F.min,
    "max_temperature": F.max,
    "sum_humidity": F.sum,
    "n_humidity": F.sum,
    "min_humidity": F.min,
    "max_humidity": F.max,
    "sum_battery_pct": F.sum,
    "n_battery_pct": F.sum,
    "sum_signal_rssi": F.sum,
    "n_signal_rssi": F.sum,
    "uptime_hours": F.max,
    "data_usage_mb": F.sum,
    "record_count": F.sum,
    "has_temperature_alert": F.max,
    "has_humidity_alert": F.max,
}


def hourly_partials(
    readings: DataFrame,
    thresholds: Thresholds = Thresholds(),
    extra_keys: Sequence[str] = (),
    extra_values: Sequence[Column] = (),
) -> DataFrame:
    """Sums and counts per device, site and hour.

    A reading whose time is NULL belongs to the group with a NULL hour.
    """
    t = thresholds
    hot_or_cold = out_of_range(F.col("temperature"), t.temperature_low, t.temperature_high)
    dry_or_wet = out_of_range(F.col("humidity"), t.humidity_low, t.humidity_high)
    keyed = readings.withColumn("hour_bucket", hour_bucket(F.col("reading_time")))
    return keyed.groupBy(*SILVER_KEYS, *extra_keys).agg(
        F.sum("temperature").alias("sum_temperature"),
        F.count("temperature").alias("n_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.sum("humidity").alias("sum_humidity"),
        F.count("humidity").alias("n_humidity"),
        F.min("humidity").alias("min_humidity"),
        F.max("humidity").alias("max_humidity"),
        F.sum("battery_pct").alias("sum_battery_pct"),
        F.count("battery_pct").alias("n_battery_pct"),
        F.sum("signal_rssi").alias("sum_signal_rssi"),
        F.count("signal_rssi").alias("n_signal_rssi"),
        F.max("uptime_hours").alias("uptime_hours"),
        F.sum("data_usage_mb").alias("data_usage_mb"),
        F.count(F.lit(1)).alias("record_count"),
        F.max(hot_or_cold).alias("has_temperature_alert"),
        F.max(dry_or_wet).alias("has_humidity_alert"),
        *extra_values,
    )


def add_partials(partials: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Partial rows of the same hour to one partial row."""
    return partials.groupBy(*SILVER_KEYS, *extra_keys).agg(
        *[add(name).alias(name) for name, add in _PARTIALS.items()]
    )


def finish_hourly(
    partials: DataFrame, load_ts: TimeLike | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Partial rows to silver rows, columns in the order of the silver schema."""

    def mean(name: str) -> Column:
        return F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}"))

    done = partials.select(
        "*",
        mean("temperature").alias("avg_temperature"),
        mean("humidity").alias("avg_humidity"),
        mean("battery_pct").alias("avg_battery_pct"),
        F.round(mean("signal_rssi")).cast("int").alias("signal_rssi_avg"),
        (utc_now() if load_ts is None else as_ntz(load_ts)).alias("load_ts"),
    )
    return done.select(*SILVER.names, *extra)


def silver_hourly(
    readings: DataFrame,
    load_ts: TimeLike | None = None,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """Hourly averages, extremes, totals and alert flags of a set of readings."""
    return finish_hourly(hourly_partials(readings, thresholds), load_ts)


def silver_by_batch(
    readings: DataFrame,
    batch: str = "batch_id",
    load_ts: str = "loaded_at",
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """What appending the hourly rows of each load batch, one after the other, leaves.

    An hour spread over two batches has two rows, as with any insert-only load. A batch
    has one load time.
    """
    batch_times = F.max(load_ts).alias("_loaded")
    partials = hourly_partials(readings, thresholds, (batch,), (batch_times,))
    return finish_hourly(partials, F.col("_loaded"), (batch,))


def alert_flags(readings: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Only the keys and the two alert flags of the hourly rows."""
    flags = ["has_temperature_alert", "has_humidity_alert"]
    return hourly_partials(readings, thresholds).select(*SILVER_KEYS, *flags)


def compact_silver(silver: DataFrame, load_ts: TimeLike | None = None) -> DataFrame:
    """One row per key from stored silver rows, averages weighted by ``record_count``.

    Stored rows do not say how many values of a column were present, so averages are
    exact only without NULL readings, and ``signal_rssi_avg`` only up to its stored
    rounding. Use ``add_partials`` on partial rows where that matters.
    """

    def weighted(name: str) -> Column:
        weight = F.when(F.col(name).isNotNull(), F.col("record_count"))
        return F.try_divide(F.sum(F.col(name) * weight), F.sum(weight))

    merged = silver.groupBy(*SILVER_KEYS).agg(
        weighted("avg_temperature").alias("avg_temperature"),
        F.min("min_temperature").alias("min_temperature"),
        F.max("max_temperature").alias("max_temperature"),
        weighted("avg_humidity").alias("avg_humidity"),
        F.min("min_humidity").alias("min_humidity"),
        F.max("max_humidity").alias("max_humidity"),
        weighted("avg_battery_pct").alias("avg_battery_pct"),
        F.round(weighted("signal_rssi_avg")).cast("int").alias("signal_rssi_avg"),
        F.max("uptime_hours").alias("uptime_hours"),
        F.sum("data_usage_mb").alias("data_usage_mb"),
        F.sum("record_count").alias("record_count"),
        F.max("has_temperature_alert").alias("has_temperature_alert"),
        F.max("has_humidity_alert").alias("has_humidity_alert"),
        (F.max("load_ts") if load_ts is None else as_ntz(load_ts)).alias("load_ts"),
    )
    return merged.select(*SILVER.names)


def filter_silver(
    silver: DataFrame,
    start: TimeLike | None = None,
    end: TimeLike | None = None,
    site_id: str | None = None,
    device_id: str | None = None,
) -> DataFrame:
    """Rows of an hour range (both ends included), a site, a device.

    When the table is stored by day, the range is also put on ``day``: a condition on
    the hour alone would not prune day directories.
    """
    by_day = "day" in silver.columns
    if start is not None:
        silver = silver.filter(F.col("hour_bucket") >= as_ntz(start))
        if by_day:
            silver = silver.filter(F.col("day") >= as_ntz(start).cast("date"))
    if end is not None:
        silver = silver.filter(F.col("hour_bucket") <= as_ntz(end))
        if by_day:
            silver = silver.filter(F.col("day") <= as_ntz(end).cast("date"))
    if site_id is not None:
        silver = silver.filter(F.col("site_id") == site_id)
    if device_id is not None:
        silver = silver.filter(F.col("device_id") == device_id)
    return silver
