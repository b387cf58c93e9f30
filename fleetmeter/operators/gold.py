"""Hourly device rows to site KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.times import TimeLike, as_ntz, hour_bucket, utc_now
from fleetmeter.functions.values import round_fixed
from fleetmeter.schemas import GOLD, GOLD_KEYS


def fleet_metrics(
    silver: DataFrame,
    uptime_digits: int = 1,
    count_rows: bool = False,
    extra_keys: Sequence[str] = (),
    extra_values: Sequence[Column] = (),
) -> DataFrame:
    """Site KPIs per hour.

    Averages are unweighted means of the hourly device averages, and alerts count silver
    rows. Spark plans the single distinct count as a first aggregate by (hour, site,
    device), so a site that holds most of the rows is still spread over its devices.
    ``count_rows`` makes ``total_records`` the number of silver rows, not of readings.
    """
    warm, humid = F.col("has_temperature_alert"), F.col("has_humidity_alert")
    records = F.count(F.lit(1)) if count_rows else F.sum("record_count")
    return (
        silver.withColumnRenamed("hour_bucket", "analysis_hour")
        .groupBy(*GOLD_KEYS, *extra_keys)
        .agg(
            F.countDistinct("device_id").alias("active_devices"),
            round_fixed(F.avg("avg_temperature"), 2).alias("avg_temperature"),
            round_fixed(F.max("max_temperature"), 2).alias("max_temperature"),
            round_fixed(F.min("min_temperature"), 2).alias("min_temperature"),
            round_fixed(F.avg("avg_humidity"), 2).alias("avg_humidity"),
            round_fixed(F.avg("avg_battery_pct"), 2).alias("avg_battery_pct"),
            round_fixed(F.sum("data_usage_mb"), 2).alias("total_data_usage_mb"),
            round_fixed(F.avg("uptime_hours"), uptime_digits).alias("avg_uptime_hours"),
            F.count_if(warm | humid).alias("total_alerts"),
            F.count_if(warm).alias("alert_temp_count"),
            F.count_if(humid).alias("alert_humidity_count"),
            records.alias("total_records"),
            *extra_values,
        )
    )


def gold_rows(silver: DataFrame, loaded_at: TimeLike | None = None) -> DataFrame:
    """Site KPIs stamped with their load time, columns in the order of the gold schema."""
    stamp = utc_now() if loaded_at is None else as_ntz(loaded_at)
    return fleet_metrics(silver).withColumn("loaded_at", stamp).select(*GOLD.names)


def gold_dynamic(silver: DataFrame, count_rows: bool = True) -> DataFrame:
    """The declarative form: a full recompute with uptime to two digits, no load time. Silver of
    finer steps is counted by the hour."""
    silver = silver.withColumn("hour_bucket", hour_bucket(F.col("hour_bucket")))
    return fleet_metrics(silver, uptime_digits=2, count_rows=count_rows)


def gold_history(silver: DataFrame, batch: str = "batch_id", load_ts: str = "load_ts") -> DataFrame:
    """KPI rows each load batch would merge: computed from that batch's rows alone."""
    batch_time = F.max(load_ts).alias("loaded_at")
    rows = fleet_metrics(silver, extra_keys=(batch,), extra_values=(batch_time,))
    return rows.select(*GOLD.names, batch)


def site_summary(metrics: DataFrame) -> DataFrame:
    """Mean of the hourly temperatures and number of hours per site."""
    return metrics.groupBy("site_id").agg(
        F.avg("avg_temperature").alias("avg_temperature"),
        F.count(F.lit(1)).alias("record_count"),
    )


# Columns of silver whose mean over rows is a KPI, and those that are added up.
_MEANS = ["avg_temperature", "avg_humidity", "avg_battery_pct", "uptime_hours"]
_SUMS = ["data_usage_mb", "total_alerts", "alert_temp_count", "alert_humidity_count", "total_records"]


def fleet_partials(silver: DataFrame) -> DataFrame:
    """What the KPIs are made of, per hour, site and device: sums, counts and extremes that
    :func:`add_fleet_partials` adds up over any split of the silver rows."""
    warm, humid = F.col("has_temperature_alert"), F.col("has_humidity_alert")
    return (
        silver.withColumnRenamed("hour_bucket", "analysis_hour")
        .groupBy(*GOLD_KEYS, "device_id")
        .agg(
            *[F.sum(c).alias(f"sum_{c}") for c in _MEANS],
            *[F.count(c).alias(f"n_{c}") for c in _MEANS],
            F.max("max_temperature").alias("max_temperature"),
            F.min("min_temperature").alias("min_temperature"),
            F.sum("data_usage_mb").alias("data_usage_mb"),
            F.count_if(warm | humid).alias("total_alerts"),
            F.count_if(warm).alias("alert_temp_count"),
            F.count_if(humid).alias("alert_humidity_count"),
            F.sum("record_count").alias("total_records"),
        )
    )


def _added(partials: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    added = [f"{kind}_{c}" for kind in ("sum", "n") for c in _MEANS] + _SUMS
    return partials.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in added],
        F.max("max_temperature").alias("max_temperature"),
        F.min("min_temperature").alias("min_temperature"),
        *more,
    )


def add_fleet_partials(partials: DataFrame) -> DataFrame:
    """Partial rows of the same hour, site and device to one."""
    return _added(partials, [*GOLD_KEYS, "device_id"])


def finish_fleet(partials: DataFrame, loaded_at: TimeLike | None = None) -> DataFrame:
    """Gold rows from partial rows, one of which stands for each device."""
    devices = F.count("device_id").alias("active_devices")
    sites = _added(partials, GOLD_KEYS, devices)

    def mean(name: str, digits: int) -> Column:
        return round_fixed(F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}")), digits)

    stamp = utc_now() if loaded_at is None else as_ntz(loaded_at)
    return sites.select(
        *GOLD_KEYS,
        "active_devices",
        mean("avg_temperature", 2).alias("avg_temperature"),
        round_fixed(F.col("max_temperature"), 2).alias("max_temperature"),
        round_fixed(F.col("min_temperature"), 2).alias("min_temperature"),
        mean("avg_humidity", 2).alias("avg_humidity"),
        mean("avg_battery_pct", 2).alias("avg_battery_pct"),
        round_fixed(F.col("data_usage_mb"), 2).alias("total_data_usage_mb"),
        mean("uptime_hours", 1).alias("avg_uptime_hours"),
        *_SUMS[1:],
        stamp.alias("loaded_at"),
    ).select(*GOLD.names)
