"""Dashboard and health reports over the layers.

Reports look back from ``as_of``, not from the clock. It may be a column, for example a
scalar subquery, so that a report stays one lazy query.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.times import (
    TimeLike,
    as_ntz,
    hour_bucket,
    minutes_between,
    within_last,
)
from fleetmeter.functions.values import round_fixed
from fleetmeter.operators.history import at_time


def latest_time(table: DataFrame, column: str) -> Column:
    """The newest time in a table as a scalar subquery."""
    return table.agg(F.max(column)).scalar()


def _last_hour(as_of: TimeLike) -> Column:
    return within_last(F.col("analysis_hour"), as_of, 1)


def _last_day(as_of: TimeLike) -> Column:
    return within_last(F.col("analysis_hour"), as_of, 24)


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def active_devices(gold: DataFrame, as_of: TimeLike) -> DataFrame:
    """Device counts of the last hour added over sites and hours; 0 when there are none."""
    total = _or_zero(F.sum("active_devices")).alias("total")
    return gold.filter(_last_hour(as_of)).agg(total)


def total_alerts(gold: DataFrame, as_of: TimeLike) -> DataFrame:
    """Alerts of the last hour."""
    return gold.filter(_last_hour(as_of)).agg(_or_zero(F.sum("total_alerts")).alias("total"))


def average_uptime(gold: DataFrame, as_of: TimeLike) -> DataFrame:
    """Mean of the uptime values of the last 24 hours."""
    value = _or_zero(round_fixed(F.avg("avg_uptime_hours"), 1)).alias("val")
    return gold.filter(_last_day(as_of)).agg(value)


def data_usage(gold: DataFrame, as_of: TimeLike) -> DataFrame:
    """Data volume of the last 24 hours."""
    value = _or_zero(round_fixed(F.sum("total_data_usage_mb"), 1)).alias("mb")
    return gold.filter(_last_day(as_of)).agg(value)


def average_temperature(gold: DataFrame, as_of: TimeLike) -> DataFrame:
    """Mean of the temperatures of the last hour."""
    value = _or_zero(round_fixed(F.avg("avg_temperature"), 1)).alias("val")
    return gold.filter(_last_hour(as_of)).agg(value)


def kpi_cards(gold: DataFrame, as_of: TimeLike) -> DataFrame:
    """All five dashboard numbers from one scan of the last 24 hours."""
    recent = gold.filter(_last_day(as_of)).withColumn("last_hour", _last_hour(as_of))

    def hour_only(name: str) -> Column:
        return F.when(F.col("last_hour"), F.col(name))

    return recent.agg(
        _or_zero(F.sum(hour_only("active_devices"))).alias("active_devices"),
        _or_zero(F.sum(hour_only("total_alerts"))).alias("total_alerts"),
        _or_zero(round_fixed(F.avg("avg_uptime_hours"), 1)).alias("avg_uptime_hours"),
        _or_zero(round_fixed(F.sum("total_data_usage_mb"), 1)).alias("data_usage_mb"),
        _or_zero(round_fixed(F.avg(hour_only("avg_temperature")), 1)).alias("avg_temperature"),
    )


def temperature_by_site(gold: DataFrame) -> DataFrame:
    """Mean temperature per site over all time, warmest first."""
    per_site = gold.groupBy(F.col("site_id").cast("string").alias("site_id")).agg(
        round_fixed(F.avg("avg_temperature"), 1).alias("avg_temp")
    )
    return per_site.orderBy(F.col("avg_temp").desc_nulls_first())


def alert_timeline(gold: DataFrame) -> DataFrame:
    """Alerts per hour over all sites: total, by temperature, by humidity."""
    per_hour = gold.groupBy("analysis_hour").agg(
        F.sum("total_alerts").alias("total_alerts"),
        F.sum("alert_temp_count").alias("temp_alerts"),
        F.sum("alert_humidity_count").alias("humidity_alerts"),
    )
    return per_hour.orderBy(F.col("analysis_hour").asc_nulls_last())


def alert_series(gold: DataFrame) -> DataFrame:
    """The two stacked series of the alert chart in long form."""
    per_hour = gold.groupBy("analysis_hour").agg(
        F.sum("alert_temp_count").alias("temp_alerts"),
        F.sum("alert_humidity_count").alias("humidity_alerts"),
    )
    return per_hour.unpivot(
        ["analysis_hour"], ["temp_alerts", "humidity_alerts"], "alert_kind", "alerts"
    )


def latest_metrics(gold: DataFrame, n: int = 20) -> DataFrame:
    """The newest site rows. A NULL hour sorts as the largest value."""
    order = [F.col("analysis_hour").desc_nulls_first(), F.col("site_id").asc_nulls_last()]
    return gold.orderBy(*order).limit(n)


def latest_bronze(bronze: DataFrame, n: int, *tie_break: str) -> DataFrame:
    """The rows loaded last."""
    order = [F.col("loaded_at").desc_nulls_first(), *[F.col(c) for c in tie_break]]
    return bronze.orderBy(*order).limit(n)


def silver_sites(silver: DataFrame) -> DataFrame:
    """Rows and newest hour per site."""
    per_site = silver.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("records"), F.max("hour_bucket").alias("latest_hour")
    )
    return per_site.orderBy("site_id")


def gold_status(gold: DataFrame) -> DataFrame:
    """Row count and newest hour of a KPI table."""
    return gold.agg(
        F.count(F.lit(1)).alias("row_count"), F.max("analysis_hour").alias("latest_hour")
    )


def layer_row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """``(layer, rows)`` for each table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, table in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("layer")


def report_at(
    history: DataFrame, keys: list[str], when: TimeLike, null_safe: bool = False
) -> DataFrame:
    """Per-site report from the KPI table as it was at a time, most alerts first."""
    report = (
        at_time(history, keys, when, null_safe)
        .groupBy("site_id")
        .agg(
            F.sum("active_devices").alias("total_devices"),
            F.sum("total_alerts").alias("total_alerts"),
            round_fixed(F.avg("avg_temperature"), 2).alias("avg_temp"),
        )
    )
    return report.orderBy(F.col("total_alerts").desc_nulls_first())


def freshness_lag(table: DataFrame, now: TimeLike, column: str = "load_ts") -> DataFrame:
    """How many minutes the newest row of a table lies behind ``now``."""
    newest = table.agg(F.max(column).alias("data_timestamp"))
    lag = minutes_between(F.col("data_timestamp"), as_ntz(now))
    return newest.select("data_timestamp", lag.alias("current_lag_minutes"))


def loading_status(
    bronze: DataFrame, last_consumed: TimeLike, as_of: TimeLike
) -> DataFrame:
    """One row: whether unread rows wait, and how many were loaded since the hour began."""
    loaded = F.col("loaded_at")
    return bronze.agg(
        F.coalesce(F.max(loaded) > as_ntz(last_consumed), F.lit(False)).alias("stream_ready"),
        F.count_if(loaded >= hour_bucket(as_ntz(as_of))).alias("bronze_rows_hour"),
    )


def layer_sync_check(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Number of hour-and-site groups in silver and in gold.

    Both sides are reduced to their distinct keys before the full join, so the join never
    multiplies rows however many devices a site has. A group whose hour or site is NULL
    has no name and is not counted.
    """

    def groups(table: DataFrame, hour: str, name: str) -> DataFrame:
        keys = table.select(F.col(hour).alias("hour"), "site_id").distinct()
        label = F.concat(F.col("hour").cast("string"), F.col("site_id"))
        return keys.select(label.alias(name)).filter(F.col(name).isNotNull()).distinct()

    left = groups(silver, "hour_bucket", "silver_group")
    right = groups(gold, "analysis_hour", "gold_group")
    joined = left.join(right, F.col("silver_group") == F.col("gold_group"), "full")
    return joined.agg(
        F.count("silver_group").alias("silver_groups"),
        F.count("gold_group").alias("gold_groups"),
    )


def gold_compare(dynamic: DataFrame, merged: DataFrame) -> DataFrame:
    """Alert counts of two KPI tables side by side; a one-sided row has no difference."""
    joined = dynamic.alias("d").join(
        merged.alias("g"),
        (F.col("d.analysis_hour") == F.col("g.analysis_hour"))
        & (F.col("d.site_id") == F.col("g.site_id")),
        "full",
    )
    dynamic_alerts, original_alerts = F.col("d.total_alerts"), F.col("g.total_alerts")
    return joined.select(
        F.col("d.analysis_hour").alias("analysis_hour"),
        F.col("d.site_id").alias("site_id"),
        dynamic_alerts.alias("dynamic_alerts"),
        original_alerts.alias("original_alerts"),
        (dynamic_alerts - original_alerts).alias("diff"),
    ).orderBy("analysis_hour", "site_id")
