"""Z-score anomaly flags per site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.operators.join_back import BROADCAST_ROWS, join_groups


def zscore_anomalies(
    silver: DataFrame,
    threshold: float = 2,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Distance of each hourly temperature from its site's mean in standard deviations.

    A window over a site would put the whole site into one task. Mean and deviation are
    aggregated instead and joined back. The score is NULL, and so is the flag, where the
    deviation is zero or undefined.
    """
    stats = silver.groupBy("site_id").agg(
        F.avg("avg_temperature").alias("_mean"),
        F.nullif(F.stddev_samp("avg_temperature"), F.lit(0.0)).alias("_deviation"),
    )
    rows = silver.select("device_id", "site_id", "hour_bucket", "avg_temperature")
    joined = join_groups(rows, stats, "site_id", ["device_id", "hour_bucket"], broadcast_rows)
    score = F.try_divide(F.col("avg_temperature") - F.col("_mean"), F.col("_deviation"))
    return joined.select(
        "device_id",
        "site_id",
        "hour_bucket",
        "avg_temperature",
        score.alias("z_score"),
        (F.abs(score) > threshold).alias("is_anomaly"),
    )
