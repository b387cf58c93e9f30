"""Alert rules and column masking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.values import mask_text

# Roles that see file names in clear.
CLEAR_ROLES = ("IOT_ENGINEER", "SYSADMIN", "ACCOUNTADMIN")

# The cold-chain rule.
COLD_SITE = "Cold_Storage"
COLD_LIMIT = 8
BREACH_TYPE = "TEMP_HIGH"
BREACH_SEVERITY = "HIGH"


def mask_file_name(bronze: DataFrame, role: str, column: str = "file_name") -> DataFrame:
    """The table as a role may see it: file names masked unless the role is trusted."""
    if role.upper() in CLEAR_ROLES:
        return bronze
    return bronze.withColumn(column, mask_text(F.col(column)))


def threshold_alerts(gold: DataFrame, threshold: int) -> DataFrame:
    """One alert row per site and hour with more alerts than the threshold."""
    return gold.filter(F.col("total_alerts") > threshold).select(
        "analysis_hour", "site_id", "total_alerts", F.lit(threshold).alias("threshold")
    )


def apply_cold_chain_rule(
    readings: DataFrame, site_id: str = COLD_SITE, limit: float = COLD_LIMIT
) -> DataFrame:
    """Readings with the alert a too warm cold-storage reading must carry."""
    breach = (F.col("site_id") == site_id) & (F.col("temperature") > limit)
    return readings.withColumns(
        {
            "alert_type": F.when(breach, BREACH_TYPE).otherwise(F.col("alert_type")),
            "alert_severity": F.when(breach, BREACH_SEVERITY).otherwise(F.col("alert_severity")),
        }
    )


def reported_alerts(readings: DataFrame) -> DataFrame:
    """Number of device-reported alerts by site, type and severity."""
    alerts = readings.filter(F.col("alert_type").isNotNull())
    return alerts.groupBy("site_id", "alert_type", "alert_severity").agg(
        F.count(F.lit(1)).alias("alerts")
    )


def reported_alert_totals(readings: DataFrame, site_id: str = COLD_SITE) -> DataFrame:
    """One row: readings, alerts, and alerts of the cold-storage site."""
    has_alert = F.col("alert_type").isNotNull()
    return readings.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(has_alert).alias("total_alerts"),
        F.count_if(has_alert & (F.col("site_id") == site_id)).alias("cold_storage_alerts"),
    )
