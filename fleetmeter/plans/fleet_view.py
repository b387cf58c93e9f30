"""The event table seen as fleet telemetry.

Every event becomes one reading of one of 20 devices at one of five sites. Some readings
have no temperature, some a time that cannot be parsed, and the readings arrive in three
load batches an hour apart. The view is a projection: it moves no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.operators.gold import gold_history
from fleetmeter.operators.silver import silver_by_batch
from fleetmeter.schemas import EVENTS, PAYLOAD_FIELDS

_BAD_TIME = "event_id % 101 = 0"

_COLUMNS = [
    "event_id AS reading_id",
    "concat('dev-', lpad(cast(user_id % 20 + 1 AS string), 3, '0')) AS device_id",
    """CASE event_type WHEN 'click' THEN 'Factory_A' WHEN 'view' THEN 'Factory_B'
       WHEN 'purchase' THEN 'Railway_1' WHEN 'error' THEN 'Cold_Storage'
       ELSE 'Data_Center' END AS site_id""",
    f"CASE WHEN {_BAD_TIME} THEN '1/15/2015 19:05' ELSE cast(ts AS string) END AS timestamp",
    f"CASE WHEN {_BAD_TIME} THEN NULL ELSE ts END AS reading_time",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE value / 10 END AS temperature",
    "cast(regexp_extract(props, '[0-9]+', 0) AS double) AS humidity",
    "20 + cast(event_id * 37 % 801 AS double) / 10 AS battery_pct",
    "cast(-90 + event_id * 13 % 51 AS int) AS signal_rssi",
    "1000 + cast(event_id * 7919 % 490001 AS double) / 10 AS uptime_hours",
    "cast(event_id * 31 % 491 + 10 AS double) / 100 AS data_usage_mb",
    """CASE event_id % 32 WHEN 0 THEN 'TEMP_HIGH' WHEN 8 THEN 'SIGNAL_WEAK'
       WHEN 16 THEN 'BATTERY_LOW' WHEN 24 THEN 'UPTIME_CRITICAL' END AS alert_type""",
    "CASE event_id % 16 WHEN 0 THEN 'HIGH' WHEN 8 THEN 'LOW' END AS alert_severity",
    "cast(event_id % 3 AS int) AS batch_id",
    "concat('iot_batch_2024020', event_id % 3, '.json') AS file_name",
    """CASE event_id % 3 WHEN 0 THEN timestamp_ntz'2024-02-01 00:00:00'
       WHEN 1 THEN timestamp_ntz'2024-02-01 01:00:00'
       ELSE timestamp_ntz'2024-02-01 02:00:00' END AS loaded_at""",
]

BATCH_TIMES = ["2024-02-01 00:00:00", "2024-02-01 01:00:00", "2024-02-01 02:00:00"]


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload fields as they are delivered, with batch, file and load time."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr(*_COLUMNS).drop("reading_time")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed readings the payloads give, ready for the silver operators.

    The time is the event's own, which is what parsing its text gives back.
    """
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr(*_COLUMNS).drop("timestamp")


def payload_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reading as JSON text: ``(reading_id, raw, file_name, batch_id, loaded_at)``."""
    rows = telemetry(spark, sf_dir)
    return rows.select("reading_id", payload_text().alias("raw"), "file_name", "batch_id", "loaded_at")


def payload_text() -> Column:
    """A row of telemetry as JSON text."""
    return F.to_json(F.struct("reading_id", *PAYLOAD_FIELDS), {"ignoreNullFields": "false"})


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table after the three load batches, with ``batch_id``."""
    return silver_by_batch(readings(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI versions the three load batches merged."""
    return gold_history(silver(spark, sf_dir))
