"""Declared schemas of the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Payload field names and the type each is read as.
PAYLOAD_FIELDS = {
    "device_id": "string",
    "site_id": "string",
    "timestamp": "string",
    "temperature": "double",
    "humidity": "double",
    "battery_pct": "double",
    "signal_rssi": "int",
    "uptime_hours": "double",
    "data_usage_mb": "double",
    "alert_type": "string",
    "alert_severity": "string",
}


TEXT, COUNT, FLOAT, FLAG = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
TIME, DAY, NUMBER, JSON = T.TimestampNTZType(), T.DateType(), T.IntegerType(), T.VariantType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, type_) for name, type_ in columns.items()])


# The event table the fleet view is taken from.
EVENTS = _struct(
    event_id=COUNT, ts=TIME, user_id=COUNT, event_type=TEXT, value=FLOAT, props=TEXT
)

BRONZE = _struct(json_data=JSON, file_name=TEXT, loaded_at=TIME)

# What an ingest job stores: good rows (ok = true) and quarantined rows (ok = false).
LOADS = _struct(json_data=JSON, raw=TEXT, error=TEXT, file_name=TEXT, loaded_at=TIME, ok=FLAG)

# One row per file and load: what a load found in it.
LOAD_LOG = _struct(
    file_name=TEXT, load_id=TEXT, status=TEXT, row_count=COUNT, error_count=COUNT,
    first_error_message=TEXT, loaded_at=TIME,
)

SILVER = _struct(
    device_id=TEXT,
    site_id=TEXT,
    hour_bucket=TIME,
    avg_temperature=FLOAT,
    min_temperature=FLOAT,
    max_temperature=FLOAT,
    avg_humidity=FLOAT,
    min_humidity=FLOAT,
    max_humidity=FLOAT,
    avg_battery_pct=FLOAT,
    signal_rssi_avg=NUMBER,
    uptime_hours=FLOAT,
    data_usage_mb=FLOAT,
    record_count=COUNT,
    has_temperature_alert=FLAG,
    has_humidity_alert=FLAG,
    load_ts=TIME,
)

# Sums and non-null counts of one hour's readings, which add up exactly.
SILVER_PARTIALS = _struct(
    device_id=TEXT,
    site_id=TEXT,
    hour_bucket=TIME,
    sum_temperature=FLOAT,
    n_temperature=COUNT,
    min_temperature=FLOAT,
    max_temperature=FLOAT,
    sum_humidity=FLOAT,
    n_humidity=COUNT,
    min_humidity=FLOAT,
    max_humidity=FLOAT,
    sum_battery_pct=FLOAT,
    n_battery_pct=COUNT,
    sum_signal_rssi=COUNT,
    n_signal_rssi=COUNT,
    uptime_hours=FLOAT,
    data_usage_mb=FLOAT,
    record_count=COUNT,
    has_temperature_alert=FLAG,
    has_humidity_alert=FLAG,
)

GOLD = _struct(
    analysis_hour=TIME,
    site_id=TEXT,
    active_devices=COUNT,
    avg_temperature=FLOAT,
    max_temperature=FLOAT,
    min_temperature=FLOAT,
    avg_humidity=FLOAT,
    avg_battery_pct=FLOAT,
    total_data_usage_mb=FLOAT,
    avg_uptime_hours=FLOAT,
    total_alerts=COUNT,
    alert_temp_count=COUNT,
    alert_humidity_count=COUNT,
    total_records=COUNT,
    loaded_at=TIME,
)

# What gold rows are made of, per device: the stored state of the NULL hour.
GOLD_PARTIALS = _struct(
    analysis_hour=TIME,
    site_id=TEXT,
    device_id=TEXT,
    sum_avg_temperature=FLOAT,
    sum_avg_humidity=FLOAT,
    sum_avg_battery_pct=FLOAT,
    sum_uptime_hours=FLOAT,
    n_avg_temperature=COUNT,
    n_avg_humidity=COUNT,
    n_avg_battery_pct=COUNT,
    n_uptime_hours=COUNT,
    data_usage_mb=FLOAT,
    total_alerts=COUNT,
    alert_temp_count=COUNT,
    alert_humidity_count=COUNT,
    total_records=COUNT,
    max_temperature=FLOAT,
    min_temperature=FLOAT,
    batch_id=COUNT,
)

SILVER_KEYS = ["device_id", "site_id", "hour_bucket"]
GOLD_KEYS = ["analysis_hour", "site_id"]

# Markers of committed batches: the folder of each, and the batches it was made from.
COMMITS = T.StructType(
    [
        *_struct(commit_id=TEXT, part=TEXT, committed_at=TIME, source=TEXT),
        T.StructField("consumed", T.ArrayType(TEXT)),
    ]
)

# Stored forms, with the folder columns of the tables.
SILVER_BY_DAY = T.StructType(SILVER.fields + _struct(day=DAY).fields)
SILVER_STORED = T.StructType(SILVER.fields + _struct(batch_id=COUNT, day=DAY).fields)
GOLD_HISTORY = T.StructType(GOLD.fields + _struct(batch_id=COUNT).fields)
