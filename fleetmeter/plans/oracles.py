"""The same results stated as SQL over the given tables, for an independent check.

The texts share only the input view. Averages are taken straight from the readings, merges
are written with NOT EXISTS and point-in-time reads with row numbers, so they do not follow
the way the Spark operators compute.
"""

from __future__ import annotations

_TELEMETRY = """
telemetry AS (
  SELECT event_id AS reading_id,
    'dev-' || lpad(CAST(user_id % 20 + 1 AS VARCHAR), 3, '0') AS device_id,
    CASE event_type WHEN 'click' THEN 'Factory_A' WHEN 'view' THEN 'Factory_B'
      WHEN 'purchase' THEN 'Railway_1' WHEN 'error' THEN 'Cold_Storage'
      ELSE 'Data_Center' END AS site_id,
    CASE WHEN event_id % 101 = 0 THEN '1/15/2015 19:05'
      ELSE CAST(ts AS VARCHAR) END AS "timestamp",
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE value / 10 END AS temperature,
    CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) AS humidity,
    20 + CAST(event_id * 37 % 801 AS DOUBLE) / 10 AS battery_pct,
    CAST(-90 + event_id * 13 % 51 AS INTEGER) AS signal_rssi,
    1000 + CAST(event_id * 7919 % 490001 AS DOUBLE) / 10 AS uptime_hours,
    CAST(event_id * 31 % 491 + 10 AS DOUBLE) / 100 AS data_usage_mb,
    CASE event_id % 32 WHEN 0 THEN 'TEMP_HIGH' WHEN 8 THEN 'SIGNAL_WEAK'
      WHEN 16 THEN 'BATTERY_LOW' WHEN 24 THEN 'UPTIME_CRITICAL' END AS alert_type,
    CASE event_id % 16 WHEN 0 THEN 'HIGH' WHEN 8 THEN 'LOW' END AS alert_severity,
    CAST(event_id % 3 AS INTEGER) AS batch_id,
    'iot_batch_2024020' || CAST(event_id % 3 AS VARCHAR) || '.json' AS file_name,
    TIMESTAMP '2024-02-01 00:00:00' + (event_id % 3) * INTERVAL 1 HOUR AS loaded_at,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS reading_time
  FROM events
)"""


def _round(x: str, digits: int) -> str:
    """Rounding with the tie step, and without a negative zero."""
    return f"(round(({x}) + sign({x}) * 1e-9, {digits}) + 0.0)"


_SILVER_KEYS = "device_id, site_id, date_trunc('hour', reading_time)"

_SILVER_VALUES = """
    avg(temperature) AS avg_temperature, min(temperature) AS min_temperature,
    max(temperature) AS max_temperature, avg(humidity) AS avg_humidity,
    min(humidity) AS min_humidity, max(humidity) AS max_humidity,
    avg(battery_pct) AS avg_battery_pct,
    CAST(round(avg(signal_rssi)) AS INTEGER) AS signal_rssi_avg,
    max(uptime_hours) AS uptime_hours, sum(data_usage_mb) AS data_usage_mb,
    count(*) AS record_count,
    bool_or(coalesce(temperature < 2 OR temperature > 8, FALSE)) AS has_temperature_alert,
    bool_or(coalesce(humidity < 30 OR humidity > 70, FALSE)) AS has_humidity_alert"""

# Silver as the three load batches leave it.
_SILVER = f"""
silver AS (
  SELECT device_id, site_id, date_trunc('hour', reading_time) AS hour_bucket,
    {_SILVER_VALUES}, loaded_at AS load_ts, batch_id
  FROM telemetry GROUP BY {_SILVER_KEYS}, loaded_at, batch_id
)"""


def _metrics(uptime_digits: int = 1, records: str = "sum(record_count)") -> str:
    return f"""
    count(DISTINCT device_id) AS active_devices,
    {_round("avg(avg_temperature)", 2)} AS avg_temperature,
    {_round("max(max_temperature)", 2)} AS max_temperature,
    {_round("min(min_temperature)", 2)} AS min_temperature,
    {_round("avg(avg_humidity)", 2)} AS avg_humidity,
    {_round("avg(avg_battery_pct)", 2)} AS avg_battery_pct,
    {_round("sum(data_usage_mb)", 2)} AS total_data_usage_mb,
    {_round("avg(uptime_hours)", uptime_digits)} AS avg_uptime_hours,
    CAST(sum(CASE WHEN has_temperature_alert OR has_humidity_alert THEN 1 ELSE 0 END)
      AS BIGINT) AS total_alerts,
    CAST(sum(CASE WHEN has_temperature_alert THEN 1 ELSE 0 END) AS BIGINT) AS alert_temp_count,
    CAST(sum(CASE WHEN has_humidity_alert THEN 1 ELSE 0 END) AS BIGINT) AS alert_humidity_count,
    CAST({records} AS BIGINT) AS total_records"""


_GOLD = f"""
gold AS (
  SELECT hour_bucket AS analysis_hour, site_id, {_metrics()} FROM silver GROUP BY 1, 2
)"""
_DYNAMIC = f"""
dynamic AS (
  SELECT hour_bucket AS analysis_hour, site_id, {_metrics(2, "count(*)")}
  FROM silver GROUP BY 1, 2
)"""
_HISTORY = f"""
history AS (
  SELECT hour_bucket AS analysis_hour, site_id, {_metrics()}, load_ts AS loaded_at, batch_id
  FROM silver GROUP BY hour_bucket, site_id, load_ts, batch_id
)"""

_VALUES = [
    "active_devices", "avg_temperature", "max_temperature", "min_temperature", "avg_humidity",
    "avg_battery_pct", "total_data_usage_mb", "avg_uptime_hours", "total_alerts",
    "alert_temp_count", "alert_humidity_count", "total_records",
]
_GOLD_COLUMNS = ", ".join(["analysis_hour", "site_id", *_VALUES, "loaded_at"])


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_T = _with(_TELEMETRY)
_S = _with(_TELEMETRY, _SILVER)
_G = _with(_TELEMETRY, _SILVER, _GOLD)
_D = _with(_TELEMETRY, _SILVER, _DYNAMIC)
_H = _with(_TELEMETRY, _SILVER, _HISTORY)


def _state(condition: str) -> str:
    """The newest version per key among the versions that meet a condition."""
    return f"""(SELECT * EXCLUDE (version_rank) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY analysis_hour, site_id, CASE WHEN analysis_hour IS NULL THEN batch_id END
        ORDER BY loaded_at DESC, batch_id DESC) AS version_rank
      FROM history WHERE {condition}) WHERE version_rank = 1)"""


_NOW_STATE = _state("loaded_at <= TIMESTAMP '2024-02-01 02:30:00'")


# Versions that the delete of a site at 01:30 leaves.
_NOT_DELETED = "site_id <> 'Railway_1' OR analysis_hour IS NULL OR batch_id = 2"

_CHANGED = """
changed AS (
  SELECT * REPLACE (
    CASE WHEN batch_id = 1 AND device_id = 'dev-003' THEN avg_temperature + 1 ELSE avg_temperature END AS avg_temperature,
    CASE WHEN batch_id = 1 AND device_id = 'dev-003' THEN min_temperature + 1 ELSE min_temperature END AS min_temperature,
    CASE WHEN batch_id = 1 AND device_id = 'dev-003' THEN max_temperature + 1 ELSE max_temperature END AS max_temperature)
  FROM silver WHERE NOT (batch_id = 0 AND device_id = 'dev-007'))"""


def _at(time: str) -> str:
    return f"loaded_at <= TIMESTAMP '{time}'"


def _merge(target: str, source: str) -> str:
    return f"""SELECT {_GOLD_COLUMNS} FROM {target} t WHERE NOT EXISTS (
      SELECT 1 FROM {source} s
      WHERE s.analysis_hour = t.analysis_hour AND s.site_id = t.site_id)
    UNION ALL SELECT {_GOLD_COLUMNS} FROM {source}"""


_MERGED = f"""
m0 AS (SELECT {_GOLD_COLUMNS} FROM history WHERE batch_id = 0),
h1 AS (SELECT {_GOLD_COLUMNS} FROM history WHERE batch_id = 1),
h2 AS (SELECT {_GOLD_COLUMNS} FROM history WHERE batch_id = 2),
m1 AS ({_merge("m0", "h1")}),
merged AS ({_merge("m1", "h2")})"""
_M = _with(_TELEMETRY, _SILVER, _HISTORY, _MERGED)

_SILVER_FLOATS = {
    "avg_temperature", "min_temperature", "max_temperature", "avg_humidity", "min_humidity",
    "max_humidity", "avg_battery_pct", "uptime_hours", "data_usage_mb",
}
_SILVER_COLUMNS = [
    "device_id", "site_id", "hour_bucket", "avg_temperature", "min_temperature",
    "max_temperature", "avg_humidity", "min_humidity", "max_humidity", "avg_battery_pct",
    "signal_rssi_avg", "uptime_hours", "data_usage_mb", "record_count",
    "has_temperature_alert", "has_humidity_alert", "load_ts",
]
_SILVER_OUT = ", ".join(
    f"{_round(c, 6)} AS {c}" if c in _SILVER_FLOATS else c for c in _SILVER_COLUMNS
)
_SILVER_ROWS = _S + f"SELECT {_SILVER_OUT} FROM silver"

_ONE_BATCH = f"""{_with(_TELEMETRY, f'''
silver AS (
  SELECT device_id, site_id, date_trunc('hour', reading_time) AS hour_bucket,
    {_SILVER_VALUES}, TIMESTAMP '2024-02-01 02:30:00' AS load_ts
  FROM telemetry GROUP BY {_SILVER_KEYS}
)''')} SELECT {_SILVER_OUT} FROM silver"""

_LOADED = (
    _T + "SELECT reading_id, device_id, site_id, temperature, signal_rssi,"
    " 'folder=b' || batch_id AS folder, TIMESTAMP '2024-02-01 02:30:00' AS loaded_at FROM telemetry"
)

_LAST_HOUR = "(SELECT max(date_trunc('hour', reading_time)) FROM telemetry)"
_IN_HOUR = f"analysis_hour > {_LAST_HOUR} - INTERVAL 1 HOUR"
_IN_DAY = f"analysis_hour > {_LAST_HOUR} - INTERVAL 24 HOUR"


def _long_sum(column: str, condition: str) -> str:
    return f"CAST(coalesce((SELECT sum({column}) FROM gold WHERE {condition}), 0) AS BIGINT)"


def _float_kpi(aggregate: str, condition: str) -> str:
    return (
        f"CAST(coalesce((SELECT {_round(aggregate, 1)} FROM gold WHERE {condition}), 0) AS DOUBLE)"
    )


_KPI = {
    "active_devices": _long_sum("active_devices", _IN_HOUR),
    "total_alerts": _long_sum("total_alerts", _IN_HOUR),
    "avg_uptime_hours": _float_kpi("avg(avg_uptime_hours)", _IN_DAY),
    "data_usage_mb": _float_kpi("sum(total_data_usage_mb)", _IN_DAY),
    "avg_temperature": _float_kpi("avg(avg_temperature)", _IN_HOUR),
}

_STATES = f"""
now_state AS (SELECT * FROM {_NOW_STATE}),
old_state AS (SELECT * FROM {_state(_at("2024-02-01 01:30:00"))})"""

_BAD = "(reading_id % 89 = 0 OR batch_id = 2)"

_PAIRS = ", ".join(f"n.{c} AS new_{c}, o.{c} AS old_{c}" for c in _VALUES)
_DIFFERS = " OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in _VALUES)

# Runs of readings above 8 degrees: of equal state, the two numberings differ by a fixed amount.
_EPISODES = """
, judged AS (
  SELECT device_id, reading_time, reading_id, temperature, temperature > 8 AS breach,
    row_number() OVER (PARTITION BY device_id ORDER BY reading_time, reading_id)
      - row_number() OVER (PARTITION BY device_id, temperature > 8 ORDER BY reading_time, reading_id) AS run,
    row_number() OVER (PARTITION BY device_id ORDER BY reading_time DESC, reading_id DESC) = 1 AS newest
  FROM telemetry WHERE reading_time IS NOT NULL AND temperature IS NOT NULL),
episodes AS (
  SELECT device_id, min(reading_time) AS first_at, max(reading_time) AS last_at,
    max(temperature) AS peak, count(*) AS readings, bool_or(newest) AS is_open
  FROM judged WHERE breach GROUP BY device_id, run)
"""

ORACLES: dict[str, str] = {
    # sources
    "bronze_parse_json": _T + """
SELECT reading_id, device_id, site_id, file_name,
  TIMESTAMP '2024-02-01 02:30:00' AS loaded_at
FROM telemetry, range(CASE WHEN reading_id % 3 = 1 THEN 2 ELSE 1 END)""",
    "null_if_tokens": _T + "SELECT reading_id, alert_type FROM telemetry",
    "bronze_load": _LOADED,
    "bronze_stream": _LOADED,
    "bronze_parse_files": _T + """
SELECT file, ok, CAST(sum(n) AS BIGINT) AS "rows" FROM (
  SELECT reading_id // 500 AS file,
    CASE reading_id // 500 % 6 WHEN 5 THEN FALSE WHEN 4 THEN count(*) = 1 ELSE TRUE END AS ok,
    CASE WHEN reading_id // 500 % 6 < 2 THEN count(*) ELSE 1 END AS n
  FROM telemetry GROUP BY 1)
GROUP BY file, ok""",
    "load_new_files_only": _LOADED + " WHERE batch_id <> 0",
    "stage_peek": "SELECT CAST(10 AS BIGINT) AS lines, CAST(10 AS BIGINT) AS lines_of_their_files",
    "array_salvage": _T + """,
placed AS (SELECT reading_id, reading_id // 500 AS file,
    row_number() OVER (PARTITION BY reading_id // 500 ORDER BY reading_id) AS nth,
    count(*) OVER (PARTITION BY reading_id // 500) AS n FROM telemetry),
marked AS (SELECT file, reading_id, CASE file % 5 WHEN 1 THEN nth = n WHEN 3 THEN nth = least(n, 8)
    WHEN 4 THEN nth >= least(n, 251) ELSE FALSE END AS lost FROM placed)
SELECT file, reading_id, TRUE AS ok, CAST(0 AS BIGINT) AS held FROM marked WHERE NOT lost
UNION ALL SELECT file, -1, FALSE, count(*) FROM marked WHERE lost GROUP BY file""",
    "quarantine_bad_rows": _T + f"""
SELECT reading_id, file_name, 'not valid JSON' AS error, loaded_at FROM telemetry WHERE {_BAD}""",
    "load_history": _T + f"""
, loaded AS (
  SELECT file_name, loaded_at, {_BAD} AS bad FROM telemetry
  UNION ALL
  SELECT file_name, loaded_at + INTERVAL 1 HOUR, FALSE FROM telemetry WHERE batch_id = 0)
SELECT file_name,
  CASE WHEN count(*) FILTER (bad) = 0 THEN 'LOADED'
    WHEN count(*) FILTER (bad) = count(*) THEN 'LOAD_FAILED'
    ELSE 'PARTIALLY_LOADED' END AS status,
  count(*) AS row_count, count(*) FILTER (bad) AS error_count,
  CASE WHEN count(*) FILTER (bad) > 0 THEN 'not valid JSON' END AS first_error_message,
  loaded_at
FROM loaded
WHERE loaded_at > TIMESTAMP '2024-02-01 02:30:00' - INTERVAL 14 DAY
GROUP BY file_name, loaded_at""",
    "csv_raw_load": """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
  CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice
FROM lineitem""",
    "silver_append": _SILVER_ROWS,
    # projection, filter, scalar
    "variant_extract": _T + "SELECT * EXCLUDE (reading_id, batch_id) FROM telemetry",
    "try_timestamp": _T + """
SELECT reading_id, "timestamp" AS text, try_cast("timestamp" AS TIMESTAMP) AS reading_time
FROM telemetry""",
    "try_cast_clean": _T + """
SELECT reading_id, try_cast(text AS INTEGER) AS from_payload, try_cast(text AS INTEGER) AS from_text
FROM (SELECT reading_id, CASE WHEN reading_id % 10 = 0 THEN 'x'
  ELSE CAST(signal_rssi AS VARCHAR) END AS text FROM telemetry)""",
    "hour_bucket": _T + """
SELECT reading_id, date_trunc('hour', reading_time) AS hour_bucket,
  CAST(date_trunc('day', reading_time) AS TIMESTAMP) AS day_bucket FROM telemetry""",
    "mask_file_name": _T + """
SELECT reading_id, regexp_replace(file_name, '[a-zA-Z0-9]', '*', 'g') AS file_name,
  file_name AS engineer_view FROM telemetry""",
    "freshness_lag": _S + """
SELECT max(load_ts) AS data_timestamp,
  date_diff('minute', max(load_ts), TIMESTAMP '2024-02-01 02:41:59') AS current_lag_minutes
FROM silver""",
    "filter_patterns": _S + f"""
SELECT {_SILVER_OUT} FROM silver
WHERE hour_bucket BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 23:00:00'
  AND site_id = 'Factory_A' AND device_id = 'dev-001'""",
    # silver and gold
    "silver_hourly": _ONE_BATCH,
    "silver_compact": _ONE_BATCH,
    "silver_compact_stored": _S + f"""
SELECT {_SILVER_OUT} FROM (
  SELECT device_id, site_id, hour_bucket,
    sum(avg_temperature * record_count) / sum(CASE WHEN avg_temperature IS NOT NULL
      THEN record_count END) AS avg_temperature,
    min(min_temperature) AS min_temperature, max(max_temperature) AS max_temperature,
    sum(avg_humidity * record_count) / sum(record_count) AS avg_humidity,
    min(min_humidity) AS min_humidity, max(max_humidity) AS max_humidity,
    sum(avg_battery_pct * record_count) / sum(record_count) AS avg_battery_pct,
    CAST(round(sum(signal_rssi_avg * record_count) / sum(record_count)) AS INTEGER)
      AS signal_rssi_avg,
    max(uptime_hours) AS uptime_hours, sum(data_usage_mb) AS data_usage_mb,
    CAST(sum(record_count) AS BIGINT) AS record_count,
    bool_or(has_temperature_alert) AS has_temperature_alert,
    bool_or(has_humidity_alert) AS has_humidity_alert, max(load_ts) AS load_ts
  FROM silver GROUP BY device_id, site_id, hour_bucket)""",
    "silver_alert_flags": _T + f"""
SELECT device_id, site_id, date_trunc('hour', reading_time) AS hour_bucket,
  count(*) FILTER (temperature < 2 OR temperature > 8) > 0 AS has_temperature_alert,
  count(*) FILTER (humidity < 30 OR humidity > 70) > 0 AS has_humidity_alert
FROM telemetry GROUP BY {_SILVER_KEYS}""",
    "silver_sites": _S + """
SELECT site_id, count(*) AS records, max(hour_bucket) AS latest_hour FROM silver GROUP BY site_id""",
    "gold_fleet_metrics": _G + "SELECT * FROM gold",
    "gold_dynamic": _D + "SELECT * FROM dynamic",
    "gold_dynamic_records": _S + f"""
SELECT hour_bucket AS analysis_hour, site_id, {_metrics(2)} FROM silver GROUP BY 1, 2""",
    "gold_status": _D + """
SELECT count(*) AS row_count, max(analysis_hour) AS latest_hour FROM dynamic""",
    "site_summary": _G + f"""
SELECT site_id, {_round("avg(avg_temperature)", 6)} AS avg_temperature, count(*) AS record_count
FROM gold GROUP BY site_id""",
    "gold_merge_delta": _M + "SELECT * FROM merged",
    "gold_backfill": _with(_TELEMETRY, _SILVER, _HISTORY, _MERGED, _GOLD, """
source AS (SELECT *, TIMESTAMP '2024-02-01 02:30:00' AS loaded_at FROM gold)""")
    + _merge("merged", "source"),
    # history and change
    "as_of_timestamp": _H + f"SELECT * FROM {_state(_at('2024-02-01 01:30:00'))}",
    "as_of_offset": _H + f"SELECT * FROM {_state(_at('2024-02-01 00:30:00'))}",
    "before_timestamp": _H + f"SELECT * FROM {_state('batch_id < 1')}",
    "bronze_as_of_offset": _T + """
SELECT reading_id, file_name, loaded_at FROM telemetry WHERE batch_id IN (0, 1)""",
    "bronze_changes": _T + """
SELECT reading_id, file_name, loaded_at FROM telemetry WHERE batch_id = 2""",
    "before_batch": _H + f"SELECT * FROM {_state('batch_id < 2')}",
    "restore_subset": _with(_TELEMETRY, _SILVER, _HISTORY, _STATES) + """
SELECT n.* FROM now_state n
WHERE n.site_id <> 'Cold_Storage' OR NOT EXISTS (
  SELECT 1 FROM old_state o WHERE o.analysis_hour = n.analysis_hour AND o.site_id = n.site_id)
UNION ALL
SELECT o.* FROM old_state o WHERE o.site_id = 'Cold_Storage' AND o.analysis_hour IS NOT NULL""",
    "prune_history": _H + """
SELECT * FROM history h
WHERE loaded_at > TIMESTAMP '2024-02-01 01:30:00' OR NOT EXISTS (
  SELECT 1 FROM history later
  WHERE later.analysis_hour = h.analysis_hour AND later.site_id = h.site_id
    AND later.loaded_at > h.loaded_at
    AND later.loaded_at <= TIMESTAMP '2024-02-01 01:30:00')""",
    "current_table": _H + f"SELECT * EXCLUDE (batch_id) FROM {_state('TRUE')}",
    "counts_over_time": _H + " UNION ALL ".join(
        f"SELECT '{name}' AS point_in_time, count(*) AS \"rows\" FROM {_state(_at(time))}"
        for name, time in {
            "now": "2024-02-01 02:30:00",
            "1h ago": "2024-02-01 01:30:00",
            "6h ago": "2024-01-31 20:30:00",
            "24h ago": "2024-01-31 02:30:00",
        }.items()
    ),
    "report_as_of": _H + f"""
SELECT site_id, CAST(sum(active_devices) AS BIGINT) AS total_devices,
  CAST(sum(total_alerts) AS BIGINT) AS total_alerts,
  {_round("avg(avg_temperature)", 2)} AS avg_temp
FROM {_state(_at("2024-02-01 01:30:00"))} GROUP BY site_id""",
    "version_delta": _H + f"""
SELECT n.site_id, n.total_alerts AS alerts_now, o.total_alerts AS alerts_30min_ago,
  n.total_alerts - o.total_alerts AS delta
FROM {_NOW_STATE} n JOIN {_state("loaded_at < TIMESTAMP '2024-02-01 02:00:00'")} o
  ON n.analysis_hour = o.analysis_hour AND n.site_id = o.site_id""",
    "changed_values": _with(_TELEMETRY, _SILVER, _HISTORY, _STATES) + """
SELECT n.site_id, n.avg_temperature AS temp_now, o.avg_temperature AS temp_old
FROM now_state n JOIN old_state o
  ON n.analysis_hour = o.analysis_hour AND n.site_id = o.site_id
WHERE n.avg_temperature <> o.avg_temperature""",
    "changes_between": _H + f"""
SELECT analysis_hour, site_id, {", ".join(_VALUES)},
  CASE WHEN EXISTS (SELECT 1 FROM history o WHERE o.analysis_hour = n.analysis_hour
    AND o.site_id = n.site_id AND o.loaded_at <= TIMESTAMP '2024-02-01 00:30:00')
  THEN 'UPDATE' ELSE 'INSERT' END AS action
FROM {_state("loaded_at > TIMESTAMP '2024-02-01 00:30:00'"
             " AND loaded_at <= TIMESTAMP '2024-02-01 02:30:00'")} n""",
    "newest_after_deletes": _H + f"SELECT {_GOLD_COLUMNS} FROM {_state(_NOT_DELETED)}",
    "net_changes": _H + f"""
SELECT analysis_hour, site_id, {", ".join(_VALUES)},
  CASE WHEN EXISTS (SELECT 1 FROM history o WHERE o.analysis_hour = n.analysis_hour
    AND o.site_id = n.site_id AND o.batch_id = 0) THEN 'UPDATE' ELSE 'INSERT' END AS action
FROM {_state("batch_id > 0 AND (" + _NOT_DELETED + ")")} n
UNION ALL
SELECT analysis_hour, site_id, {", ".join(_VALUES)}, 'DELETE'
FROM history o WHERE batch_id = 0 AND site_id = 'Railway_1' AND analysis_hour IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM history n WHERE n.batch_id = 2
    AND n.analysis_hour = o.analysis_hour AND n.site_id = o.site_id)""",
    "gold_merge_deletes": _H + f"""
SELECT {_GOLD_COLUMNS} FROM {_state("batch_id < 2")} t
WHERE NOT EXISTS (SELECT 1 FROM history s WHERE s.batch_id = 2
  AND s.analysis_hour = t.analysis_hour AND s.site_id = t.site_id)
UNION ALL SELECT {_GOLD_COLUMNS} FROM history WHERE batch_id = 2 AND site_id <> 'Cold_Storage'""",
    "as_of_intervals": _H + f"SELECT {_GOLD_COLUMNS} FROM {_state(_at('2024-02-01 01:30:00'))}",
    "gold_signed_delta": _with(_TELEMETRY, _SILVER, _CHANGED) + f"""
SELECT hour_bucket AS analysis_hour, site_id, {_metrics()} FROM changed GROUP BY 1, 2""",
    "delta_refresh_stats": _with(_TELEMETRY, _SILVER, _CHANGED) + f""",
old_rows AS (SELECT hour_bucket AS analysis_hour, site_id, {_metrics()} FROM silver WHERE batch_id < 2 GROUP BY 1, 2),
new_rows AS (SELECT hour_bucket AS analysis_hour, site_id, {_metrics()} FROM changed GROUP BY 1, 2)
SELECT (SELECT count(*) FROM (SELECT * FROM new_rows EXCEPT ALL SELECT * FROM old_rows)) AS rows_added,
  (SELECT count(*) FROM (SELECT * FROM old_rows EXCEPT ALL SELECT * FROM new_rows)) AS rows_removed""",
    "version_changes": _H + f"""
SELECT CASE WHEN new_here THEN new_hour ELSE old_hour END AS analysis_hour,
  CASE WHEN new_here THEN new_site ELSE old_site END AS site_id,
  {", ".join(f"CASE WHEN new_here THEN new_{c} ELSE old_{c} END AS {c}" for c in _VALUES)},
  CASE WHEN NOT old_here THEN 'INSERT' WHEN NOT new_here THEN 'DELETE' ELSE 'UPDATE' END AS action
FROM (
  SELECT n.batch_id IS NOT NULL AS new_here, o.batch_id IS NOT NULL AS old_here,
    n.analysis_hour AS new_hour, o.analysis_hour AS old_hour,
    n.site_id AS new_site, o.site_id AS old_site, {_PAIRS},
    {_DIFFERS} AS differs
  FROM (SELECT * FROM {_state("TRUE")} WHERE site_id <> 'Railway_1') n
  FULL JOIN (SELECT * FROM history WHERE batch_id = 0) o
    ON n.analysis_hour = o.analysis_hour AND n.site_id = o.site_id)
WHERE NOT (new_here AND old_here) OR differs""",
    "refresh_stats": _with(_TELEMETRY, _SILVER, _DYNAMIC, f"""
earlier AS (SELECT hour_bucket AS analysis_hour, site_id, {_metrics(2, "count(*)")}
  FROM silver WHERE batch_id < 2 GROUP BY 1, 2)""") + """
SELECT (SELECT count(*) FROM (FROM dynamic EXCEPT ALL FROM earlier)) AS rows_added,
  (SELECT count(*) FROM (FROM earlier EXCEPT ALL FROM dynamic)) AS rows_removed""",
    "stream_rows_since": _S + f"""
SELECT {_SILVER_OUT} FROM silver WHERE load_ts > TIMESTAMP '2024-02-01 00:30:00'""",
    "has_new_data": _S + """
SELECT count(*) > 0 AS has_data FROM silver WHERE load_ts > TIMESTAMP '2024-02-01 01:00:00'""",
    "consume_commits": _with(_TELEMETRY, _SILVER) + """
SELECT site_id, CAST(CASE batch_id WHEN 1 THEN 2 ELSE 1 END AS INTEGER) AS step, count(*) AS hourly_rows,
  CAST(sum(record_count) AS BIGINT) AS records, min(load_ts) AS oldest, FALSE AS has_data
FROM silver GROUP BY 1, 2""",
    "stream_status": _S + """
SELECT 'bronze_stream' AS stream_name, count(*) > 0 AS has_data
FROM telemetry WHERE loaded_at > TIMESTAMP '2024-02-01 02:00:00'
UNION ALL SELECT 'silver_stream', count(*) > 0
FROM silver WHERE load_ts > TIMESTAMP '2024-02-01 01:00:00'""",
    # reports
    "kpi_active_devices": _G + f"SELECT {_KPI['active_devices']} AS total",
    "kpi_total_alerts": _G + f"SELECT {_KPI['total_alerts']} AS total",
    "kpi_avg_uptime": _G + f"SELECT {_KPI['avg_uptime_hours']} AS val",
    "kpi_data_usage": _G + f"SELECT {_KPI['data_usage_mb']} AS mb",
    "kpi_avg_temperature": _G + f"SELECT {_KPI['avg_temperature']} AS val",
    "kpi_cards": _G + "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in _KPI.items()),
    "temperature_by_site": _G + f"""
SELECT site_id, {_round("avg(avg_temperature)", 1)} AS avg_temp FROM gold GROUP BY site_id""",
    "alert_timeline": _G + """
SELECT analysis_hour, CAST(sum(total_alerts) AS BIGINT) AS total_alerts,
  CAST(sum(alert_temp_count) AS BIGINT) AS temp_alerts,
  CAST(sum(alert_humidity_count) AS BIGINT) AS humidity_alerts
FROM gold GROUP BY analysis_hour""",
    "alert_series": _G + """
SELECT analysis_hour, 'temp_alerts' AS alert_kind, CAST(sum(alert_temp_count) AS BIGINT) AS alerts
FROM gold GROUP BY analysis_hour
UNION ALL SELECT analysis_hour, 'humidity_alerts', CAST(sum(alert_humidity_count) AS BIGINT)
FROM gold GROUP BY analysis_hour""",
    "latest_fleet_metrics": _G + """
SELECT * EXCLUDE (total_data_usage_mb, avg_uptime_hours) FROM gold
ORDER BY analysis_hour DESC NULLS FIRST, site_id LIMIT 20""",
    "verify_gold": _M + """
SELECT analysis_hour, site_id, active_devices, avg_temperature, total_alerts, loaded_at
FROM merged WHERE analysis_hour IS NOT NULL ORDER BY analysis_hour DESC, site_id LIMIT 10""",
    "gold_from_partials": _G + "SELECT * FROM gold",
    "latest_bronze": _T + """
SELECT device_id, site_id, temperature, loaded_at FROM telemetry
ORDER BY loaded_at DESC, reading_id LIMIT 5""",
    "layer_row_counts": _M + """
SELECT 'bronze' AS layer, count(*) AS "rows" FROM telemetry
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', count(*) FROM merged""",
    "layer_sync_check": _D + """
SELECT count(DISTINCT CAST(s.hour_bucket AS VARCHAR) || s.site_id) AS silver_groups,
  count(DISTINCT CAST(g.analysis_hour AS VARCHAR) || g.site_id) AS gold_groups
FROM silver s FULL JOIN dynamic g
  ON date_trunc('hour', s.hour_bucket) = g.analysis_hour AND s.site_id = g.site_id""",
    "gold_compare": _with(_TELEMETRY, _SILVER, _DYNAMIC, _HISTORY, _MERGED) + """
SELECT d.analysis_hour, d.site_id, d.total_alerts AS dynamic_alerts,
  g.total_alerts AS original_alerts, d.total_alerts - g.total_alerts AS diff
FROM dynamic d FULL JOIN merged g
  ON d.analysis_hour = g.analysis_hour AND d.site_id = g.site_id""",
    "loading_status": _T + """
SELECT count(*) FILTER (loaded_at > TIMESTAMP '2024-02-01 01:00:00') > 0 AS stream_ready,
  count(*) FILTER (loaded_at >= TIMESTAMP '2024-02-01 02:00:00') AS bronze_rows_hour
FROM telemetry""",
    # rules
    "zscore_anomaly": _S + f"""
SELECT device_id, site_id, hour_bucket, {_round("avg_temperature", 6)} AS avg_temperature,
  {_round("z", 6)} AS z_score, abs(z) > 2 AS is_anomaly
FROM (SELECT *, (avg_temperature - avg(avg_temperature) OVER (PARTITION BY site_id))
  / nullif(stddev_samp(avg_temperature) OVER (PARTITION BY site_id), 0) AS z FROM silver)""",
    "reconcile_checksums": _with(_TELEMETRY, _SILVER, _HISTORY, _GOLD) + f"""
SELECT coalesce(m.analysis_hour, g.analysis_hour) AS analysis_hour, coalesce(m.site_id, g.site_id) AS site_id,
  CASE WHEN g.site_id IS NULL THEN 'left' WHEN m.site_id IS NULL THEN 'right' ELSE 'both' END AS side
FROM {_state("analysis_hour IS NOT NULL")} m
FULL JOIN (SELECT * FROM gold WHERE analysis_hour IS NOT NULL) g USING (analysis_hour, site_id)
WHERE m.active_devices IS DISTINCT FROM g.active_devices OR m.avg_temperature IS DISTINCT FROM g.avg_temperature
  OR m.total_alerts IS DISTINCT FROM g.total_alerts OR m.total_records IS DISTINCT FROM g.total_records""",
    "zscore_from_moments": _S + f"""
SELECT device_id, site_id, hour_bucket, {_round("avg_temperature", 6)} AS avg_temperature,
  {_round("z", 6)} AS z_score, abs(z) > 2 AS is_anomaly
FROM (SELECT *, (avg_temperature - avg(avg_temperature) OVER (PARTITION BY site_id))
  / nullif(stddev_samp(avg_temperature) OVER (PARTITION BY site_id), 0) AS z
  FROM silver WHERE NOT (batch_id = 0 AND device_id = 'dev-007')) WHERE batch_id = 2""",
    "threshold_alerts": _G + """
SELECT analysis_hour, site_id, total_alerts, CAST(3 AS INTEGER) AS threshold
FROM gold WHERE total_alerts > 3""",
    "cold_chain_breach": _T + """
SELECT reading_id, site_id, temperature,
  CASE WHEN site_id = 'Cold_Storage' AND temperature > 8 THEN 'TEMP_HIGH' ELSE alert_type END
    AS alert_type,
  CASE WHEN site_id = 'Cold_Storage' AND temperature > 8 THEN 'HIGH' ELSE alert_severity END
    AS alert_severity
FROM telemetry""",
    "breach_episodes": _T + _EPISODES + "SELECT * FROM episodes",
    "breach_alerts": _T + _EPISODES + """
SELECT *, first_at AS alert_at,
  CAST(CASE WHEN first_at < TIMESTAMP '2024-01-11' THEN 0 WHEN first_at < TIMESTAMP '2024-01-21' THEN 1
    ELSE 2 END AS BIGINT) AS alert_batch FROM episodes""",
    "reported_alerts": _T + """
SELECT site_id, alert_type, alert_severity, count(*) AS alerts FROM telemetry
WHERE alert_type IS NOT NULL GROUP BY ALL""",
    "reported_alert_totals": _T + """
SELECT count(*) AS records, count(alert_type) AS total_alerts,
  count(alert_type) FILTER (site_id = 'Cold_Storage') AS cold_storage_alerts FROM telemetry""",
    # layout
    "silver_layout": _S + f"SELECT {_SILVER_OUT}, CAST(hour_bucket AS DATE) AS day FROM silver",
    "gold_layout": _G + "SELECT *, TIMESTAMP '2024-02-01 02:30:00' AS loaded_at FROM gold",
    "curve_filters": _S + f"""
SELECT 'device' AS filtered_by, {_SILVER_OUT} FROM silver WHERE device_id = 'dev-007'
UNION ALL SELECT 'site', {_SILVER_OUT} FROM silver WHERE site_id = 'Railway_1'
UNION ALL SELECT 'hour', {_SILVER_OUT} FROM silver
  WHERE hour_bucket BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11'""",
    "compacted_silver": _SILVER_ROWS,
    "layout_health": _T + """
, keyed AS (
  SELECT device_id || '/' || file_name AS file,
    coalesce(strftime(reading_time, '%Y-%m-%d'), '') || ' ' || site_id AS k FROM telemetry),
files AS (SELECT file, min(k) AS low, max(k) AS high FROM keyed GROUP BY file)
SELECT count(*) AS total_files, avg(overlap) AS average_overlap, avg(depth) AS average_depth
FROM (
  SELECT f.file,
    count(*) FILTER (o.low <= f.high AND o.high >= f.low) - 1 AS overlap,
    count(*) FILTER (o.low <= f.low AND o.high >= f.low) AS depth
  FROM files f CROSS JOIN files o GROUP BY f.file)""",
    "layout_health_stored": _S + """
SELECT count(DISTINCT coalesce(CAST(CAST(hour_bucket AS DATE) AS VARCHAR), '')) AS total_files,
  CAST(0 AS DOUBLE) AS average_overlap, CAST(1 AS DOUBLE) AS average_depth FROM silver""",
    # streaming
    "stream_silver": _SILVER_ROWS,
    "stream_gold": _M + "SELECT * FROM merged",
    "stream_gold_full": _G + "SELECT * FROM gold",
}
