import random

import pytest
from pyspark.sql import functions as F

from fleetmeter.functions import times, values
from fleetmeter.operators import (
    anomaly,
    changes,
    gold,
    history,
    layout,
    reports,
    rules,
    silver,
)
from fleetmeter.operators.join_back import join_groups
from fleetmeter.operators.upsert import upsert
from fleetmeter.plans import fleet_view as view
from fleetmeter.schemas import GOLD, GOLD_KEYS, SILVER, SILVER_STORED
from fleetmeter.sources import tables

AT = "2024-02-01 00:00:00"
READING = (
    "device_id string, site_id string, reading_time timestamp_ntz, temperature double,"
    " humidity double, battery_pct double, signal_rssi int, uptime_hours double,"
    " data_usage_mb double"
)


def readings(spark, *rows):
    """Rows of (device, site, time text, temperature, humidity, rssi)."""
    full = [(d, s, t, temp, hum, 50.0, rssi, 1.0, 1.0) for d, s, t, temp, hum, rssi in rows]
    text = READING.replace("reading_time timestamp_ntz", "reading_time string")
    return spark.createDataFrame(full, text).withColumn(
        "reading_time", F.col("reading_time").cast("timestamp_ntz")
    )


def kpis(spark, *rows):
    """History rows of (hour text, site, alerts, loaded_at text, batch)."""
    return spark.createDataFrame(
        list(rows), "analysis_hour string, site_id string, total_alerts bigint, loaded_at string, batch_id int"
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("analysis_hour", "loaded_at")})


def state(table):
    return sorted(
        ((str(r.analysis_hour)[11:13], r.site_id, r.total_alerts) for r in table.collect())
    )


H1, H2 = "2024-01-01 01:00:00", "2024-01-01 02:00:00"
T0, T1, T2 = "2024-02-01 00:00:00", "2024-02-01 01:00:00", "2024-02-01 02:00:00"


# --- functions -----------------------------------------------------------------------


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Ho_Chi_Minh"])
def test_buckets_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist on this day in New York.
        t = F.lit("2024-03-10 02:30:45").cast("timestamp_ntz")
        later = F.lit("2024-03-10 03:05:01").cast("timestamp_ntz")
        row = spark.range(1).select(
            times.hour_bucket(t).alias("h"),
            times.minute_bucket(t).alias("m"),
            times.day_bucket(t).alias("d"),
            times.minutes_between(t, later).alias("gap"),
            times.hour_bucket(F.lit(None).cast("timestamp_ntz")).alias("n"),
        ).first()
        assert [str(x) for x in row] == [
            "2024-03-10 02:00:00", "2024-03-10 02:30:00", "2024-03-10 00:00:00", "35", "None"
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rounding_takes_ties_away_from_zero(spark):
    xs = [2.675, -2.675, 1.005, 0.0, None]
    rows = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in rows.select(values.round_fixed(F.col("x"), 2)).collect()]
    assert got == [2.68, -2.68, 1.01, 0.0, None]


def test_null_tokens(spark):
    rows = spark.createDataFrame([("NULL",), ("",), ("null",), (None,), ("x",)], "t string")
    got = [r[0] for r in rows.select(values.null_if_tokens(F.col("t"))).collect()]
    assert got == [None, None, "null", None, "x"]


def test_masking_by_role(spark):
    rows = spark.createDataFrame([("iot_batch_20260317.json",)], "file_name string")
    assert rules.mask_file_name(rows, "iot_analyst").first()[0] == "***_*****_********.****"
    for role in rules.CLEAR_ROLES:
        assert rules.mask_file_name(rows, role).first()[0] == "iot_batch_20260317.json"


# --- silver and gold -----------------------------------------------------------------


def test_alert_bounds_are_strict_and_null_is_no_alert(spark):
    rows = readings(
        spark,
        ("d2", "s", H1, 2.0, 30.0, -40),
        ("d8", "s", H1, 8.0, 70.0, -40),
        ("dn", "s", H1, None, None, -40),
        ("dt", "s", H1, 1.99, 50.0, -40),
        ("dh", "s", H1, 5.0, 70.01, -40),
        ("dh", "s", H1, 5.0, 50.0, -40),
    )
    got = {r.device_id: (r[3], r[4]) for r in silver.alert_flags(rows).collect()}
    assert got == {
        "d2": (False, False),
        "d8": (False, False),
        "dn": (False, False),
        "dt": (True, False),
        "dh": (False, True),
    }
    wide = silver.alert_flags(rows, silver.Thresholds(temperature_low=1, humidity_high=80))
    assert not any(r[3] or r[4] for r in wide.collect())


def test_signal_average_is_rounded_not_cut(spark):
    rows = readings(spark, *[("d", "s", H1, 5.0, 50.0, x) for x in (-41, -42, -42)])
    out = silver.silver_hourly(rows, AT)
    assert out.first().signal_rssi_avg == -42
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SILVER]


def test_hour_without_any_reading_value_has_null_averages(spark):
    row = silver.silver_hourly(readings(spark, ("d", "s", H1, None, None, None)), AT).first()
    assert (row.avg_temperature, row.avg_humidity, row.signal_rssi_avg) == (None, None, None)
    assert row.record_count == 1


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_partials_add_up_to_the_same_for_any_split(spark, sf, parts):
    rows = view.readings(spark, sf).withColumn("part", F.col("reading_id") % parts)
    split = silver.hourly_partials(rows, extra_keys=("part",))
    merged = silver.finish_hourly(silver.add_partials(split), AT)
    direct = silver.silver_hourly(rows, AT)

    def fixed(table):
        floats = [f.name for f in SILVER if f.dataType.simpleString() == "double"]
        return table.withColumns({c: values.round_fixed(F.col(c), 6) for c in floats})

    assert fixed(merged).exceptAll(fixed(direct)).isEmpty()
    assert merged.count() == direct.count()


def test_total_alerts_is_temperature_or_humidity(spark, sf):
    rows = gold.fleet_metrics(view.silver(spark, sf))
    wrong = rows.filter(
        (F.col("total_alerts") > F.col("alert_temp_count") + F.col("alert_humidity_count"))
        | (F.col("total_alerts") < F.greatest("alert_temp_count", "alert_humidity_count"))
    )
    assert wrong.isEmpty()


def test_two_hours_by_five_sites_are_ten_groups(spark):
    rows = readings(
        spark,
        *[(f"d{i % 20}", f"s{i % 5}", h, 5.0, 50.0, -50) for i in range(100) for h in (H1, H2)],
    )
    assert gold.fleet_metrics(silver.silver_hourly(rows, AT)).count() == 10


def test_declarative_and_merged_gold_agree_when_hours_arrive_in_one_batch(spark, sf):
    hourly = silver.silver_hourly(view.readings(spark, sf), AT)
    compared = reports.gold_compare(gold.gold_dynamic(hourly), gold.gold_rows(hourly, AT))
    assert compared.filter("diff <> 0").isEmpty()
    assert compared.filter("analysis_hour IS NOT NULL AND diff IS NULL").isEmpty()


def test_filter_on_a_day_table_prunes_folders(spark, sf, tmp_path):
    path = str(tmp_path / "silver")
    layout.write_silver_layout(view.silver(spark, sf), path)
    stored = tables.read_table(spark, path, SILVER_STORED)
    found = silver.filter_silver(stored, "2024-01-05 03:00:00", "2024-01-06 20:00:00")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(hour_bucket)" in plan
    files = found.select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert {f.f.split("day=")[1][:10] for f in files} == {"2024-01-05", "2024-01-06"}
    wanted = view.silver(spark, sf).filter(
        "hour_bucket BETWEEN timestamp_ntz'2024-01-05 03:00:00' AND timestamp_ntz'2024-01-06 20:00:00'"
    )
    assert found.count() == wanted.count() > 0


# --- upsert --------------------------------------------------------------------------


def test_upsert_twice_is_upsert_once_but_null_keys_grow(spark):
    target = kpis(spark, (H1, "a", 1, T0, 0), (H2, "a", 2, T0, 0), (None, "a", 7, T0, 0))
    source = kpis(spark, (H1, "a", 9, T1, 1), (H1, "b", 3, T1, 1), (None, "a", 8, T1, 1))
    once = upsert(target, source, GOLD_KEYS)
    assert state(once.filter("analysis_hour IS NOT NULL")) == [
        ("01", "a", 9), ("01", "b", 3), ("02", "a", 2)
    ]
    assert once.filter("analysis_hour IS NULL").count() == 2
    twice = upsert(once, source, GOLD_KEYS)
    assert twice.filter("analysis_hour IS NOT NULL").count() == 3
    assert twice.filter("analysis_hour IS NULL").count() == 3
    safe = upsert(target, source, GOLD_KEYS, null_safe=True)
    assert [r.total_alerts for r in safe.filter("analysis_hour IS NULL").collect()] == [8]


def test_delta_replaces_and_backfill_repairs(spark, sf):
    versions = view.history(spark, sf)
    rows = view.silver(spark, sf)
    delta = history.newest(versions, GOLD_KEYS).select(*GOLD.names)
    full = gold.gold_rows(rows, AT)
    known = "analysis_hour IS NOT NULL"
    assert delta.filter(known).agg(F.sum("total_records")).first()[0] < (
        full.filter(known).agg(F.sum("total_records")).first()[0]
    )
    repaired = upsert(delta, full, GOLD_KEYS).filter(known).drop("loaded_at")
    assert repaired.exceptAll(full.filter(known).drop("loaded_at")).isEmpty()


# --- history -------------------------------------------------------------------------


@pytest.fixture()
def versions(spark):
    return kpis(
        spark,
        (H1, "a", 1, T0, 0), (H1, "b", 5, T0, 0), (None, "a", 7, T0, 0),
        (H1, "a", 2, T1, 1), (H2, "a", 4, T1, 1), (None, "a", 7, T1, 1),
        (H1, "a", 3, T2, 2), (H1, "b", 5, T2, 2),
    )


def test_state_at_and_before_a_time(versions):
    assert state(history.at_time(versions, GOLD_KEYS, T1)) == [
        ("", "a", 7), ("", "a", 7), ("01", "a", 2), ("01", "b", 5), ("02", "a", 4)
    ]
    assert state(history.before_time(versions, GOLD_KEYS, T1)) == [
        ("", "a", 7), ("01", "a", 1), ("01", "b", 5)
    ]
    assert state(history.before_batch(versions, GOLD_KEYS, 1)) == (
        state(history.before_time(versions, GOLD_KEYS, T1))
    )
    assert state(history.at_offset(versions, GOLD_KEYS, T2, 3600)) == (
        state(history.at_time(versions, GOLD_KEYS, T1))
    )
    assert state(history.at_time(versions, GOLD_KEYS, T1, null_safe=True)) == [
        ("", "a", 7), ("01", "a", 2), ("01", "b", 5), ("02", "a", 4)
    ]


def test_newest_equals_merging_batch_by_batch(versions):
    target = versions.filter("batch_id = 0")
    for batch in (1, 2):
        target = upsert(target, versions.filter(F.col("batch_id") == batch), GOLD_KEYS)
    assert state(target) == state(history.newest(versions, GOLD_KEYS))


def test_same_load_time_is_ordered_by_batch(spark):
    rows = kpis(spark, (H1, "a", 2, T0, 1), (H1, "a", 1, T0, 0))
    assert state(history.newest(rows, GOLD_KEYS)) == [("01", "a", 2)]
    changed = changes.changes_between(rows, GOLD_KEYS, ["total_alerts"], "2024-01-01 00:00:00", T2)
    assert [tuple(r)[1:] for r in changed.collect()] == [("a", 2, "INSERT")]


def test_version_pairs_equal_a_self_join(versions):
    got = changes.version_delta(versions, GOLD_KEYS, "total_alerts", T2, T1)
    now = history.at_time(versions, GOLD_KEYS, T2).alias("n")
    old = history.before_time(versions, GOLD_KEYS, T1).alias("o")
    joined = now.join(
        old,
        (F.col("n.analysis_hour") == F.col("o.analysis_hour"))
        & (F.col("n.site_id") == F.col("o.site_id")),
    ).select("n.site_id", "n.total_alerts", "o.total_alerts")
    assert sorted((r.site_id, r.value_now, r.value_before) for r in got.collect()) == (
        sorted(map(tuple, joined.collect()))
    )
    changed = changes.changed_values(versions, GOLD_KEYS, "total_alerts", T2, T1)
    assert [(r.site_id, r.value_now, r.value_old) for r in changed.collect()] == [("a", 3, 2)]


def test_counts_over_time(versions):
    got = history.row_counts_at(versions, GOLD_KEYS, {"t0": T0, "t2": T2, "never": "2020-01-01"})
    assert {r.point_in_time: r.rows for r in got.collect()} == {"t0": 3, "t2": 5, "never": 0}


def test_restore_sets_back_only_the_subset(versions):
    back = history.restore_subset(versions, GOLD_KEYS, T2, T0, F.col("site_id") == "a")
    assert state(back) == [
        ("", "a", 7), ("", "a", 7), ("01", "a", 1), ("01", "b", 5), ("02", "a", 4)
    ]


def test_pruned_history_answers_every_later_read(versions):
    pruned = history.prune_history(versions, GOLD_KEYS, T1)
    assert pruned.count() == 7
    for when in (T1, "2024-02-01 01:30:00", T2):
        assert state(history.at_time(pruned, GOLD_KEYS, when)) == (
            state(history.at_time(versions, GOLD_KEYS, when))
        )


def test_changes_between_times(versions):
    got = changes.changes_between(versions, GOLD_KEYS, ["total_alerts"], T0, T1)
    assert sorted((str(r[0])[11:13], r[1], r[2], r[3]) for r in got.collect()) == [
        ("", "a", 7, "INSERT"), ("01", "a", 2, "UPDATE"), ("02", "a", 4, "INSERT")
    ]


def test_version_changes_label_inserts_updates_and_deletes(spark):
    old = kpis(spark, (H1, "a", 1, T0, 0), (H1, "b", 2, T0, 0), (H1, "c", None, T0, 0))
    new = kpis(spark, (H1, "a", 1, T1, 1), (H1, "c", 5, T1, 1), (H1, "d", 6, T1, 1))
    got = changes.version_changes(old, new, GOLD_KEYS, ["total_alerts"])
    assert sorted((r.site_id, r.total_alerts, r.action) for r in got.collect()) == [
        ("b", 2, "DELETE"), ("c", 5, "UPDATE"), ("d", 6, "INSERT")
    ]


def test_refresh_statistics(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("c", None)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "k string, v int")
    row = changes.refresh_stats(old, new).first()
    assert tuple(row) == (2, 2)
    assert tuple(changes.refresh_stats(old, old).first()) == (0, 0)
    assert tuple(changes.refresh_stats(old.limit(0), old.limit(0)).first()) == (0, 0)


def test_new_data_flag(versions):
    flag = lambda last: changes.has_new_data(versions, last, "loaded_at").first()[0]
    assert flag(T1) is True and flag(T2) is False
    assert changes.has_new_data(versions.limit(0), T0, "loaded_at").first()[0] is False


# --- reports -------------------------------------------------------------------------


def test_cards_show_zero_when_nothing_is_recent(spark, sf):
    metrics = gold.fleet_metrics(view.silver(spark, sf))
    assert tuple(reports.kpi_cards(metrics, "2030-01-01 00:00:00").first()) == (0, 0, 0.0, 0.0, 0.0)
    assert reports.active_devices(metrics, "2030-01-01 00:00:00").first()[0] == 0


def test_window_of_cards_is_strict(spark):
    rows = kpis(spark, (H1, "a", 1, T0, 0), (H2, "a", 2, T0, 0))
    assert reports.total_alerts(rows, H2).first()[0] == 2


def test_sync_check_counts_named_groups(spark):
    rows = readings(
        spark, ("d1", "a", H1, 1.0, 1.0, 1), ("d2", "a", H1, 1.0, 1.0, 1),
        ("d1", None, H1, 1.0, 1.0, 1), ("d1", "b", None, 1.0, 1.0, 1),
    )
    hourly = silver.silver_hourly(rows, AT)
    assert tuple(reports.layer_sync_check(hourly, gold.gold_dynamic(hourly)).first()) == (1, 1)
    assert tuple(reports.layer_sync_check(hourly, gold.gold_dynamic(hourly).limit(0)).first()) == (1, 0)


def test_latest_rows_begin_with_the_null_hour(spark):
    rows = kpis(spark, (H1, "a", 1, T0, 0), (None, "b", 1, T0, 0), (H2, "b", 2, T0, 0), (H2, "a", 3, T0, 0))
    got = [(str(r[0])[11:13], r[1]) for r in reports.latest_metrics(rows, 3).collect()]
    assert got == [("", "b"), ("02", "a"), ("02", "b")]


# --- anomaly, rules ------------------------------------------------------------------


def hourly_temperatures(spark, sites):
    rows = [
        (f"d{i}", site, H1, float(t), 50.0, -50)
        for site, temps in sites.items()
        for i, t in enumerate(temps)
    ]
    return silver.silver_hourly(readings(spark, *rows), AT)


def test_zscore_is_null_without_spread(spark):
    rows = hourly_temperatures(spark, {"flat": [5, 5, 5], "one": [4], "wide": [0] * 9 + [100], None: [0] * 9 + [50]})
    got = anomaly.zscore_anomalies(rows).collect()
    flat = [r for r in got if r.site_id in ("flat", "one")]
    assert all(r.z_score is None and r.is_anomaly is None for r in flat) and len(flat) == 4
    assert sorted(r.avg_temperature for r in got if r.is_anomaly) == [50.0, 100.0]


def test_zscore_is_the_same_with_few_and_with_many_sites(spark, sf):
    rows = view.silver(spark, sf)
    few = anomaly.zscore_anomalies(rows)
    many = anomaly.zscore_anomalies(rows, broadcast_rows=2)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()

    def fixed(t):
        return t.withColumns({c: values.round_fixed(F.col(c), 6) for c in ("avg_temperature", "z_score")})

    assert few.count() == many.count()
    assert fixed(few).exceptAll(fixed(many)).isEmpty()


def test_join_groups_spreads_one_hot_key(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("k"), "id"
    )
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = join_groups(rows, groups, "k", ["id"], broadcast_rows=1, salts=16)
    assert joined.columns == ["k", "id", "n"]
    assert joined.filter("n IS NULL").isEmpty() and joined.count() == 20000
    hot = rows.filter("k = -1").select(F.pmod(F.xxhash64("id"), F.lit(16)).alias("s"))
    assert hot.distinct().count() == 16


def test_cold_chain_rule_overrides_the_reported_alert(spark):
    rows = spark.createDataFrame(
        [("Cold_Storage", 8.0, None, None), ("Cold_Storage", 8.1, "BATTERY_LOW", "LOW"),
         ("Factory_A", 30.0, None, None), ("Cold_Storage", None, "SIGNAL_WEAK", "LOW")],
        "site_id string, temperature double, alert_type string, alert_severity string",
    )
    got = [(r.alert_type, r.alert_severity) for r in rules.apply_cold_chain_rule(rows).collect()]
    assert got == [(None, None), ("TEMP_HIGH", "HIGH"), (None, None), ("SIGNAL_WEAK", "LOW")]


# --- layout --------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_layout_health_equals_counting_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [
        (f"f{rng.randrange(25)}", rng.choice([None, *range(6)]), rng.choice("abc"))
        for _ in range(80)
    ]
    low, high = {}, {}
    for file, day, site in rows:
        key = ((day is not None, day or 0), site)
        low[file] = min(low.get(file, key), key)
        high[file] = max(high.get(file, key), key)
    meets = lambda f, o: low[o] <= high[f] and high[o] >= low[f]
    covers = lambda f, o: low[o] <= low[f] <= high[o]
    overlap = [sum(meets(f, o) for o in low) - 1 for f in low]
    depth = [sum(covers(f, o) for o in low) for f in low]
    table = spark.createDataFrame(rows, "file string, day int, site string")
    got = layout.layout_health(table, ["day", "site"]).first()
    assert got.total_files == len(low)
    assert got.average_overlap == pytest.approx(sum(overlap) / len(low))
    assert got.average_depth == pytest.approx(sum(depth) / len(low))


def test_sorted_layout_is_healthier_than_arrival_order(spark, sf, tmp_path):
    rows = gold.gold_rows(view.silver(spark, sf), AT)
    rows.repartition(8).write.parquet(str(tmp_path / "arrived"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_gold_layout(rows, str(tmp_path / "sorted"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    health = {}
    for name in ("arrived", "sorted"):
        stored = layout.with_file(tables.read_table(spark, str(tmp_path / name), GOLD))
        health[name] = layout.layout_health(stored, GOLD_KEYS).first()
    assert health["sorted"].total_files > 1
    assert health["sorted"].average_depth == 1 and health["sorted"].average_overlap == 0
    assert health["arrived"].average_depth > 3


def test_hot_site_of_a_day_is_cut_into_several_files(spark, tmp_path):
    rows = spark.range(4000).select(
        F.format_string("d%04d", F.col("id")).alias("device_id"),
        F.lit("hot").alias("site_id"),
        F.lit(H1).cast("timestamp_ntz").alias("hour_bucket"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_silver_layout(rows, str(tmp_path / "s"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.select("_metadata.file_path").distinct().count() == 8


# --- the input view ------------------------------------------------------------------


def test_typed_readings_equal_the_extracted_payloads(spark, sf):
    from fleetmeter.functions.payload import extract_readings
    from fleetmeter.sources import json_files

    pieces = view.payload_json(spark, sf).select("raw", "file_name")
    payloads = extract_readings(json_files.bronze_rows(json_files.parse_loads(pieces, AT)))
    columns = [*READING.replace(",", "").split()[::2], "alert_type", "alert_severity"]
    typed = view.readings(spark, sf).select(*columns)
    assert typed.count() == payloads.count()
    assert typed.exceptAll(payloads.select(*columns)).isEmpty()


def test_default_stamps_do_not_depend_on_the_session_zone(spark):
    """In the hour that a clock change repeats, wall clocks of the zone go back; these do not."""
    from datetime import datetime, timedelta, timezone

    from fleetmeter.functions.times import utc_now

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = spark.range(1).select(utc_now().alias("t")).first().t
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            assert abs(got - now) < timedelta(minutes=1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_retention_keeps_every_later_read_and_the_current_table(spark, sf, tmp_path):
    rows = view.history(spark, sf)
    cutoff, paths = "2024-02-01 01:30:00", (str(tmp_path / "h"), str(tmp_path / "c"))
    history.store_pruned(rows, GOLD_KEYS, cutoff, *paths)
    kept = spark.read.schema(rows.schema).parquet(paths[0])
    assert kept.count() < rows.count()
    for when in (cutoff, "2024-02-01 02:00:00"):
        want, got = (history.at_time(x, GOLD_KEYS, when) for x in (rows, kept))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    current = spark.read.schema(rows.schema).parquet(paths[1])
    want = history.newest(rows, GOLD_KEYS)
    assert sorted(map(str, current.collect())) == sorted(map(str, want.collect()))


def test_declarative_gold_truncates_hours(spark, sf):
    rows = view.silver(spark, sf)
    moved = rows.withColumn("hour_bucket", F.col("hour_bucket") + F.expr("INTERVAL 17 MINUTE"))
    want, got = (gold.gold_dynamic(x) for x in (rows, moved))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_merge_keeps_target_rows_of_equal_keys(spark):
    from fleetmeter.operators.upsert import upsert

    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    source = spark.createDataFrame([(2, "x"), (None, "y")], "k int, v string")
    got = sorted(map(tuple, upsert(target, source, ["k"]).collect()), key=str)
    assert got == sorted([(1, "a"), (1, "b"), (2, "x"), (None, "d"), (None, "y")], key=str)
    safe = upsert(target, source, ["k"], null_safe=True).collect()
    assert sorted(map(tuple, safe), key=str) == sorted([(1, "a"), (1, "b"), (2, "x"), (None, "y")], key=str)
