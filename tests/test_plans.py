"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from fleetmeter.operators import changes, gold, history, layout, reports, silver
from fleetmeter.plans import fleet_view as view
from fleetmeter.plans.queries import QUERIES
from fleetmeter.schemas import GOLD, GOLD_HISTORY, GOLD_KEYS, LOADS, SILVER
from fleetmeter.sources import json_files, layers, loads, tables

RUNS_JOBS_FIRST = {
    "bronze_load", "bronze_stream", "stage_peek", "csv_raw_load", "silver_append",
    "silver_layout", "gold_layout", "layout_health", "layout_health_stored", "zscore_anomaly",
    "stream_silver", "stream_gold", "stream_gold_full", "load_new_files_only",
    "bronze_parse_files", "filter_patterns", "silver_compact", "prune_history", "current_table",
    "array_salvage", "consume_commits", "as_of_intervals",
    "gold_signed_delta", "delta_refresh_stats", "zscore_from_moments",
    "reconcile_checksums", "curve_filters", "breach_episodes", "breach_alerts",
    "compacted_silver",
}
LAZY = sorted(set(QUERIES) - RUNS_JOBS_FIRST)


def plan(table):
    return table._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    rows = view.silver(spark, sf)
    layout.write_silver_layout(rows.drop("batch_id"), f"{root}/silver")
    layout.write_gold_layout(gold.gold_rows(rows, "2024-02-01 00:00:00"), f"{root}/gold")
    for batch in range(3):
        part = view.history(spark, sf).filter(F.col("batch_id") == batch).drop("batch_id")
        part.write.parquet(f"{root}/history/batch_id={batch}")
    return {
        "silver": tables.read_table(spark, f"{root}/silver", SILVER),
        "gold": tables.read_table(spark, f"{root}/gold", GOLD),
        "history": tables.read_table(spark, f"{root}/history", GOLD_HISTORY),
    }


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_pairs_no_whole_table_in_one_task(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval"):
        assert bad not in text
    # Only single rows, such as totals, go through one partition.
    for line in text.split("\n"):
        assert "Window" not in line or "], [" in line


def test_newest_version_is_picked_before_the_shuffle(stored):
    text = plan(history.at_time(stored["history"], GOLD_KEYS, "2024-02-01 01:00:00"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(loaded_at), LessThanOrEqual(loaded_at" in text


def test_two_versions_are_compared_in_one_pass(stored):
    pairs = history.version_pairs(
        stored["history"], GOLD_KEYS, ["total_alerts"], "2024-02-01 02:00:00",
        "2024-02-01 01:00:00", True,
    )
    text = plan(pairs)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "partial_max_by" in text


def test_batch_filter_prunes_history_folders(stored):
    text = plan(history.before_batch(stored["history"], GOLD_KEYS, 1))
    assert "PartitionFilters: [isnotnull(batch_id" in text


def test_hot_site_is_spread_over_its_devices(stored):
    text = plan(gold.fleet_metrics(stored["silver"]))
    first = text.split("Exchange hashpartitioning(")[-1].split(")")[0]
    assert "device_id" in first
    assert "merge_avg" in text


def test_gold_from_one_batch_reuses_the_silver_partitioning(spark, sf):
    hourly = silver.silver_hourly(view.readings(spark, sf), "2024-02-01 00:00:00")
    assert plan(gold.fleet_metrics(hourly)).count("Exchange") == 2


def test_cards_read_only_their_columns_of_the_last_day(stored):
    text = plan(reports.kpi_cards(stored["gold"], "2024-01-30 00:00:00"))
    assert text.count("FileScan") == 1
    assert "PushedFilters: [IsNotNull(analysis_hour), GreaterThan(analysis_hour" in text
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "avg_humidity" not in schema and "site_id" not in schema


def test_latest_rows_do_not_sort_the_table(stored):
    assert "TakeOrderedAndProject" in plan(reports.latest_metrics(stored["gold"]))


def test_recent_rows_filter_reaches_the_scan(stored):
    text = plan(changes.rows_since(stored["silver"], "2024-02-01 01:00:00"))
    assert "PushedFilters: [IsNotNull(load_ts), GreaterThan(load_ts" in text


def test_quarantine_reads_only_its_folder(spark, tmp_path):
    pieces = spark.createDataFrame([("{}", "a"), ("{", "a")], "raw string, file_name string")
    rows = json_files.parse_loads(pieces, "2024-02-01 00:00:00")
    rows.write.partitionBy("ok").parquet(str(tmp_path / "loads"))
    table = tables.read_table(spark, str(tmp_path / "loads"), LOADS)
    assert "PartitionFilters: [isnotnull(ok" in plan(json_files.quarantine_rows(table))
    text = plan(loads.load_history(table, "2024-02-02 00:00:00"))
    assert "json_data" not in text


def test_a_day_too_large_for_one_task_is_split(spark, tmp_path):
    rows = spark.range(200000).repartition(8).select(
        F.format_string("device-%d", "id").alias("device_id"),
        F.lit("hot").alias("site_id"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("hour_bucket"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        layers.append_silver(rows, str(tmp_path), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(tmp_path.rglob("*.parquet"))) > 4


def test_appended_batch_has_few_files_per_day(spark, sf, tmp_path):
    hourly = silver.silver_hourly(view.readings(spark, sf), "2024-02-01 00:00:00")
    layers.append_silver(hourly, str(tmp_path), 0)
    files = list((tmp_path / "data").rglob("*.parquet"))
    days = {f.parent.name for f in files}
    assert len(days) == 31 and len(files) == 31
    assert layers.read_silver(spark, str(tmp_path)).count() == hourly.count()


@pytest.mark.parametrize(
    "name, scans", [("gold_backfill", 2), ("restore_subset", 1), ("gold_merge_delta", 3)]
)
def test_both_sides_of_a_merge_are_read_once(spark, sf, name, scans):
    assert plan(QUERIES[name](spark, sf)).count("FileScan") <= scans


def test_ranges_without_a_time_key_are_not_ordered_in_one_task(spark):
    rows = spark.range(1000).selectExpr("id % 50 AS file", "id AS k")
    ordered = plan(layout.layout_health(rows, ["k"]))
    single = [x for x in ordered.split("\n") if "Window [" in x and x.count("], [") < 2]
    # Only the totals of the ranges.
    assert single and all("windowspecdefinition(part#" in x for x in single)
