import json

import pytest
from pyspark.sql import functions as F

from fleetmeter.functions.payload import extract_readings
from fleetmeter.operators import gold, history, silver
from fleetmeter.schemas import (
    GOLD,
    GOLD_KEYS,
    LOADS,
    SILVER,
)
from fleetmeter.sources import commits, json_files, layers as stored_layers, tables
from fleetmeter.streaming import jobs

T0, T1 = "2024-02-01 00:00:00", "2024-02-01 01:00:00"


def reading(device, site, time, temperature):
    return {
        "device_id": device, "site_id": site, "timestamp": time, "temperature": temperature,
        "humidity": 50.0, "battery_pct": 50.0, "signal_rssi": -50, "uptime_hours": 10.0,
        "data_usage_mb": 1.0, "alert_type": None, "alert_severity": None,
    }


BATCH_0 = [
    reading("d1", "a", "2024-01-01T10:01:00+00:00", 1.0),
    reading("d2", "a", "2024-01-01T10:02:00+00:00", 5.0),
    reading("d1", "b", "2024-01-02T10:02:00+00:00", 9.0),
    reading("d1", "b", "no time", 5.0),
]
BATCH_1 = [
    reading("d3", "a", "2024-01-01T10:59:00+00:00", 6.0),
    reading("d1", "b", "no time", 7.0),
]


class Layers:
    def __init__(self, spark, root):
        self.spark, self.root, self.root_path = spark, str(root), root
        (root / "landing").mkdir()
        self.landing = root / "landing"

    def drop(self, name, text):
        (self.landing / name).write_text(text)

    def ingest(self, at):
        q = jobs.ingest_files(
            self.spark, str(self.landing), f"{self.root}/loads", f"{self.root}/ck/l", loaded_at=at
        )
        q.awaitTermination()
        return q

    def silver(self, at):
        q = jobs.silver_job(
            self.spark, f"{self.root}/loads", f"{self.root}/silver", f"{self.root}/ck/s", at
        )
        q.awaitTermination()
        return q

    def gold(self, at, job=jobs.gold_job, name="gold"):
        q = job(self.spark, f"{self.root}/silver", f"{self.root}/{name}", f"{self.root}/ck/{name}", at)
        q.awaitTermination()
        return q

    def table(self, name, schema):
        return tables.read_table(self.spark, f"{self.root}/{name}", schema)

    def silver_rows(self):
        return stored_layers.read_silver(self.spark, f"{self.root}/silver")

    def versions(self, name="gold"):
        return stored_layers.read_history(self.spark, f"{self.root}/{name}")

    def forget(self, name, batch):
        """The job's own commit of a batch is lost: its checkpoint replays the batch."""
        for file in (f"{batch}", f".{batch}.crc"):
            (self.root_path / "ck" / name / "commits" / file).unlink(missing_ok=True)


@pytest.fixture()
def layers(spark, tmp_path):
    return Layers(spark, tmp_path)


def rows(table):
    return sorted(map(tuple, table.collect()), key=str)


def test_jobs_equal_the_batch_operators(spark, layers):
    layers.drop("a.json", json.dumps(BATCH_0, indent=2))
    layers.ingest(T0), layers.silver(T0), layers.gold(T0)
    layers.gold(T0, jobs.gold_refresh_job, "full")
    layers.drop("b.json", json.dumps(BATCH_1))
    layers.ingest(T1), layers.silver(T1), layers.gold(T1)
    layers.gold(T1, jobs.gold_refresh_job, "full")

    bronze = json_files.bronze_rows(layers.table("loads", LOADS))
    assert bronze.count() == 6
    per_batch = [
        silver.silver_hourly(
            extract_readings(bronze.filter(F.col("loaded_at") == F.lit(at).cast("timestamp_ntz"))), at
        )
        for at in (T0, T1)
    ]
    stored = layers.silver_rows()
    assert rows(stored.select(*SILVER.names)) == rows(per_batch[0].unionByName(per_batch[1]))
    assert stored.filter("day IS NULL").count() == 2

    # The merging job: the late device hides the earlier two, NULL hours stay apart.
    merged = history.newest(layers.versions(), GOLD_KEYS)
    got = {(str(r.analysis_hour), r.site_id): r.active_devices for r in merged.collect()}
    assert got[("2024-01-01 10:00:00", "a")] == 1
    assert merged.filter("analysis_hour IS NULL").count() == 2

    # The refreshing job: equal to a full recompute.
    full = history.newest(layers.versions("full"), GOLD_KEYS, null_safe=True)
    names = [c for c in GOLD.names if c != "loaded_at"]
    assert rows(full.select(*names)) == rows(gold.gold_rows(stored, T1).select(*names))


def test_no_new_files_means_no_new_batch(layers):
    layers.drop("a.json", json.dumps(BATCH_0))
    layers.ingest(T0), layers.silver(T0), layers.gold(T0)
    before = rows(layers.versions())
    layers.drop("a.json", json.dumps(BATCH_0))  # the same name again is not new
    layers.ingest(T1), layers.silver(T1), layers.gold(T1)
    assert rows(layers.versions()) == before


def test_bad_records_do_not_stop_the_stream(layers):
    layers.drop("a.json", json.dumps(BATCH_0, indent=2)[:-40])
    layers.drop("b.json", json.dumps(BATCH_1, indent=2))
    layers.ingest(T0)
    loads = layers.table("loads", LOADS)
    assert json_files.bronze_rows(loads).count() == 2
    bad = json_files.quarantine_rows(loads).collect()
    assert [(r.file_name, r.error) for r in bad] == [("a.json", "not valid JSON")]


def test_jobs_can_start_before_their_input_exists(layers):
    layers.silver(T0), layers.gold(T0)
    layers.drop("a.json", json.dumps(BATCH_0))
    layers.ingest(T0), layers.silver(T0), layers.gold(T0)
    stored = layers.silver_rows()
    assert stored.count() == 4
    merged = history.newest(layers.versions(), GOLD_KEYS)
    assert merged.count() == 3


def test_a_complete_silver_batch_is_not_written_again(spark, layers, tmp_path):
    layers.drop("a.json", json.dumps(BATCH_0))
    layers.ingest(T0), layers.silver(T0)
    before = sorted(p.name for p in (tmp_path / "silver").rglob("*.parquet"))
    layers.forget("s", 0)
    layers.silver(T1)
    assert sorted(p.name for p in (tmp_path / "silver").rglob("*.parquet")) == before


def test_an_unfinished_silver_batch_is_not_seen_by_gold(spark, layers, tmp_path):
    layers.drop("a.json", json.dumps([BATCH_0[3]]))
    layers.ingest(T0), layers.silver(T0)
    # The write broke off before its marker, and the checkpoint replays the batch.
    for marker in (tmp_path / "silver" / "commits").glob("*part-*"):
        marker.unlink()
    layers.forget("s", 0)
    assert layers.silver_rows().count() == 0
    layers.gold(T0)
    layers.silver(T1), layers.gold(T1)
    assert len(list((tmp_path / "silver" / "data").iterdir())) == 2
    assert layers.silver_rows().count() == 1
    assert layers.versions().filter("analysis_hour IS NULL").count() == 1
    assert len(commits.remove_unnamed(spark, f"{layers.root}/silver")) == 1
    assert layers.silver_rows().count() == 1


def test_gold_shows_a_batch_as_a_whole(spark, layers, tmp_path):
    """Until its marker is there nothing of a batch is read; a replay takes nothing away."""
    layers.drop("a.json", json.dumps(BATCH_0))
    layers.ingest(T0), layers.silver(T0), layers.gold(T0)
    before = rows(layers.versions())
    files = sorted(p.name for p in (tmp_path / "gold").rglob("*.parquet"))
    stored_layers.read_history(spark, f"{layers.root}/gold").write.parquet(f"{layers.root}/gold/data/part=half")
    assert rows(layers.versions()) == before
    layers.forget("gold", 0)
    layers.gold(T1)
    assert rows(layers.versions()) == before
    assert sorted(p.name for p in (tmp_path / "gold").rglob("*.parquet") if "half" not in str(p)) == files


def test_batches_of_a_few_files(spark, layers):
    for i in range(5):
        layers.drop(f"{i}.json", json.dumps(BATCH_0))
    q = jobs.ingest_files(
        spark, str(layers.landing), f"{layers.root}/loads", f"{layers.root}/ck/l",
        loaded_at=T0, max_files=2,
    )
    q.awaitTermination()
    assert layers.table("loads", LOADS).count() == 20
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3


def test_files_in_subfolders_are_streamed(layers):
    for folder in ("a", "b/c"):
        (layers.landing / folder).mkdir(parents=True)
        layers.drop(f"{folder}/part-0.json", json.dumps(BATCH_0))
    layers.ingest(T0)
    loads = layers.table("loads", LOADS)
    names = {r.file_name for r in loads.collect()}
    assert loads.count() == 8 and names == {"a/part-0.json", "b/c/part-0.json"}


def test_replayed_gold_batch_is_idempotent(layers, tmp_path):
    layers.drop("a.json", json.dumps(BATCH_0))
    layers.ingest(T0), layers.silver(T0), layers.gold(T0)
    before = rows(layers.versions())
    layers.forget("gold", 0)
    layers.gold(T0)
    assert rows(layers.versions()) == before


def test_touched_rows_are_the_same_with_and_without_named_days(spark, layers):
    layers.drop("a.json", json.dumps(BATCH_0))
    layers.ingest(T0), layers.silver(T0)
    layers.drop("b.json", json.dumps(BATCH_1))
    layers.ingest(T1), layers.silver(T1)
    stored = layers.silver_rows()
    batch = stored.filter("batch_id = 1")
    named = jobs.touched_rows(stored, batch)
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert any("day#" in x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only what we ask for
    try:
        asked = jobs.touched_rows(stored, batch)
        assert "BroadcastHashJoin" in asked._jdf.queryExecution().executedPlan().toString()
        shuffled = jobs.touched_rows(stored, batch, broadcast_rows=0)
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        assert rows(named) == rows(asked) == rows(shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(named) == rows(jobs.touched_rows(stored, batch, named_days=0))
    assert named.count() == 5


def test_the_null_hour_is_added_up_and_equals_a_recompute(layers, tmp_path):
    late = [reading(f"d{i}", "ab"[i % 2], "no time", float(i)) for i in range(6)]
    for i, part in enumerate((BATCH_0, BATCH_1, [BATCH_0[0]], late, late[:1])):
        layers.drop(f"{i}.json", json.dumps(part))
        at = f"2024-02-01 0{i}:00:00"
        layers.ingest(at), layers.silver(at), layers.gold(at, jobs.gold_refresh_job)
        if i == 3:  # the commit was lost: the batch runs again
            layers.forget("gold", 3)
            layers.gold(at, jobs.gold_refresh_job)
    current = history.newest(layers.versions(), GOLD_KEYS, null_safe=True)
    whole = gold.gold_rows(layers.silver_rows(), T0)
    drop = ("loaded_at", "batch_id")
    assert rows(current.drop(*drop)) == rows(whole.drop(*drop))
    state = stored_layers.read_state(layers.spark, f"{layers.root}/gold_null_hour")
    assert sorted(r.batch_id for r in state.select("batch_id").distinct().collect()) == [3, 4]
