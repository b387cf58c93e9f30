"""Tombstones in the history, net changes, merges with deletes and interval-coded versions."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.operators import changes, history as h, intervals
from fleetmeter.operators.upsert import merge

KEYS = ["k", "s"]
VERSIONS = T.StructType(
    [
        T.StructField("k", T.IntegerType()), T.StructField("s", T.StringType()),
        T.StructField("v", T.IntegerType()), T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.LongType()), T.StructField("is_deleted", T.BooleanType()),
    ]
)


def time(hour):
    return f"2024-01-01 {hour:02d}:00:00"


def log(spark, entries):
    """(key, value or None for a delete, hour) as versions, one batch per hour."""
    rows = spark.createDataFrame(
        [(k, "a" if k is None or k < 5 else "b", v, hour, v is None) for k, v, hour in entries],
        "k int, s string, v int, hour int, is_deleted boolean",
    )
    at = F.make_timestamp_ntz(*map(F.lit, (2024, 1, 1)), F.col("hour"), F.lit(0), F.lit(0))
    return rows.select("k", "s", "v", at.alias("loaded_at"), F.col("hour").cast("long").alias("batch_id"), "is_deleted")


def random_entries(seed):
    rng = random.Random(seed)
    found = []
    for hour in range(1, 8):
        for k in rng.sample(range(10), 5):
            found.append((k, None if rng.random() < 0.35 else rng.randrange(100), hour))
    return found


def state(entries, hour):
    """The table after an hour: values by key."""
    rows = {}
    for k, v, at in sorted(entries, key=lambda e: e[2]):
        if at <= hour:
            rows.pop(k, None)
            if v is not None:
                rows[k] = v
    return rows


def values(df):
    return {r.k: r.v for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_reads_respect_tombstones(spark, seed):
    entries = random_entries(seed)
    versions = log(spark, entries)
    assert values(h.newest(versions, KEYS)) == state(entries, 7)
    for hour in (0, 2, 5):
        assert values(h.at_time(versions, KEYS, time(hour))) == state(entries, hour)
        assert values(h.before_time(versions, KEYS, time(hour + 1))) == state(entries, hour)
        assert values(h.before_batch(versions, KEYS, hour + 1)) == state(entries, hour)
    counts = h.row_counts_at(versions, KEYS, {f"h{i}": time(i) for i in range(8)}).collect()
    assert {r.point_in_time: r.rows for r in counts} == {f"h{i}": len(state(entries, i)) for i in range(8)}
    pruned = h.prune_history(versions, KEYS, time(4))
    assert pruned.count() < versions.count()
    for hour in (4, 6, 7):
        assert values(h.at_time(pruned, KEYS, time(hour))) == state(entries, hour)
    now, then = state(entries, 7), state(entries, 3)
    both = changes.changed_values(versions, KEYS, "v", time(7), time(3)).collect()
    assert {r.k: (r.value_now, r.value_old) for r in both} == {
        k: (now[k], then[k]) for k in now.keys() & then.keys() if now[k] != then[k]
    }
    restored = h.restore_subset(versions, KEYS, time(7), time(3), F.col("s") == "a")
    assert values(restored) == {**now, **{k: v for k, v in then.items() if k < 5}}


@pytest.mark.parametrize("seed", range(3))
def test_net_changes_lead_from_one_state_to_the_other(spark, seed):
    entries = random_entries(seed)
    found = changes.net_changes(log(spark, entries), KEYS, ["v"], time(2), time(6)).collect()
    before, after = state(entries, 2), state(entries, 6)
    touched = {k for k, _, hour in entries if 2 < hour <= 6}
    want = {}
    for k in touched:
        if k in after:
            want[k] = ("UPDATE" if k in before else "INSERT", after[k])
        elif k in before:
            want[k] = ("DELETE", before[k])
    assert {r.k: (r.action, r.v) for r in found} == want


def test_net_change_of_short_lives(spark):
    entries = [(1, 10, 3), (1, None, 4), (2, 20, 1), (2, None, 3), (2, 21, 4), (3, 30, 1), (3, None, 3),
               (4, None, 3), (5, 50, 3), (5, None, 4), (5, 51, 5)]
    found = changes.net_changes(log(spark, entries), KEYS, ["v"], time(2), time(6)).collect()
    assert {r.k: (r.action, r.v) for r in found} == {2: ("UPDATE", 21), 3: ("DELETE", 30), 5: ("INSERT", 51)}


def test_tombstones_are_a_batch_like_any_other(spark):
    versions = log(spark, [(1, 10, 1), (2, 20, 1), (7, 70, 1)]).drop("is_deleted")
    dead = h.tombstones(versions.filter("k < 5").union(versions.filter("k < 5")), versions, KEYS, time(2), 2)
    both = h.with_deletes(versions, dead)
    assert values(h.newest(both, KEYS)) == {7: 70} and values(h.at_time(both, KEYS, time(1))) == {1: 10, 2: 20, 7: 70}
    assert dead.count() == 2
    again = h.with_deletes(both, log(spark, [(1, 11, 3)]))
    assert values(h.newest(again, KEYS)) == {1: 11, 7: 70}


def test_merge_with_deletes(spark):
    schema = "k int, s string, v int"
    target = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (None, "a", 3)], schema)
    source = spark.createDataFrame(
        [(1, "a", 9, True), (2, "a", 8, False), (4, "a", 7, True), (5, "a", 6, None), (None, "a", 5, True)],
        schema + ", gone boolean",
    )
    got = sorted((r.k or 0, r.v) for r in merge(target, source, KEYS, "gone").collect())
    assert got == [(0, 3), (2, 8), (5, 6)]
    safe = merge(target, source, KEYS, "gone", null_safe=True).collect()
    assert sorted((r.k or 0, r.v) for r in safe) == [(2, 8), (5, 6)]


STORED = T.StructType(VERSIONS.fields[:3])


def by_hour(spark, entries, hour):
    return log(spark, [e for e in entries if e[2] == hour]).select("k", "s", "v", "is_deleted")


def test_interval_reads_equal_ranked_reads(spark, tmp_path):
    entries = random_entries(5) + [(None, 1, 2), (None, 2, 5)]
    path = str(tmp_path)
    for hour in range(1, 8):
        args = spark, path, STORED, by_hour(spark, entries, hour), KEYS, time(hour), hour
        intervals.add_batch(*args)
        if hour in (3, 7):  # run again after it was written
            intervals.add_batch(*args)
    stored = intervals.read_stored(spark, path, STORED)
    versions = log(spark, entries)

    def rows(df):
        return sorted(((r.k, r.v) for r in df.collect()), key=str)

    for hour in range(0, 9):
        assert rows(intervals.at_time(*stored, time(hour))) == rows(h.at_time(versions, KEYS, time(hour)))
        assert rows(intervals.before_time(*stored, time(hour))) == rows(h.before_time(versions, KEYS, time(hour)))
    assert len(intervals.drop_old_open(spark, path)) == 6
    assert rows(intervals.at_time(*intervals.read_stored(spark, path, STORED), time(4))) == rows(
        h.at_time(versions, KEYS, time(4))
    )


def test_a_batch_without_its_open_versions_does_not_count(spark, tmp_path):
    entries = [(1, 10, 1), (2, 20, 1), (1, 11, 2)]
    path = str(tmp_path)
    for hour in (1, 2):
        intervals.add_batch(spark, path, STORED, by_hour(spark, entries, hour), KEYS, time(hour), hour)
    newest = max((tmp_path / "open" / "commits").glob("part-*"), key=lambda p: p.stat().st_mtime_ns)
    newest.unlink()
    assert values(intervals.at_time(*intervals.read_stored(spark, path, STORED), time(3))) == {1: 10, 2: 20}
    intervals.add_batch(spark, path, STORED, by_hour(spark, entries, 2), KEYS, time(2), 2)
    assert values(intervals.at_time(*intervals.read_stored(spark, path, STORED), time(3))) == {1: 11, 2: 20}


def test_interval_reads_rank_and_move_nothing(spark, tmp_path):
    """No window, no shuffle, and only files of versions that ended later are opened."""
    path = str(tmp_path)
    for day in range(1, 6):
        batch = spark.createDataFrame([(k, "a", day * 10 + k) for k in range(3)], STORED)
        intervals.add_batch(spark, path, STORED, batch, KEYS, f"2024-01-0{day} 00:00:00", day)
    found = intervals.at_time(*intervals.read_stored(spark, path, STORED), "2024-01-04 12:00:00")
    assert values(found) == {k: 40 + k for k in range(3)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    assert any("ended_on" in x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:])
