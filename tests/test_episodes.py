"""Breach episodes against a plain loop over the readings of each device."""

import datetime as dt
import random

import pytest

from fleetmeter.operators import episodes as e

SCHEMA = "reading_id bigint, device_id string, reading_time timestamp_ntz, temperature double"
LIMIT = 8.0


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def brute(rows):
    out, devices = [], {}
    for i, device, time, value in rows:
        if None not in (device, time, value):
            devices.setdefault(device, []).append((time, i, value))
    for device, own in devices.items():
        run = None
        for time, _, value in sorted(own):
            if value <= LIMIT:
                out += [run + (False,)] if run else []
                run = None
            elif run is None:
                run = (device, time, time, value, 1)
            else:
                run = (*run[:2], time, max(run[3], value), run[4] + 1)
        out += [run + (True,)] if run else []
    return sorted(out)


def random_rows(seed, n, hot=0.4, breach=0.7):
    """Long runs, a hot device, equal times, and some rows that cannot be judged."""
    pick = random.Random(seed)
    rows, state = [], {}
    for i in range(n):
        device = "hot" if pick.random() < hot else f"d{pick.randrange(5)}"
        if pick.random() < 0.1:
            state[device] = pick.random() < breach
        value = pick.uniform(8.1, 20) if state.get(device) else pick.uniform(0, 8)
        time = at(i // 3)
        rows.append((i, device, time if pick.random() > 0.02 else None, value if pick.random() > 0.05 else None))
    return [*rows, (n, None, at(5), 30.0)]


def got(table):
    return sorted(map(tuple, table.select(*e.EPISODES.names).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_loop(spark, seed):
    rows = random_rows(seed, 1500)
    assert got(e.breach_episodes(spark.createDataFrame(rows, SCHEMA), LIMIT)) == brute(rows)


def test_one_run_over_all_tasks_and_none(spark):
    rows = [(i, "hot", at(i), 9.0 + i % 4) for i in range(3000)]
    assert got(e.breach_episodes(spark.createDataFrame(rows, SCHEMA), LIMIT)) == [("hot", at(0), at(2999), 12.0, 3000, True)]
    cold = [(i, "a", at(i), 8.0) for i in range(10)]
    assert got(e.breach_episodes(spark.createDataFrame(cold, SCHEMA), LIMIT)) == []
    assert got(e.breach_episodes(spark.createDataFrame([], SCHEMA), LIMIT)) == []


def test_equal_rows_count_and_extra_columns_stay_out(spark):
    rows = [(1, "a", at(1), 9.0), (1, "a", at(1), 9.0), (2, "a", at(1), 9.5)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS good", "'x' AS alert")
    assert got(e.breach_episodes(table, LIMIT)) == [("a", at(1), at(1), 9.5, 3, True)]


def test_batches_alert_once(spark, tmp_path):
    path, rows = f"{tmp_path}/alerts", sorted(random_rows(3, 600), key=lambda r: (r[2] is None, r[2]))
    cuts = [0, 150, 151, 400, len(rows)]
    batches = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    # A cut between equal times would make later rows late: move those into the earlier batch.
    for k in range(len(batches) - 1):
        while batches[k + 1] and batches[k] and batches[k + 1][0][2] == batches[k][-1][2]:
            batches[k].append(batches[k + 1].pop(0))
    taken = []
    for number, part in enumerate(batches):
        table = spark.createDataFrame(part, SCHEMA)
        taken += [e.take_batch(spark, path, number, table, LIMIT), e.take_batch(spark, path, number, table, LIMIT)]
    assert taken == [True, False] * len(batches)
    want = brute(rows)
    assert got(e.told_episodes(spark, path)) == want
    alerts = sorted((a.device_id, a.alert_at) for a in e.alerts(spark, path).collect())
    assert alerts == [x[:2] for x in want]
    assert got(e.open_episodes(spark, path)) == [x for x in want if x[5]]


def test_batch_without_episodes_closes_the_open_one(spark, tmp_path):
    path = f"{tmp_path}/alerts"
    for number, rows in enumerate([[(1, "a", at(1), 9.0)], [(2, "a", at(2), 1.0)], [(3, "a", at(3), 9.0)], []]):
        e.take_batch(spark, path, number, spark.createDataFrame(rows, SCHEMA), LIMIT)
    told = [tuple(x) for x in e.told_episodes(spark, path).orderBy("first_at").collect()]
    assert told == [("a", at(1), at(1), 9.0, 1, False, at(1), 0), ("a", at(3), at(3), 9.0, 1, True, at(3), 2)]


def test_late_reading_joins_what_is_open(spark, tmp_path):
    path = f"{tmp_path}/alerts"
    for number, rows in enumerate([[(5, "a", at(9), 9.0)], [(4, "a", at(8), 11.0)]]):
        e.take_batch(spark, path, number, spark.createDataFrame(rows, SCHEMA), LIMIT)
    told = [tuple(x) for x in e.told_episodes(spark, path).collect()]
    assert told == [("a", at(8), at(9), 11.0, 2, True, at(9), 0)]
    assert e.alerts(spark, path).count() == 1
