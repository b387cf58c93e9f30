"""Differences of two tables by a tree of checksums."""

import datetime as dt

import pytest

from fleetmeter.operators import reconcile as r

VALUES = ["a", "b"]
SCHEMA = "analysis_hour timestamp_ntz, site_id string, a int, b double"


def hour(h):
    return None if h is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


BASE = [(hour(h), s, h % 7, h / 8) for h in range(0, 100, 3) for s in "xyz"] + [(None, "x", 1, None), (None, None, 1, 2.0)]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(spark, left, right):
    tables = table(spark, left), table(spark, right)
    leaves = [r.checksums(t, VALUES) for t in tables]
    return sorted((str(x.analysis_hour), str(x.site_id), x.side) for x in r.differences(*tables, VALUES, *leaves).collect())


def test_exactly_the_differing_keys(spark):
    right = [list(x) for x in BASE]
    right[4][2] = 99
    right[10][3] = None
    right[-2][3] = 0.0  # NULL against zero, in the NULL hour
    gone, right = right[20], right[:20] + right[21:]
    new = (hour(500), "x", 1, 1.0)
    got = found(spark, BASE, [tuple(x) for x in right] + [new])
    want = [(str(BASE[i][0]), str(BASE[i][1]), "both") for i in (4, 10, -2)]
    assert got == sorted([*want, (str(gone[0]), gone[1], "left"), (str(new[0]), "x", "right")])


def test_equal_and_empty_tables(spark):
    assert found(spark, BASE, BASE[::-1]) == [] and found(spark, [], []) == []
    assert [x[2] for x in found(spark, [], BASE[:5])] == ["right"] * 5


def test_swapped_values_and_nulls_show(spark):
    assert found(spark, [(hour(1), "x", None, 3.0)], [(hour(1), "x", 3, None)]) == [(str(hour(1)), "x", "both")]


def test_leaves_of_batches_add_up(spark):
    parts = [r.checksums(table(spark, x), VALUES) for x in (BASE[:40], BASE[40:])]
    whole = r.checksums(table(spark, BASE), VALUES)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(r.added(*parts)) == key(whole) and key(r.added(whole, parts[1], -1)) == key(parts[0])


@pytest.mark.parametrize("days", [r.NAMED_DAYS, 0])
def test_rows_are_read_below_differing_leaves_only(spark, tmp_path, monkeypatch, days):
    monkeypatch.setattr(r, "NAMED_DAYS", days)
    right = [x if x[0] != hour(30) else (x[0], x[1], -1, x[3]) for x in BASE]
    leaves = [r.checksums(table(spark, x), VALUES) for x in (BASE, right)]
    assert r.differing_leaves(*leaves).count() == 3
    table(spark, BASE).write.parquet(f"{tmp_path}/t")
    stored = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/t")
    rows = r._rows_of(stored, r.differing_leaves(*leaves))
    assert rows.count() == 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert ("GreaterThanOrEqual(analysis_hour,2024-01-02" in plan) == bool(days)
