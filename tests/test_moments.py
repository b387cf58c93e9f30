"""Stored moments against the values they stand for."""

import random
import statistics

import pytest

from fleetmeter.operators import anomaly, moments as m

BY = ["site_id"]


def table(spark, rows):
    return spark.createDataFrame(rows, "site_id string, avg_temperature double")


def of(spark, rows):
    return m.moments(table(spark, rows), "avg_temperature", BY)


def check(found, rows):
    groups = {}
    for site, x in rows:
        groups.setdefault(site, [])
        groups[site] += [] if x is None else [x]
    got = {r.site_id: r for r in found.collect() if r.n}
    assert set(got) == {s for s, xs in groups.items() if xs}
    for site, r in got.items():
        xs = groups[site]
        assert r.n == len(xs) and r["mean"] == pytest.approx(statistics.fmean(xs), rel=1e-12)
        if len(xs) > 1:
            assert r.m2 == pytest.approx(statistics.variance(xs) * (len(xs) - 1), rel=1e-7, abs=1e-9)


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_batches_merged_and_withdrawn(spark, shift):
    rng = random.Random(4)
    sites = ["a", "b", "c", None]
    batches = [
        [(rng.choice(sites[: i + 2]), rng.choice([None, shift + rng.gauss(5, 2)])) for _ in range(40)]
        for i in range(3)
    ]
    total = m.added(of(spark, batches[0]), of(spark, batches[1]), BY)
    total = m.added(total, of(spark, batches[2]), BY)
    check(total, sum(batches, []))
    check(m.withdrawn(total, of(spark, batches[1]), BY), batches[0] + batches[2])
    replaced = m.added(m.withdrawn(total, of(spark, batches[0]), BY), of(spark, batches[0][:7]), BY)
    check(replaced, batches[0][:7] + batches[1] + batches[2])


def test_nothing_left(spark):
    rows = [("a", 1.0), ("a", 2.0), ("b", 3.0), ("c", None)]
    assert {r.n for r in m.withdrawn(of(spark, rows), of(spark, rows), BY).collect()} == {0}
    assert m.moments(table(spark, []), "avg_temperature", BY).collect() == []
    check(m.added(of(spark, []), of(spark, rows), BY), rows)


def test_scores_equal_those_of_all_rows(spark):
    rng = random.Random(2)
    rows = [(f"d{i}", rng.choice("ab"), None, 1e6 + rng.gauss(0, 3) if i % 9 else None) for i in range(80)]
    rows += [("d", "same", None, 4.0)] * 3 + [("d", "one", None, 4.0), ("d", None, None, 1.0), ("e", None, None, 2.0)]
    silver = spark.createDataFrame(rows, "device_id string, site_id string, hour_bucket timestamp_ntz, avg_temperature double")
    half = [m.moments(silver.where(x), "avg_temperature", BY) for x in ("hash(device_id) % 2 = 0", "hash(device_id) % 2 <> 0")]
    got, want = (
        sorted(df.collect(), key=str)
        for df in (m.scored(silver, m.added(*half, BY)), anomaly.zscore_anomalies(silver))
    )
    for a, b in zip(got, want):
        assert a.device_id == b.device_id and a.is_anomaly == b.is_anomaly
        assert a.z_score == (None if b.z_score is None else pytest.approx(b.z_score, abs=1e-6))
