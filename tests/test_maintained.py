"""The KPI view kept by signed rows against a recompute."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetmeter.operators import gold, maintained as m
from fleetmeter.schemas import GOLD_KEYS, SILVER

HOURS = [dt.datetime(2024, 1, 1, h) for h in range(3)] + [None]


def row(rng, n):
    temperature = rng.choice([None, 1.0, 2.0, 3.5, 9.0])
    return (
        f"d{rng.randrange(4)}" if n % 11 else None, rng.choice("ab"), rng.choice(HOURS), temperature,
        temperature, temperature, 50.0 + n % 3, 50.0, 50.0, rng.choice([None, 10.0, 20.0]), -50, 1.5, 0.25,
        1 + n % 4, n % 2 == 0, n % 3 == 0, dt.datetime(2024, 2, 1),
    )


def table(spark, rows, sign=None):
    made = spark.createDataFrame(rows, SILVER)
    return made if sign is None else made.withColumn("sign", F.lit(sign))


def rows_of(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def wanted(spark, rows):
    return gold.fleet_metrics(table(spark, rows))


def change(spark, old, minus, plus):
    left = list(old)
    for r in minus:
        left.remove(r)
    delta = table(spark, minus, -1).unionByName(table(spark, plus, 1))
    after = left + plus
    return after, m.apply_change(m.maintained(table(spark, old)), delta, table(spark, after))


@pytest.mark.parametrize("seed", range(2))
def test_random_changes_equal_a_recompute(spark, seed):
    rng = random.Random(seed)
    old = [row(rng, n) for n in range(60)]
    minus, plus = rng.sample(old, 25), [row(rng, n) for n in range(100, 120)]
    after, found = change(spark, old, minus, plus)
    view = m.kpis(found.view)
    names = view.columns
    assert rows_of(view) == rows_of(wanted(spark, after).select(*names))
    # The state is the one that the rows give, so the next change can be added to it.
    fresh = m.maintained(table(spark, after))
    assert rows_of(found.view.state) == rows_of(fresh.state.select(*found.view.state.columns))
    assert rows_of(found.view.devices) == rows_of(fresh.devices)
    # What changed, from the touched groups alone.
    a, b = set(rows_of(wanted(spark, old))), set(rows_of(wanted(spark, after)))
    stats = m.change_stats(found).first()
    assert (stats.rows_added, stats.rows_removed) == (len(b - a), len(a - b))


def at(hour, temperature, device="d1"):
    rng = random.Random(1)
    r = list(row(rng, 1))
    r[0], r[1], r[2], r[3], r[4], r[5] = device, "a", HOURS[hour], temperature, temperature, temperature
    return tuple(r)


def test_only_hours_that_lose_their_extreme_are_read_again(spark):
    old = [at(0, 1.0), at(0, 5.0), at(0, 5.0), at(1, 2.0), at(1, 7.0), at(2, 3.0)]
    # One of two rows of the maximum goes; the only one goes; a higher one comes instead.
    for minus, plus, hours in (
        ([at(0, 5.0)], [], []),
        ([at(1, 7.0)], [], [HOURS[1]]),
        ([at(1, 7.0)], [at(1, 8.0)], []),
        ([at(0, 1.0), at(1, 7.0)], [at(0, 0.5), at(1, 7.0)], []),
        ([at(2, 3.0)], [], []),
    ):
        after, found = change(spark, old, minus, plus)
        assert [r.analysis_hour for r in found.recomputed.collect()] == hours
        view = m.kpis(found.view)
        assert rows_of(view) == rows_of(wanted(spark, after).select(*view.columns))


def test_a_change_that_changes_nothing(spark):
    old = [at(0, 1.0), at(1, 2.0, None)]
    after, found = change(spark, old, [at(0, 1.0)], [at(0, 1.0)])
    assert tuple(m.change_stats(found).first()) == (0, 0)
    empty = m.apply_change(m.maintained(table(spark, [])), table(spark, old, 1), table(spark, old))
    assert tuple(m.change_stats(empty).first()) == (2, 0)
    gone = m.apply_change(m.maintained(table(spark, old)), table(spark, old, -1), table(spark, []))
    assert m.kpis(gone.view).collect() == [] and tuple(m.change_stats(gone).first()) == (0, 2)


def test_the_table_is_read_only_for_lost_extremes(spark):
    """The plan of the change joins the table with the few groups that lost an extreme."""
    old = [at(0, 1.0), at(0, 5.0)]
    _, found = change(spark, old, [at(0, 5.0)], [])
    assert found.recomputed.columns == GOLD_KEYS and found.recomputed.count() == 1
