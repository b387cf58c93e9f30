"""Committed batches and the consumers that take each of them once."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.sources import commits as c

LONG = T.LongType()
ROWS = T.StructType().add("id", LONG).add("day", T.IntegerType()).add("stamp", T.StringType())
SUMS = T.StructType().add("n", LONG).add("total", LONG)


class Broken(Exception):
    pass


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "source"), str(tmp_path / "target")


def batch(spark, *ids, stamp="2024-01-01"):
    return spark.createDataFrame([(i, i % 3, stamp) for i in ids], ROWS)


def ids(spark, path):
    return sorted(r.id for r in c.read_committed(spark, path, ROWS).collect())


def summed(new):
    return new.agg(F.count("*").alias("n"), F.sum("id").alias("total"))


def take(spark, place, work=summed, **more):
    return c.consume(spark, *place, "sums", ROWS, work, **more)


def sums(spark, place):
    return sorted((r.n, r.total) for r in c.read_committed(spark, place[1], SUMS).collect())


def test_a_batch_is_published_once(spark, place):
    assert c.publish(batch(spark, 1, 2), place[0], "a", ["day"])
    assert not c.publish(batch(spark, 7), place[0], "a", ["day"])
    assert c.publish(batch(spark, 3), place[0], "b/..x", ["day"])
    assert ids(spark, place[0]) == [1, 2, 3]
    named = c.read_committed(spark, place[0], ROWS, F.col("commit_id") == "b/..x")
    assert [(r.id, r.commit_id) for r in named.collect()] == [(3, "b/..x")]


def test_an_empty_table(spark, place):
    assert ids(spark, place[0]) == [] and take(spark, place) == [] and sums(spark, place) == []
    assert c.has_pending(spark, *place, "sums").first()["has_data"] is False


def test_a_batch_committed_late_is_taken(spark, place):
    """Stamps play no part: an older one, and one that is equal to a taken one."""
    c.publish(batch(spark, 1, stamp="2024-01-05"), place[0], "5")
    assert take(spark, place) == ["5"]
    c.publish(batch(spark, 2, stamp="2024-01-01"), place[0], "1")
    c.publish(batch(spark, 4, stamp="2024-01-05"), place[0], "5 again")
    assert c.has_pending(spark, *place, "sums").first()["has_data"] is True
    assert sorted(take(spark, place)) == ["1", "5 again"]
    assert take(spark, place) == [] and sums(spark, place) == [(1, 1), (2, 6)]


def test_what_a_broken_consumer_took_is_taken_again(spark, place):
    c.publish(batch(spark, 1, 2), place[0], "a")

    def breaks(new):
        assert new.count() == 2
        raise Broken

    with pytest.raises(Broken):
        take(spark, place, breaks)
    assert sums(spark, place) == []
    assert take(spark, place) == ["a"] and sums(spark, place) == [(2, 3)]


def test_output_without_a_marker_does_not_count(spark, place, tmp_path):
    """The output was written, but not its marker: neither it nor the position is there."""
    c.publish(batch(spark, 1, 2), place[0], "a")
    take(spark, place)
    for marker in (tmp_path / "target" / "commits").glob("*part-*"):
        marker.unlink()
    assert sums(spark, place) == []
    c.publish(batch(spark, 5), place[0], "b")
    assert take(spark, place) == ["a", "b"] and sums(spark, place) == [(3, 8)]
    assert len(c.remove_unnamed(spark, place[1])) == 1 and sums(spark, place) == [(3, 8)]


def test_consumers_do_not_disturb_each_other(spark, place, tmp_path):
    other = place[0], str(tmp_path / "other")
    for i in range(5):
        c.publish(batch(spark, i), place[0], f"b{i}")
    assert take(spark, place, max_batches=2) == ["b0", "b1"]
    assert take(spark, other) == [f"b{i}" for i in range(5)]
    assert take(spark, place, max_batches=2) == ["b2", "b3"]
    assert c.consume(spark, place[0], place[1], "second", ROWS, summed) == [f"b{i}" for i in range(5)]
    assert take(spark, place) == ["b4"] and sums(spark, place) == [(1, 4), (2, 1), (2, 5), (5, 10)]


def test_other_batches_are_not_read(spark, place, monkeypatch):
    for i in range(6):
        c.publish(batch(spark, i), place[0], f"b{i}")
    found = c.read_committed(spark, place[0], ROWS, F.col("commit_id") == "b2")
    assert [r.id for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "= b2-" in filters or "IN (b2-" in filters
    monkeypatch.setattr(c, "NAMED_PARTS", 3)
    assert ids(spark, place[0]) == list(range(6))


def test_two_markers_of_one_batch_count_once(spark, place):
    """Two writers of one batch at once: both wrote, one counts."""
    c.publish(batch(spark, 1, 2), place[0], "a")
    marker = c.commits(spark, place[0]).withColumn("part", F.lit("zz")).select(*c.COMMITS.names)
    marker.withColumn("committed_at", F.col("committed_at") + F.expr("INTERVAL 1 SECOND")).write.mode(
        "append"
    ).parquet(f"{place[0]}/commits")
    batch(spark, 1, 2).write.parquet(f"{place[0]}/data/part=zz")
    assert ids(spark, place[0]) == [1, 2] and take(spark, place) == ["a"]
