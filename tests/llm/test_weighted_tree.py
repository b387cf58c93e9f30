import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetmeter.llm import ranges, weighted_tree as w
from text_rows import documents, texts


def shards_of(spark, tree, n=4000):
    rows = spark.range(n).select(F.col("id"), w.shard_of(F.col("id"), tree).alias("shard"))
    return {r.id: r.shard for r in rows.collect()}


def test_awkward_rows(spark):
    docs = documents(spark).selectExpr("*", "1 AS shard", "2 AS `_range`", "3 AS size")
    rows = w.sharded(docs, 16).collect()
    given = docs.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
        for r in given
    )
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
        assert r.grown_shard in (r.shard, 16)
    for of_shard in by_shard.values():
        in_order = sorted(of_shard, key=lambda r: r.slot)
        assert [r.slot for r in in_order] == list(range(len(of_shard)))
        keys = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for r in in_order]
        assert keys == sorted(keys)


def test_slots_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranges, "ROWS_PER_RANGE", 7)
    monkeypatch.setattr(w, "range_bounds", lambda df, c: ranges.range_bounds(df, c, 7))
    rows = w.sharded(texts(spark, [f"t{i % 5}" for i in range(300)]), 16).collect()
    for shard in range(16):
        slots = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in slots] == list(range(len(slots)))
        assert [d for _, d in slots] == sorted(d for _, d in slots)


def test_empty_table(spark):
    assert w.sharded(texts(spark, []), 16).collect() == []


def test_even_shards_and_growth(spark):
    before, after = shards_of(spark, w.tree_of(16)), shards_of(spark, w.tree_of(17, 16))
    counts = Counter(before.values())
    assert set(counts) == set(range(16)) and 190 < min(counts.values()) and max(counts.values()) < 320
    moved = [k for k in before if before[k] != after[k]]
    assert {after[k] for k in moved} == {16} and 150 < len(moved) < 330


def test_one_law_for_every_number_of_shards(spark):
    """One more shard takes keys from all others and nothing else moves, from 1 to 41 shards."""
    counts = [1, 2, 3, 7, 8, 14, 15, 16, 17, 18, 25, 39, 40, 41]
    counts = sorted({n for c in counts for n in (c, c + 1)})
    rows = spark.range(3000).select("id", *(w.placed(F.col("id"), n).alias(f"n{n}") for n in counts)).collect()
    for a, b in zip(counts, counts[1:]):
        before, after = [r[f"n{a}"] for r in rows], [r[f"n{b}"] for r in rows]
        assert all(x == y or y >= a for x, y in zip(before, after))
        sizes = Counter(after)
        assert set(sizes) == set(range(b)) and max(sizes.values()) < 3000 / b * 1.7 + 15
        assert min(sizes.values()) > 3000 / b * 0.5 - 12


def test_grown_is_the_law_of_one_more(spark):
    docs = texts(spark, [f"t{i}" for i in range(500)])
    for n in (3, 15, 16, 17):
        grown = {r.doc_id: r.grown_shard for r in w.sharded(docs, n).collect()}
        assert grown == {r.doc_id: r.shard for r in w.sharded(docs, n + 1).collect()}


def test_a_changed_weight_moves_only_inside_the_subtrees_that_change(spark):
    tree = w.tree_of(16)
    heavier = [x._replace(weight=3.0) if x.shard == 5 else x for x in tree]
    before, after = shards_of(spark, tree), shards_of(spark, heavier)
    region = {x.shard: x.region for x in tree}
    own = region[5]
    moved = [(before[k], after[k]) for k in before if before[k] != after[k]]
    # Between regions only into the heavier one; the others' inner order is untouched.
    assert moved and all(region[b] == own for _, b in moved)


def test_weights(spark):
    tree = [w.Leaf("a", "r", 0, 1.0), w.Leaf("a", "s", 1, 3.0), w.Leaf("b", "r", 2, 4.0),
            w.Leaf("c", "r", 3, 0.0)]
    counts = Counter(shards_of(spark, tree).values())
    assert 3 not in counts
    for shard, share in ((0, 1 / 8), (1, 3 / 8), (2, 1 / 2)):
        assert abs(counts[shard] / 4000 - share) < 0.03


@pytest.mark.parametrize("bounds", [[], [5], [1, 5, 9], list(range(0, 1000, 3))])
def test_range_numbers(spark, bounds):
    rows = spark.range(-3, 1010).selectExpr("id AS v").union(spark.sql("SELECT CAST(NULL AS LONG)"))
    for r in rows.select("v", ranges.range_number(F.col("v"), bounds).alias("n")).collect():
        assert r.n == sum(b <= r.v for b in bounds if r.v is not None)


def test_native(spark):
    plan = w.sharded(texts(spark, ["a"]), 16)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
