"""Compaction: which files it takes, and that rows, other files and readers are not touched."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.operators import compaction as c
from fleetmeter.operators import layout
from fleetmeter.session import cut_lineage

SCHEMA = T.StructType().add("hour", "timestamp_ntz").add("site", "string").add("value", "integer")
KEY = ["hour", "site"]
FILE = "file string, low struct<k: int>, high struct<k: int>, bytes bigint"


def at(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def add(spark, path, name, rows):
    return c.append(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, name)


def live(spark, path):
    return c.read_live(spark, path, SCHEMA)


def files(spark, path):
    return {r.file for r in live(spark, path).select("file").distinct().collect()}


def values(spark, path):
    return sorted(map(str, live(spark, path).select(*SCHEMA.names).collect()))


def taken(spark, rows, depth=2, small=10, target=100):
    table = cut_lineage(spark.createDataFrame([(f, (a,), (b,), n) for f, a, b, n in rows], FILE))
    bins = {}
    for row in c.files_to_rewrite(table, depth, small, target).collect():
        bins.setdefault(row.bin, set()).add(row.file)
    return sorted(map(sorted, bins.values()))


def test_deep_groups_only(spark):
    deep = [("a", 0, 9, 50), ("b", 1, 8, 50), ("c", 5, 12, 50)]
    flat = [("d", 20, 30, 50), ("e", 25, 40, 50), ("f", 50, 60, 50)]
    assert taken(spark, deep + flat) == [["a", "b", "c"]]
    assert taken(spark, flat) == [] and taken(spark, []) == []


def test_small_neighbours_are_binned(spark):
    small = [(f"s{i:02d}", 10 * i, 10 * i + 5, 5) for i in range(30)]
    got = taken(spark, small)
    # Twenty of five bytes make a bin of a hundred.
    assert got == [[f"s{i:02d}" for i in range(20)], [f"s{i:02d}" for i in range(20, 30)]]
    # A large file between them is not covered by a new one.
    assert taken(spark, [*small[:2], ("big", 16, 18, 70), *small[2:4]]) == [["s00", "s01"], ["s02", "s03"]]
    assert taken(spark, [small[0], ("big", 7, 8, 70), small[2]]) == []


def test_one_key_value_is_left_alone(spark):
    assert taken(spark, [(f"p{i}", 7, 7, 50) for i in range(5)]) == []


def test_groups_equal_a_sweep(spark):
    import random

    pick = random.Random(5)
    rows = []
    for i in range(600):
        low = pick.randrange(3000)
        rows.append((f"f{i:03d}", low, low + pick.randrange(1, 8), 50))
    components, reach = [], None
    for f, a, b, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        if reach is None or a > reach:
            components.append([])
        reach = b if reach is None else max(reach, b)
        components[-1].append((f, a, b))
    deep = [x for x in components if max(sum(a <= f[1] <= b for _, a, b in x) for f in x) > 2]
    got = taken(spark, rows, 2, 1, 10**9)
    assert sorted(f for g in got for f in g) == sorted(f[0] for x in deep for f in x) and len(deep) > 5


def test_rows_stay_and_only_deep_files_change(spark, tmp_path):
    path = f"{tmp_path}/t"
    for batch in range(5):
        add(spark, path, str(batch), [(at(h), s, batch) for h in range(40) for s in "xy"])
    add(spark, path, "far", [(at(h), "x", 9) for h in range(1000, 1040)])
    old, before = files(spark, path), values(spark, path)
    early = live(spark, path)
    size = live(spark, path).agg(F.min("bytes")).first()[0]
    far = {r.file for r in live(spark, path).filter("value = 9").select("file").distinct().collect()}
    limits = {"max_depth": 2, "small_bytes": size // 4, "target_bytes": size}
    assert c.compact(spark, path, SCHEMA, KEY, **limits) == 5
    now = files(spark, path)
    assert now & old == far and values(spark, path) == before
    depth = layout.file_depths(cut_lineage(layout.file_ranges(live(spark, path), KEY))).agg(F.max("depth")).first()[0]
    assert depth <= 2
    # A reader that began before still sees the table; a second run finds nothing to do.
    assert early.count() == len(before)
    assert c.compact(spark, path, SCHEMA, KEY, **limits) == 0
    assert c.remove_replaced(spark, path) == 5
    assert values(spark, path) == before and files(spark, path) == now


def test_broken_run_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    for batch in range(3):
        add(spark, path, str(batch), [(at(h), None, batch) for h in range(5)] + [(None, "x", batch)])
    assert not add(spark, path, "2", [(at(1), "x", 7)])
    before = values(spark, path)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(c.commits, "publish", broken)
        try:
            c.compact(spark, path, SCHEMA, KEY)
            raise AssertionError
        except OSError:
            pass
    assert values(spark, path) == before and c.remove_replaced(spark, path) == 0
    assert c.compact(spark, path, SCHEMA, KEY) == 3 and values(spark, path) == before
    assert len(files(spark, path)) == 1


def test_many_replaced_files_are_joined(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    for batch in range(3):
        add(spark, path, str(batch), [(at(h), "x", batch) for h in range(5)])
    before = values(spark, path)
    monkeypatch.setattr(c, "NAMED_FILES", 1)
    assert c.compact(spark, path, SCHEMA, KEY) == 3 and values(spark, path) == before


def test_replaced_files_are_not_opened(spark, tmp_path):
    path = f"{tmp_path}/t"
    for batch in range(3):
        add(spark, path, str(batch), [(at(h), "x", batch) for h in range(5)])
    c.compact(spark, path, SCHEMA, KEY)
    assert len(live(spark, path).select(*SCHEMA.names).inputFiles()) >= 1
    assert live(spark, path).select("value").rdd.getNumPartitions() == 1


def test_empty_table(spark, tmp_path):
    assert c.compact(spark, f"{tmp_path}/none", SCHEMA, KEY) == 0
    assert values(spark, f"{tmp_path}/none") == []
