"""Tables along a space-filling curve: same rows, and filters on each key skip files."""

import datetime as dt

from pyspark.sql import functions as F

from fleetmeter.operators import curve, layout

KEYS = ["hour", "site", "device"]
SCHEMA = "hour timestamp_ntz, site string, device string, value int"


def rows(hours=48, sites=8, devices=48):
    start = dt.datetime(2024, 3, 31)
    return [
        (start + dt.timedelta(hours=h), f"site-{s}", f"device-{d:03d}", h * s + d)
        for h in range(hours) for s in range(sites) for d in range(devices)
    ]


def shares(spark, path):
    table = layout.with_file(spark.read.schema(SCHEMA).parquet(path))
    bounds = curve.file_bounds(table, KEYS)
    asked = {"hour": ("2024-04-01", "2024-04-01"), "site": ("site-3", "site-3"), "device": ("device-017", "device-017")}
    return {k: curve.share_of_files(bounds, k, *asked[k]).first() for k in KEYS}


def test_all_filters_skip_files(spark, tmp_path):
    table = spark.createDataFrame(rows(), SCHEMA)
    curve.write_curve_layout(table, f"{tmp_path}/curve", KEYS, files=64)
    plain = table.repartitionByRange(64, "site", "hour", "device").sortWithinPartitions("site", "hour", "device")
    plain.write.parquet(f"{tmp_path}/plain")
    got, before = shares(spark, f"{tmp_path}/curve"), shares(spark, f"{tmp_path}/plain")
    assert {x.files for x in [*got.values(), *before.values()]} == {64}
    # Sorted by site, then hour: a device filter opens all files. On the curve it is a quarter for
    # each key if files and cells meet exactly; a file that begins in one cell and ends in the next
    # covers more.
    assert before["device"].share == 1.0
    assert all(got[k].share <= 0.5 for k in KEYS), got
    stored = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/curve")
    assert sorted(map(tuple, stored.collect())) == sorted(rows())


def test_hot_key_is_cut(spark, tmp_path):
    same = [(dt.datetime(2024, 1, 1), "one", "one", i) for i in range(6000)]
    table = spark.createDataFrame(same + rows(24, 5, 50), SCHEMA)
    curve.write_curve_layout(table, f"{tmp_path}/t", KEYS, files=16)
    stored = layout.with_file(spark.read.schema(SCHEMA).parquet(f"{tmp_path}/t"))
    sizes = [r["count"] for r in stored.groupBy("file").count().collect()]
    assert sum(sizes) == 12000 and max(sizes) < 2500


def test_nulls_empty_tables_and_other_types(spark, tmp_path):
    some = [(None, "a", None, 1), (None, None, None, None), (dt.datetime(2024, 1, 1), "", "d", 2)] * 2
    for name, data in (("some", some), ("none", [])):
        curve.write_curve_layout(spark.createDataFrame(data, SCHEMA), f"{tmp_path}/{name}", KEYS, files=3)
        stored = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/{name}")
        assert sorted(map(str, map(tuple, stored.collect()))) == sorted(map(str, data))
    numbers = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").cast("double").alias("b"))
    curve.write_curve_layout(numbers, f"{tmp_path}/n", ["a", "b"], files=8)
    assert spark.read.parquet(f"{tmp_path}/n").count() == 1000


def test_interleaving(spark):
    table = spark.createDataFrame([(5, 3), (0, 0), (7, 7), (4, 0)], "a int, b int")
    got = table.select(curve.interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect()
    assert [r.z for r in got] == [0b100111, 0, 0b111111, 0b100000]


def test_bounds_cover_more_rows_than_the_sample(spark, monkeypatch):
    monkeypatch.setattr(curve, "SAMPLE_ROWS", 500)
    bounds = curve.quantile_bounds(spark.range(20_000).toDF("a"), ["a"], 3)["a"]
    assert len(bounds) == 7 and all(abs(b - 2500 * (i + 1)) < 1500 for i, b in enumerate(bounds))
