import json

import pytest
from pyspark.sql import functions as F

from fleetmeter.functions.payload import extract_readings
from fleetmeter.operators.silver import silver_hourly
from fleetmeter.schemas import BRONZE, LOADS
from fleetmeter.sources import csv_files, json_files, loads

AT = "2024-02-01 00:00:00"


def reading(**changes):
    base = {
        "device_id": "dev-001",
        "site_id": "Factory_A",
        "timestamp": "2024-01-01T10:20:00+00:00",
        "temperature": 5.0,
        "humidity": 50.0,
        "battery_pct": 80.0,
        "signal_rssi": -60,
        "uptime_hours": 1000.0,
        "data_usage_mb": 1.5,
        "alert_type": None,
        "alert_severity": None,
    }
    return {**base, **changes}


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def load(spark, folder, layout="whole"):
    return json_files.parse_loads(json_files.read_raw(spark, str(folder), layout), AT)


def devices(loads_):
    rows = json_files.bronze_rows(loads_)
    found = rows.select(F.expr("variant_get(json_data, '$.device_id', 'string') AS d")).collect()
    return sorted(r.d for r in found)


@pytest.mark.parametrize("indent", [None, 1, 2, 4])
def test_array_file_of_any_indent(spark, tmp_path, indent):
    rows = [reading(device_id=f"d{i}") for i in range(3)]
    put(tmp_path / "in", "arr.json", json.dumps(rows, indent=indent))
    out = load(spark, tmp_path / "in")
    assert out.schema.names == LOADS.names
    assert devices(out) == ["d0", "d1", "d2"]
    assert json_files.quarantine_rows(out).count() == 0


def test_one_object_over_several_lines(spark, tmp_path):
    put(tmp_path / "in", "obj.json", '{"device_id": "d1",\n "nested": {"a": [1, {"b": 2}]}}\n')
    assert devices(load(spark, tmp_path / "in")) == ["d1"]


def test_object_per_line(spark, tmp_path):
    text = "\n".join(json.dumps(reading(device_id=d)) for d in ("d1", "d2")) + "\n\n"
    put(tmp_path / "in", "nd.json", text)
    assert devices(load(spark, tmp_path / "in", "lines")) == ["d1", "d2"]


def test_broken_line_is_set_aside_and_the_rest_loaded(spark, tmp_path):
    good = json.dumps(reading(device_id="d1"))
    put(tmp_path / "in", "nd.json", f'{good}\n{{"device_id": "d2\n{good}\n')
    out = load(spark, tmp_path / "in", "lines")
    assert devices(out) == ["d1", "d1"]
    bad = json_files.quarantine_rows(out).collect()
    assert [(r.raw, r.error, r.file_name) for r in bad] == [
        ('{"device_id": "d2', "not valid JSON", "nd.json")
    ]


@pytest.mark.parametrize("layout", ["whole", "lines"])
@pytest.mark.parametrize(
    "text",
    [
        '{"a": 1}{"b": 2}', '{"a": 1} x', '{"a": 1}] {"b": 2}', '{"a": 1}, {"b": 2}',
        '[{"a": 1}] [{"b": 2}]', '[{"a": 1}] x', '[{"a": 1}', '[{"a": 1},]', "{'a': 1}",
        '{"a": NaN}', '{"a": 1', "]", "[", "}", '"a" "b"',
    ],
)
def test_text_that_is_not_one_document_is_set_aside(spark, tmp_path, layout, text):
    put(tmp_path / "in", "x.json", text)
    out = load(spark, tmp_path / "in", layout).collect()
    assert [(r.ok, r.raw) for r in out] == [(False, text)]


def test_lines_read_whole_are_not_lost(spark, tmp_path):
    text = "\n".join(json.dumps(reading(device_id=d)) for d in ("d1", "d2")) + "\n"
    put(tmp_path / "in", "nd.json", text)
    bad = json_files.quarantine_rows(load(spark, tmp_path / "in")).collect()
    assert [r.raw for r in bad] == [text]


def test_truncated_array_read_whole_gives_one_bad_row(spark, tmp_path):
    text = json.dumps([reading(), reading()])
    put(tmp_path / "in", "bad.json", text[:-30])
    out = load(spark, tmp_path / "in", "whole")
    assert [r.ok for r in out.collect()] == [False]


@pytest.mark.parametrize(
    "text, good",
    [
        ("}", 0),
        ('"device_id": "d1", "temperature": 1.0}', 0),
        ("[", 0),
        ('{"readings": [\n  {"device_id": "d1"},\n  {"device_id": "d2"}\n]}', 1),
        ('[\n  {"device_id": "d1"},\n  {"device_id": "d2"}\n', 0),
        ('[\n  {"device_id": "d1"}\n  {"device_id": "d2"}\n]', 0),
        ('  {"device_id": "d1"}\n  {"device_id": "d2"}\n', 0),
        ('[\n  {"device_id": "d1"},\n  {"device_id": "d2"}\n]', 2),
    ],
)
def test_a_file_is_one_document_or_set_aside_as_it_is(spark, tmp_path, text, good):
    put(tmp_path / "in", "x.json", text)
    rows = load(spark, tmp_path / "in").collect()
    assert [r.ok for r in rows] == [True] * good or ([r.raw for r in rows] == [text] and not good)


def test_subfolders_and_equal_names(spark, tmp_path):
    for folder, device in (("", "d0"), ("a b+c%20", "d1"), ("x/y", "d2")):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        put(tmp_path / "in" / folder, "part-0.json", json.dumps(reading(device_id=device)))
    out = load(spark, tmp_path / "in")
    assert devices(out) == ["d0", "d1", "d2"]
    names = ["a b+c%20/part-0.json", "part-0.json", "x/y/part-0.json"]
    assert sorted(r.file_name for r in out.collect()) == names
    listed = json_files.list_files(spark, str(tmp_path / "in"))
    assert sorted(r.file_name for r in listed.collect()) == names
    one = load(spark, tmp_path / "in" / "x" / "y" / "part-0.json")
    assert [r.file_name for r in one.collect()] == ["part-0.json"]
    assert json_files.peek(spark, str(tmp_path / "in")).count() == 3


def test_load_files(spark, tmp_path):
    landing, stored, log = (str(tmp_path / x) for x in ("in", "loads", "log"))

    def run(at, **more):
        return {r.file_name: r for r in loads.load_files(spark, landing, stored, log, at, **more).collect()}

    def device_list():
        return devices(loads.loaded_rows(spark, stored, log))

    for folder, device in (("a", "d1"), ("b", "d2")):
        put(tmp_path / "in", "z", "[]")
        put(tmp_path / "in" / folder, "part-0.json", json.dumps([reading(device_id=device)]))
    put(tmp_path / "in" / "a", "bad.json", "{")
    first = run("2024-02-01 00:00:00")
    assert {n: (r.status, r.row_count, r.error_count) for n, r in first.items()} == {
        "z": ("LOADED", 0, 0),
        "a/part-0.json": ("LOADED", 1, 0),
        "b/part-0.json": ("LOADED", 1, 0),
        "a/bad.json": ("LOAD_FAILED", 1, 1),
    }
    assert device_list() == ["d1", "d2"]
    assert run("2024-02-01 01:00:00") == {}
    put(tmp_path / "in" / "c", "part-0.json", json.dumps(reading(device_id="d3")))
    assert list(run("2024-02-01 02:00:00")) == ["c/part-0.json"]
    assert device_list() == ["d1", "d2", "d3"]
    # A load without its log does not count, and is done again.
    put(tmp_path / "in" / "d", "part-0.json", json.dumps(reading(device_id="d4")))
    before = sorted((tmp_path / "log").iterdir())
    run("2024-02-01 03:00:00")
    for file in set((tmp_path / "log").iterdir()) - set(before):
        file.unlink()
    assert device_list() == ["d1", "d2", "d3"]
    assert list(run("2024-02-01 03:00:00")) == ["d/part-0.json"]
    assert device_list() == ["d1", "d2", "d3", "d4"]
    assert len(run("2024-02-01 04:00:00", force=True)) == 6
    assert device_list() == sorted(["d1", "d2", "d3", "d4"] * 2)
    # After 64 days all files are new again.
    assert len(run("2024-06-01 00:00:00")) == 6


def test_known_files_are_not_opened(spark, tmp_path):
    for i in range(4):
        put(tmp_path / "in", f"f{i}.json", json.dumps(reading()))
    listed = json_files.list_files(spark, str(tmp_path / "in"))
    paths = [r.full_path for r in listed.collect() if r.file_name == "f2.json"]
    pieces = json_files.read_raw(spark, str(tmp_path / "in"), only=paths)
    assert [r.file_name for r in pieces.collect()] == ["f2.json"]
    text = pieces._jdf.queryExecution().executedPlan()
    pieces.collect()
    scan = text.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() <= 1


@pytest.mark.parametrize("text", ["", "\n \n", "[]", "[\n]"])
def test_file_without_readings_gives_no_rows(spark, tmp_path, text):
    put(tmp_path / "in", "empty.json", text)
    assert load(spark, tmp_path / "in").count() == 0


def test_one_large_file_of_lines_is_shared_by_tasks(spark, tmp_path):
    rows = [reading(device_id=f"d{i}", note="a, [b]}") for i in range(3000)]
    put(tmp_path / "in", "big.json", "\n".join(json.dumps(r) for r in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        out = load(spark, tmp_path / "in", "lines")
        assert out.rdd.getNumPartitions() > 4
        assert devices(out) == sorted(r["device_id"] for r in rows)
        assert json_files.quarantine_rows(out).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bronze_has_declared_columns_and_file_name(spark, tmp_path):
    put(tmp_path / "in", "iot_batch_20260317.json", json.dumps([reading()]))
    bronze = json_files.read_bronze(spark, str(tmp_path / "in"), loaded_at=AT)
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in BRONZE]
    row = bronze.select("file_name", "loaded_at").first()
    assert (row.file_name, str(row.loaded_at)) == ("iot_batch_20260317.json", AT)


def extracted(spark, on_bad_value="fail", **changes):
    raw = json.dumps(reading(**changes))
    bronze = spark.createDataFrame([(raw,)], "raw string").select(
        F.parse_json("raw").alias("json_data")
    )
    return extract_readings(bronze, on_bad_value=on_bad_value)


def test_bad_number_fails_or_becomes_null(spark):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        extracted(spark, humidity="x").collect()
    assert extracted(spark, "null", humidity="x").first().humidity is None


def test_number_delivered_as_text_is_read(spark):
    assert extracted(spark, temperature="3.5").first().temperature == 3.5


def test_unknown_date_format_keeps_the_row_with_null_hour(spark):
    rows = extracted(spark, timestamp="1/15/2015 19:05")
    assert rows.first().reading_time is None
    hourly = silver_hourly(rows, AT).collect()
    assert [(r.hour_bucket, r.record_count) for r in hourly] == [(None, 1)]


def test_offset_keeps_the_wall_clock(spark):
    assert str(extracted(spark, timestamp="2024-01-01T14:45:00+07:00").first().reading_time) == (
        "2024-01-01 14:45:00"
    )


def test_missing_and_new_payload_fields_do_not_break_extraction(spark):
    raw = spark.createDataFrame([('{"device_id": "d1", "firmware": "2.0"}',)], "raw string")
    row = extract_readings(raw.select(F.parse_json("raw").alias("json_data"))).first()
    assert (row.device_id, row.temperature, row.reading_time) == ("d1", None, None)


def test_csv_with_more_and_with_fewer_columns(spark, tmp_path):
    put(tmp_path / "in", "a.csv", ",".join(map(str, range(19))) + "\n1/15/2015 19:05,x\n")
    names = ["a", "b", "c", "d", "e", "f"]
    rows = csv_files.read_csv_raw(spark, str(tmp_path / "in"), names)
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("0", "1", "2", "3", "4", "5"),
        ("1/15/2015 19:05", "x", None, None, None, None),
    ]


def test_loaded_files_are_skipped_unless_forced_or_forgotten(spark):
    incoming = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "file_name string, v int")
    log = spark.sql(
        "SELECT * FROM VALUES ('a', timestamp_ntz'2024-01-31 00:00:00'),"
        " ('b', timestamp_ntz'2023-11-01 00:00:00') AS t(file_name, loaded_at)"
    )
    new = loads.only_new_files(incoming, log, AT)
    assert new.columns == incoming.columns
    assert sorted(r.v for r in new.collect()) == [3, 4]
    many = loads.only_new_files(incoming, log, AT, broadcast_rows=0)
    assert sorted(r.v for r in many.collect()) == [3, 4]
    assert loads.only_new_files(incoming, log, AT, force=True).count() == 4


def test_load_history_states_and_time_limit(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES"
        " ('good', true, null, timestamp_ntz'2024-01-31 00:00:00'),"
        " ('half', true, null, timestamp_ntz'2024-01-31 00:00:00'),"
        " ('half', false, 'not valid JSON', timestamp_ntz'2024-01-31 00:00:00'),"
        " ('bad', false, 'not valid JSON', timestamp_ntz'2024-01-31 00:00:00'),"
        " ('old', true, null, timestamp_ntz'2024-01-01 00:00:00')"
        " AS t(file_name, ok, error, loaded_at)"
    )
    got = {r.file_name: r for r in loads.load_history(rows, AT).collect()}
    assert {k: r.status for k, r in got.items()} == {
        "good": "LOADED",
        "half": "PARTIALLY_LOADED",
        "bad": "LOAD_FAILED",
    }
    assert (got["half"].row_count, got["half"].error_count) == (2, 1)
    assert got["good"].first_error_message is None


def test_peek_gives_raw_lines_with_file_names(spark, tmp_path):
    put(tmp_path / "in", "a.json", "\n".join("abcdefghijklmnop"))
    got = json_files.peek(spark, str(tmp_path / "in")).collect()
    assert len(got) == 10 and {r.file_name for r in got} == {"a.json"}
