"""Array files read element by element over many tasks."""

import json
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmeter.sources import json_elements as e
from fleetmeter.sources import json_files, loads
from fleetmeter.sources.tables import read_table
from fleetmeter.schemas import LOADS

NOW = "2024-02-01 02:30:00"


def array(text):
    return np.frombuffer(text, np.uint8)


def plain(text):
    """The pieces of a text, character by character."""
    pieces, held, left, quoted, escaped, depth, outer = [], b"", "", False, False, 0, 0
    for i in range(len(text)):
        c = text[i : i + 1]
        mark, escaped = c == b'"' and not escaped, c == b"\\" and not escaped
        quoted ^= mark
        cut = None
        if not quoted and not mark:
            if c in b"[{":
                depth += 1
                if depth == 1:
                    outer, cut = c, "[" if c == b"[" else "o"
            elif c in b"]}":
                if depth == 1:
                    cut = "]" if outer == b"[" else "c"
                depth = max(0, depth - 1)
            elif c == b"," and depth == 1 and outer == b"[":
                cut = ","
        if cut == "c":
            held += c
        if cut:
            pieces.append((held, left, cut))
            held, left = (c if cut == "o" else b""), cut
        else:
            held += c
    return [*pieces, (held, left, None)]


def chunked(chunks):
    """The pieces of a text that is given in chunks, each cut by itself, put together."""
    state, pieces = (False, 0, 0), []
    for chunk in chunks:
        data = array(chunk)
        for i, (text, left, right) in enumerate(e.pieces_of(data, *state)):
            if i == 0 and pieces:
                pieces[-1] = (pieces[-1][0] + text, pieces[-1][1], right)
            else:
                pieces.append((text, left if pieces else "", right))
        state = e._entered(*state, e.effect_of(data, state[0]))
    return pieces


JSONISH = st.text('[]{}",:\\ a1é', max_size=40)


@settings(max_examples=500, deadline=None)
@given(JSONISH, st.lists(st.integers(0, 60), max_size=6))
def test_chunks_cut_like_the_whole(text, cuts):
    data = text.encode()
    # Text is only cut behind braces, so no escape is open there.
    places = sorted({i + 1 for i in range(len(data)) if data[i : i + 1] == b"}" and i in cuts})
    edges = [0, *places, len(data)]
    assert chunked([data[a:b] for a, b in zip(edges, edges[1:])]) == plain(data)


@settings(max_examples=500, deadline=None)
@given(JSONISH, JSONISH, JSONISH, st.booleans(), st.integers(0, 3))
def test_effects_compose(a, b, c, quoted, depth):
    texts = [x.encode() + b"}" for x in (a, b, c)]
    for parts in (texts, [texts[0] + texts[1], texts[2]], [texts[0], texts[1] + texts[2]]):
        state, whole = (quoted, depth, ord("[") if depth else 0), None
        for part in parts:
            own = [e.effect_of(array(part), q) for q in (False, True)]
            state = e._entered(*state, own[state[0]])
            whole = own[quoted] if whole is None else whole.then(own[whole.quoted])
        assert whole == e.effect_of(array(b"".join(texts)), quoted)
        assert e._entered(quoted, depth, ord("[") if depth else 0, whole) == state


NOTES = ['plain', 'a ] } , [ {', 'quote " and \\ and \\" end', 'Größe 日本語 😀', '\\', '"', '}{', '', '\n\t']
VALUES = [
    {"a": 1, "b": [1, [2, {"c": "}"}], {}], "n": NOTES[1]},
    [1, [2, 3], "x,y"], "text, with ] and }", 12.5, None, True, {}, [], {"d": {"e": {"f": []}}},
    *({"note": n, "k}": n} for n in NOTES),
]
VALID = {
    "compact": json.dumps(VALUES, separators=(",", ":"), ensure_ascii=False),
    "indented": json.dumps(VALUES, indent=3),
    "unicode": json.dumps(VALUES, ensure_ascii=False, indent=1) + "\n\n",
    "object": json.dumps({"readings": VALUES, "n": 1}),
    "empty": "[ ]",
    "number": " 123 ",
    "words": '"a } b"',
    "nested": json.dumps([[VALUES], [[]], VALUES]),
    "escapes": json.dumps([{"x": "\\" * n + '"' * (n % 3) + "}" * n} for n in range(12)]),
    "bom": "﻿" + json.dumps(VALUES),
    "ends with a brace": json.dumps({"a": {}}),
}


@pytest.fixture(params=[(None, 1 << 20), (None, 1), (250, 40)])
def reading(request, spark):
    """How files are split into tasks, and the size of chunks."""
    split, chunk = request.param
    name = "spark.sql.files.maxPartitionBytes"
    if split:
        spark.conf.set(name, split)
    yield chunk
    spark.conf.unset(name)


def write(folder, files):
    for name, text in files.items():
        data = text if isinstance(text, bytes) else text.encode()
        (folder / name).write_bytes(data)
    return str(folder)


def rows_of(df):
    """By file: the good rows as canonical JSON, sorted, and the texts set aside."""
    found = {}
    for r in df.select("file_name", F.to_json("json_data").alias("j"), "raw", "error", "ok").collect():
        good, bad = found.setdefault(r.file_name, ([], []))
        assert r.ok == (r.error is None) == (r.raw is None)
        if r.ok:
            good.append(r.j)
        else:
            bad.append((r.raw, r.error))
    return {name: (sorted(good), bad) for name, (good, bad) in found.items()}


@pytest.mark.parametrize("reading", [(None, 1), (250, 40)], indirect=True)
def test_valid_files_equal_reading_them_whole(spark, tmp_path, reading):
    path = write(tmp_path, VALID)
    whole = json_files.parse_loads(json_files.read_raw(spark, path), NOW)
    want = {k: v for k, v in rows_of(whole).items() if k != "bom"}
    got = rows_of(e.load_elements(spark, path, NOW, chunk_bytes=reading))
    assert got.pop("bom") == want["compact"] and got == want
    assert all(not bad for _, bad in want.values())


ONE = '{"id": 1, "s": "x"}'
DAMAGED = {
    # text: number of good rows, what is set aside
    "cut.json": (f'[{ONE}, {ONE}, {{"id": 3, "s"', 2, (' {"id": 3, "s"', e.UNFINISHED)),
    "no end": (f"[{ONE}, {ONE}", 2, ("", e.UNFINISHED)),
    "no end but a brace": (f"[{ONE}, {ONE}\n", 2, ("", e.UNFINISHED)),
    "cut number": ("[1, 2, 3", 2, (" 3", e.UNFINISHED)),
    "joined": (f"[{ONE}][{ONE}, {ONE}]\n[]", 3, None),
    "lines": (f"{ONE}\n{ONE}\n{ONE}", 3, None),
    "bad in the middle": (f'[{ONE}, {{"id" 7}}, {ONE}, tru, {ONE}]', 3, (' {"id" 7}\n tru', e.BAD_JSON)),
    "missing": (f"[{ONE},, {ONE},]", 2, ("", e.BAD_JSON)),
    "behind": (f"[{ONE}] x", 1, (" x", e.BAD_JSON)),
    "too many": (f"[{ONE}]] [{ONE}]", 2, ("] ", e.BAD_JSON)),
    "endless string": (f'[{ONE}, {{"id": "1}}, {ONE}]', 1, (f' {{"id": "1}}, {ONE}]', e.UNFINISHED)),
    "wrong bracket": (f'[{ONE}, {{"id": [1}}}}, {ONE}]', 2, (' {"id": [1}}', e.BAD_JSON)),
    "text": ("no JSON at all } here", 0, ("no JSON at all } here", e.BAD_JSON)),
    "blank": (" \n ", 0, None),
    "nothing": ("", 0, None),
    "half an object": ('{"a": {"b": 1}', 0, ('{"a": {"b": 1}', e.UNFINISHED)),
}


def test_damaged_files_give_their_good_elements(spark, tmp_path, reading):
    path = write(tmp_path, {k: v[0] for k, v in DAMAGED.items()})
    got = rows_of(e.load_elements(spark, path, NOW, chunk_bytes=reading))
    for name, (_, good, aside) in DAMAGED.items():
        rows, bad = got.get(name, ([], []))
        assert len(rows) == good, name
        assert bad == ([] if aside is None else [aside]), name


def test_what_is_too_long_is_set_aside_in_parts(spark, tmp_path):
    text = "[" + ONE + ', {"a": "' + "x}" * 500 + '"}, ' + ONE + ", {bad}, {bad}]"
    path = write(tmp_path, {"f": text})
    rows = e.load_elements(spark, path, NOW, chunk_bytes=100, max_bytes=300)
    good, bad = rows_of(rows)["f"]
    assert len(good) == 2 and len(bad) > 2
    joined = "".join(raw for raw, _ in bad)
    assert joined.count("x}") == 500 and joined.count("{bad}") == 2 and len(joined) < 1100


def test_a_file_is_shared_by_many_tasks(spark, tmp_path):
    """One line, many tasks, and no window or sort over its text."""
    path = write(tmp_path, {"f": json.dumps([{"i": i, "s": "}" * (i % 5)} for i in range(3000)])})
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        assert os.path.getsize(f"{path}/f") > 12 * 4096
        chunks = e._chunks(spark, path, None, 1000)
        assert chunks.select("block").distinct().count() >= 12
        good, bad = rows_of(e.load_elements(spark, path, NOW, chunk_bytes=1000))["f"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(json.loads(x)["i"] for x in good) == list(range(3000)) and not bad


def test_elements_are_parsed_once(spark, tmp_path):
    """What is good and what is set aside is read from stored results of one parse."""
    path = write(tmp_path, {"good": f"[{ONE}, {ONE}]", "bad": f'[{ONE}, {{"id" 7}}]'})
    loaded = e.load_elements(spark, path, NOW)
    assert "from_json" not in loaded._jdf.queryExecution().optimizedPlan().toString()
    assert {k: len(good) for k, (good, _) in rows_of(loaded).items()} == {"good": 2, "bad": 1}


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    count, name = 200, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    for i in range(count):
        (tmp_path / f"d{i}").mkdir()
        write(tmp_path / f"d{i}", {"f": f"[{ONE}]"})
    before, tracker = spark.conf.get(name), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listed", "")
    try:
        chunks = e._chunks(spark, str(tmp_path), None, 1000)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listed")]
    tasks = [tracker.getStageInfo(i).numTasks for j in jobs for i in j.stageIds]
    assert tasks and max(tasks) < count
    assert chunks.select("file_name").distinct().count() == count and spark.conf.get(name) == before


def test_files_are_walked_across_batches(spark, tmp_path):
    """Many files a task and many blocks a file: states come in one pass, wherever batches end."""
    none = e.Effect(False)._asdict()
    opens = e.Effect(False, 1, 0, ord("["))._asdict()
    rows = [
        {"file_name": f"f{i}", "block": b * 100, "file_size": 300, "bytes": 100, "last_seq": 0,
         "effect": [opens if b == 0 else none] * 2, "unclosed": [none] * 2}
        for i in range(5) for b in range(3)
    ]
    batches = [e.pa.RecordBatch.from_pylist(rows[i : i + 4]) for i in range(0, len(rows), 4)]
    states = [s for batch in e._walk(iter(batches)) for s in batch.to_pylist()]
    assert [(s["file_name"], s["block"], s["depth"]) for s in states] == [
        (f"f{i}", block, depth) for i in range(5) for block, depth in ((0, 0), (100, 1), (200, 1), (-1, 1))
    ]


def test_a_load_of_elements_in_parts(spark, tmp_path):
    """Files in loads of two at most; a damaged one is logged as partially loaded."""
    landing = tmp_path / "landing"
    landing.mkdir()
    write(landing, {f"{i}.json": f"[{ONE}, {ONE}" + ("]" if i != 3 else ', {"id"') for i in range(5)})
    paths = str(landing), str(tmp_path / "loads"), str(tmp_path / "log")
    log = loads.load_files(spark, *paths, NOW, "elements", max_files=2)
    assert {r.file_name: (r.status, r.row_count, r.error_count) for r in log.collect()} == {
        f"{i}.json": ("PARTIALLY_LOADED", 3, 1) if i == 3 else ("LOADED", 2, 0) for i in range(5)
    }
    assert log.select("load_id").distinct().count() == 3
    assert loads.loaded_rows(spark, *paths[1:]).where("ok").count() == 10
    assert loads.load_files(spark, *paths, NOW, "elements").collect() == []
    again = loads.load_files(spark, *paths, "2024-02-02 00:00:00", "elements", force=True, max_files=4)
    assert again.count() == 5 and again.select("load_id").distinct().count() == 2


def test_no_files(spark, tmp_path):
    assert e.load_elements(spark, str(tmp_path), NOW).collect() == []
    assert e.load_elements(spark, str(tmp_path), NOW).schema.names == LOADS.names
    assert read_table(spark, str(tmp_path), LOADS).count() == 0
