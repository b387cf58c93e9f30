import hashlib

import pytest

from fleetmeter.llm import decontamination as d
from text_rows import documents, texts, words

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"


def brute(text, items, window=13):
    w = words(text)
    hit, named = set(), set()
    for item_id, item in items:
        v = words(item)
        n = min(window, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                if item_id is not None:
                    named.add(str(item_id))
    return len(w), len(hit), sorted(named)


def found(spark, docs, items, **more):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = d.overlaps(docs, benchmark, **more).collect()
    return [(r.text, r.overlap_words, r.overlap_hits, r.overlap_items) for r in rows]


ITEMS = [
    (1, LONG),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu ending here"),
    (3, "two three"),
    (30, "Two, three!"),
    (4, "ten"),
    (5, None),
    (6, ""),
    (None, "eight nine"),
    (7, "a a a a a a a a a a a a a a a"),
    (7, "a a a a a a a a a a a a a a a"),
]
TEXTS = [
    f"before {LONG} after",
    " ".join(LONG.split()[2:15]),
    " ".join(LONG.split()[2:14]),
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu",
    "a " * 40,
    "one two three one two",
    "three two",
    f"{LONG} {LONG}",
    "",
    None,
]


@pytest.mark.parametrize("part_words", [d.PART_WORDS, 20, 1])
def test_equals_brute_force(spark, part_words):
    docs = texts(spark, TEXTS).union(documents(spark))
    for text, n, hits, names in found(spark, docs, ITEMS, part_words=part_words):
        assert (n, hits, names) == brute(text, ITEMS)


def test_without_items_or_documents(spark):
    assert {x[2] for x in found(spark, texts(spark, ["a b"]), [])} == {0}
    assert found(spark, texts(spark, []), ITEMS) == []


def test_columns_of_the_result_are_replaced_and_others_stay(spark):
    docs = texts(spark, ["ten"]).selectExpr("*", "'x' AS overlap_hits", "1 AS _marks")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    (row,) = d.overlaps(docs, benchmark).collect()
    assert row.overlap_hits == 1 and row._marks == 1 and row.source == "s"


def test_spans_are_cut_out(spark):
    docs = texts(spark, [f"Keep this. {LONG}, and this.", "nothing", None, LONG])
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = d.without_spans(d.overlaps(docs, benchmark)).collect()
    assert {r.doc_id: r.text for r in rows} == {
        0: "Keep this. , and this.",
        1: "nothing",
        2: None,
        3: "",
    }


def test_coverage(spark):
    filler = " ".join(f"w{i}" for i in range(300))
    docs = texts(spark, [LONG, f"{LONG} {filler}", filler])
    benchmark = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    rows = d.overlaps(docs, benchmark).withColumn("bad", d.contaminated()).collect()
    assert {r.doc_id: r.bad for r in rows} == {0: True, 1: True, 2: False}
    long = texts(spark, [f"{LONG} {filler} {filler}"])
    (row,) = d.overlaps(long, benchmark).withColumn("bad", d.contaminated()).collect()
    assert row.overlap_hits == 16 and not row.bad


def test_query_digest(spark, sf):
    from fleetmeter.llm.queries import QUERIES

    rows = QUERIES["op10_benchmark_decontamination"](spark, sf).where("n_items = 0").limit(3)
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.items_sha256 for r in rows.collect()} <= {empty}
