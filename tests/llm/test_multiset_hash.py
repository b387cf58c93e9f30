import hashlib

import pytest
from pyspark.sql import functions as F

from fleetmeter.llm import multiset_hash as m, ranges
from fleetmeter.llm.queries import QUERIES
from text_rows import AWKWARD, documents, texts


def edited(values):
    """Text and edited text of each, in the order given."""
    values = [v or "" for v in values]
    out = []
    for i, v in enumerate(values):
        half = len(v) // 2
        out.append((v, v[: len(v) - half] + values[(i + 1) % len(values)][:half]))
    return out


def test_query_on_all_documents(spark, sf):
    rows = QUERIES["op4_document_fingerprints"](spark, sf).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = edited([d.text for d in docs])
    same = {}
    for r, (text, other) in zip(rows, want, strict=True):
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert same.setdefault(text, r.fingerprint) == r.fingerprint
        assert same.setdefault(other, r.edited_fingerprint) == r.edited_fingerprint
    assert sum(r.near_edited > r.near_next for r in rows) > 0.93 * len(rows)


@pytest.mark.parametrize("per_range", [1, 3, 1000])
def test_next_rows_over_ranges(spark, monkeypatch, per_range):
    monkeypatch.setattr(m, "range_bounds", lambda df, c: ranges.range_bounds(df, c, per_range))
    unique = [r for i, r in enumerate(AWKWARD) if r[0] is not None and r not in AWKWARD[:i]]
    for rows in (unique, unique + [(None, "first of all", "en", "s", 0)]):
        made = m.fingerprinted(documents(spark, rows)).collect()
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        want = {r[0]: x for r, x in zip(order, edited([r[1] for r in order]))}
        assert {r.doc_id: (r.text, r.edited) for r in made} == want


def test_repeated_rows_follow_each_other(spark):
    rows = m.fingerprinted(documents(spark)).collect()
    assert len(rows) == len(AWKWARD)
    five = [r for r in rows if r.doc_id == 5]
    assert {r.next_text for r in five} == {AWKWARD[4][1], AWKWARD[6][1]}


@pytest.mark.parametrize("values", [[], ["alone in the table"]])
def test_tiny_tables(spark, values):
    rows = m.fingerprinted(texts(spark, values)).collect()
    assert [(r.next_text, r.edited[:5]) for r in rows] == [(v, v[:5]) for v in values]


def vectors(spark, values):
    rows = texts(spark, values).withColumn("v", m.fingerprint(m.paragraphs(F.col("text"))))
    return [r.v for r in rows.orderBy("doc_id").collect()]


def test_order_does_not_matter_and_counts_do(spark):
    a, b, c, d, e = vectors(spark, ["p\nq\nr", "r\np\n\nq ", "p\nq\nr\nr", "", None])
    assert a == b != c and d == e == [0] * len(d)


def test_insertion_and_deletion(spark):
    part = "\n".join(f"line {i}" for i in range(20_000))
    values = [part, "x\ny\ny", part + "\nx\ny\ny"]
    a, b, both = vectors(spark, values)
    row = spark.createDataFrame([(a, b, both)], "a array<long>, b array<long>, c array<long>")
    got = row.select(
        m.inserted(F.col("a"), F.col("b")).alias("sum"), m.deleted(F.col("c"), F.col("b")).alias("rest")
    ).first()
    assert got.sum == both and got.rest == a


def test_likeness(spark):
    lines = [f"this is line {i}" for i in range(200)]
    a, b, c = ("\n".join(x) for x in (lines, lines[:100] + [f"new {i}" for i in range(100)], lines[::-1]))
    v = vectors(spark, [a, b, c, "", "nothing shared\nat all"])
    rows = spark.createDataFrame([(v[0], x) for x in v], "a array<long>, b array<long>")
    got = [r[0] for r in rows.select(m.likeness(F.col("a"), F.col("b"))).collect()]
    assert got[0] == got[2] == 1.0 and abs(got[1] - 0.5) < 0.25 and got[3] == 0 and got[4] < 0.3


@pytest.mark.parametrize("n", [10_000, 100_000])
def test_likeness_of_texts_that_repeat_a_line(spark, n):
    """The exact cosine of the counts by paragraph, up to the bits of different ones."""
    values = ["line\n" * n, "line\n" * (n // 2) + "other\n" * (n // 2), "other\n" * n, "line\n" * (n - 1)]
    v = vectors(spark, values)
    rows = spark.createDataFrame([(v[0], x) for x in v], "a array<long>, b array<long>")
    whole, half, none, most = (r[0] for r in rows.select(m.likeness(F.col("a"), F.col("b"))).collect())
    assert whole == 1.0 and abs(half - 0.5**0.5) < 0.15 and none < 0.3 and most == pytest.approx(1.0)
    signed = spark.createDataFrame([(v[0],)], "a array<long>").select(m._signed_bits(F.col("a"))).first()[0]
    assert len(signed) == 128 and set(signed) == {n, -n}


def test_native(spark):
    plan = m.fingerprinted(texts(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
