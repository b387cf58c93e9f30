import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetmeter.llm import additive_quality as a
from fleetmeter.llm.arrow_text import text_runs
from fleetmeter.llm.queries import QUERIES
from text_rows import documents, texts, words


def stats(values, run_bytes=1 << 20):
    runs = text_runs(pa.array(values, pa.large_string()), run_bytes)
    return np.concatenate([a.statistics(r) for r in runs])


def plain(text):
    """Some of the statistics, restated."""
    text = text or ""
    data, w = text.encode(), words(text)
    some, each = max(len(data), 1), max(len(w), 1)
    lines = text.split("\n")[: -1 if text.endswith("\n") else None] if text else []
    triples = list(zip(w, w[1:], w[2:]))
    return {
        "log_bytes": np.log1p(len(data)),
        "log_words": np.log1p(len(w)),
        "word_bytes": sum(len(x.encode()) for x in w) / each,
        "longest_word": max((len(x.encode()) for x in w), default=0),
        "digit_share": sum(48 <= b <= 57 for b in data) / some,
        "bar_share": text.count("|") / some,
        "line_words": len(w) / max(len(lines), 1),
        "repeated_words": 1 - len(set(w)) / each if w else 0,
        "repeated_next": sum(x == y for x, y in pairwise(w)) / each,
        "repeated_triples": 1 - len(set(triples)) / len(triples) if triples else 0,
        "repeated_lines": 1 - len(set(x.lower() for x in lines)) / len(lines) if lines else 0,
    }


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.text("aB1 \n|.é#", max_size=40)), min_size=1, max_size=6),
    st.integers(1, 60),
)
def test_statistics(values, run_bytes):
    got = stats(values, run_bytes)
    assert np.isfinite(got).all()
    for row, text in zip(got, values, strict=True):
        for name, want in plain(text).items():
            assert np.isclose(row[a.FEATURES.index(name)], want), (name, text)


def test_the_model_learns_steps_and_interactions():
    draw = np.random.default_rng(1)
    x = draw.random((4000, 4))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.5)).astype(float)
    model = a.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.93
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]


def test_scores_are_sums_of_table_entries():
    draw = np.random.default_rng(2)
    x = draw.random((300, 3))
    model = a.fit(x, (x[:, 0] > 0.5).astype(float), rounds=20, pair_rounds=5)
    for row in x[:20]:
        total = model.intercept
        total += sum(t[(e <= v).sum()] for t, e, v in zip(model.tables, model.edges, row))
        total += sum(
            t[(model.pair_edges[i] <= row[i]).sum(), (model.pair_edges[j] <= row[j]).sum()]
            for i, j, t in model.pairs
        )
        assert np.isclose(model.scores(row[None])[0], 1 / (1 + np.exp(-total)))


def test_awkward_rows_and_tables(spark):
    docs = documents(spark).selectExpr("*", "1 AS score", "'s' AS stats")
    measured = a.with_statistics(docs)
    labels = spark.createDataFrame(
        [(4, 1), (5, 0), (5, 1), (10, 0), (None, 1), (6, None), (99, 1), (7, 3)], "doc_id long, quality int"
    )
    for model in (a.train(measured, labels), None):
        rows = a.scored(measured, model).collect()
        assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    assert a.train(measured, labels.limit(0)) is None
    empty = a.with_statistics(texts(spark, []))
    assert a.train(empty, labels) is None and a.scored(empty, None).collect() == []


def test_one_label_only(spark):
    measured = a.with_statistics(texts(spark, ["one text", "another"]))
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in a.scored(measured, a.train(measured, labels)).collect())


def test_held_out_accuracy(spark, sf):
    rows = QUERIES["op9_quality_classifier"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = rows.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out]
    assert len(held) > 50 and sum(r.quality == r.predicted for r in held) > 0.93 * len(held)
