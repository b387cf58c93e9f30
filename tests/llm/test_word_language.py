import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from fleetmeter.llm import word_language as w
from fleetmeter.llm.arrow_text import text_runs
from fleetmeter.llm.queries import QUERIES
from text_rows import documents, texts

EN = "the house is on the hill and they were not there with us when it was dark".split()
DE = "das haus steht auf dem berg und sie waren nicht dort mit uns als es dunkel war".split()


def sample(words, n=60):
    draw = np.random.default_rng(len(words))
    return [" ".join(draw.choice(words, 20)) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    rows = sample(EN) + sample(DE)
    return w.fit(rows, ["en"] * 60 + ["de"] * 60)


def chances(model, text):
    run = next(iter(text_runs(pa.array([text], pa.large_string()))))
    features = model.features(run)
    chains = w.chains_of(features.row)
    emissions = model.emissions(features)
    return emissions, model.posteriors(emissions, chains)


def test_forward_backward_equals_the_sum_over_all_labellings(model):
    emissions, got = chances(model, "the haus is dunkel and war")
    n, k = emissions.shape
    total = np.zeros((n, k))
    for labels in product(range(k), repeat=n):
        score = model.start[labels[0]] + sum(emissions[i, x] for i, x in enumerate(labels))
        score += sum(model.transitions[a, b] for a, b in zip(labels, labels[1:]))
        for i, x in enumerate(labels):
            total[i, x] += np.exp(score)
    assert np.allclose(got, total / total.sum(axis=1, keepdims=True))


def test_padded_chains_do_not_differ(model):
    """A text of many chains has the same probabilities as its chains by themselves."""
    words = (EN + DE) * 5
    _, whole = chances(model, " ".join(words))
    parts = [chances(model, " ".join(words[i : i + w.CHAIN]))[1] for i in range(0, len(words), w.CHAIN)]
    assert np.allclose(whole, np.concatenate(parts))


def test_code_switching_is_labelled_by_word(model):
    _, got = chances(model, " ".join(EN[:8] + DE[:8] + EN[8:]))
    labels = [model.languages[i] for i in got.argmax(axis=1)]
    assert sum(a == b for a, b in zip(labels, ["en"] * 8 + ["de"] * 8 + ["en"] * 9)) >= 23


def test_features_of_rows_do_not_mix():
    one = [w.features_of(next(iter(text_runs(pa.array([x]))))) for x in ("abc", "de")]
    both = w.features_of(next(iter(text_runs(pa.array(["abc", "de"])))))
    assert both.row.tolist() == [0, 1]
    for i, f in enumerate(one):
        assert [x[i] for x in both.single] == [x[0] for x in f.single]
        for (word, slot), (_, own) in zip(both.many, f.many):
            assert slot[word == i].tolist() == own.tolist()


def test_awkward_rows(spark, model):
    docs = documents(spark).selectExpr("*", "1 AS score", "2 AS lang_pred")
    rows = w.identified(docs, model).collect()
    assert len(rows) == 14
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        assert r.lang_pred in ("und", "en", "de") and (r.score == 0) == (not letters)


def test_empty_tables_and_missing_labels(spark):
    empty = texts(spark, [])
    assert w.train(empty) is None and w.identified(empty, None).collect() == []
    unlabelled = documents(spark, [(1, "some text", None, "s", 9), (2, None, "en", "s", 0)])
    assert w.train(unlabelled) is None
    assert {r.lang_pred for r in w.identified(unlabelled, None).collect()} == {"und"}


def test_one_language_only(spark):
    docs = texts(spark, ["the one", "another one"])
    assert {r.lang_pred for r in w.identified(docs, w.train(docs)).collect()} == {"en"}


def test_held_out_accuracy(spark, sf):
    rows = QUERIES["op8_language_id"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    out = rows.join(truth, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) > 0.98 * len(held)


def test_foreign_ends_do_not_name_a_text(spark, sf):
    """5,000 words of one language between 16 and 16 of another, with the model of the tables."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = w.train(docs)
    words = {
        lang: " ".join(r.text for r in docs.where(f"lang = '{lang}' AND length(text) > 2000").limit(30).collect()).split()
        for lang in ("en", "fr", "de", "es")
    }
    for inner, outer in (("fr", "en"), ("de", "fr"), ("en", "es")):
        middle = (words[inner] * 20)[:5000]
        text = " ".join([*words[outer][:16], *middle, *words[outer][-16:]])
        row = w.identified(texts(spark, [text]), model).first()
        assert row.lang_pred == inner and row.score > 0.9


def test_shares_do_not_depend_on_the_place(model):
    row = np.array([0] * 40 + [2] * 3)
    chances = np.zeros((43, 2))
    chances[:16, 0] = chances[24:40, 0] = chances[40:, 0] = 1
    chances[16:24, 1] = 1
    assert np.allclose(model.shares(row, chances, 3), [[0.8, 0.2], [0, 0], [1, 0]])


def test_lexicon():
    key = np.array([5, 5, 5, 9, 9, 9, 5, 5, 5, 7], dtype=np.uint64)
    found = w.lexicon_of(key, np.array([0] * 6 + [1] * 4), 2)
    one, both, none = found.look_up(np.array([9, 5, 7], dtype=np.uint64)).tolist()
    assert found.keys.tolist() == [5, 9] and none == 0 and one != both
    assert w.Lexicon(found.keys[:0], found.values[:0]).look_up(key).tolist() == [0] * 10


def test_unlearned_languages_show_by_their_letters(spark, model):
    rows = [" ".join(EN), " ".join(DE), "в лесу родилась ёлочка в лесу она росла", "szczęście źdźbło królów mężczyzn", "1 2 3", None]
    known = {r.doc_id: r.lang_known for r in w.identified(texts(spark, rows), model).collect()}
    assert min(known[0], known[1], known[4], known[5]) > 0.9 and max(known[2], known[3]) < 0.5
