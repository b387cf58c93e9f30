import pytest
from pyspark.sql import functions as F

import corpus_pipeline as c
from fleetmeter.llm import surrogates
from test_chosen_path import brute as near_brute
from test_decontamination import brute as overlap_brute
from test_packing import check as check_packing
from text_rows import AWKWARD, DOCUMENTS, documents, words


@pytest.fixture(scope="module")
def stages(spark, sf):
    """What each stage kept of the given documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for name, stage in c.STAGES:
        kept.append(c.stored(stage(spark, kept[-1], sf), f"test-{name.replace(' ', '-')}"))
    return kept


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_in_order():
    assert [name for name, _ in c.STAGES] == [
        "language ID", "n-gram Jaccard join", "benchmark decontamination", "PII", "packing",
    ]


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == DOCUMENTS.names


def test_language(stages):
    """All documents here have a language, so all stay as they are."""
    before, after = rows(stages[0]), rows(stages[1])
    assert after == before


def test_near_duplicates(stages):
    before, after = rows(stages[1]), rows(stages[2])
    first = {i: class_id for i, _, class_id, _ in near_brute([(r.doc_id, r.text) for r in before.values()])}
    assert set(after) == {i for i in before if first[i] == i} and len(after) < len(before)
    assert all(after[i] == before[i] for i in after)


def test_decontamination(spark, sf, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = rows(stages[2]), rows(stages[3])
    want, cut = set(), 0
    for i, r in before.items():
        n, hits, _ = overlap_brute(r.text, items)
        if hits and 20 * hits >= n:
            continue
        want.add(i)
        if not hits:
            assert after[i] == r
            continue
        cut += 1
        assert overlap_brute(after[i].text, items)[1] == 0 and after[i].n_chars == len(after[i].text)
        assert len(words(after[i].text)) <= n - hits
    assert set(after) == want and len(want) < len(before) and cut


def test_windows_that_a_cut_makes_are_cut_too(spark, tmp_path):
    item = " ".join(f"w{i}" for i in range(13))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = " ".join(f"c{i}" for i in range(600))
    nested = f"{clean} w0 w1 w2 {item} {' '.join(f'w{i}' for i in range(3, 13))} {clean}"
    kept = c.decontaminate(spark, documents(spark, [(1, nested, "en", "s", 1)]), str(tmp_path)).collect()
    assert [words(r.text) for r in kept] == [words(f"{clean} {clean}")]


def test_private_data(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(after) == set(before)
    changed = 0
    for i, r in after.items():
        old = surrogates.mentions(before[i].text)
        changed += bool(old)
        if not old:
            assert r == before[i]
        for m in old:
            assert before[i].text[m.start : m.end] not in r.text
        assert r.n_chars == len(r.text)
    assert changed


def test_packing(stages):
    check_packing(stages[5].collect(), [(r.doc_id, r.text) for r in stages[4].collect()])


def test_run(spark, sf, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got, want = (df.select(*columns).orderBy(*columns).collect() for df in (c.run(spark, sf), stages[5]))
    assert got == want


def test_awkward_rows(spark, tmp_path):
    """No stage fails on nulls, repeated rows and ids, clashing columns or empty tables."""
    items = spark.createDataFrame([(1, "one"), (None, None)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for values in (AWKWARD, []):
        docs = documents(spark, values).selectExpr("*", "1 AS score", "2 AS class_id", "3 AS pii")
        for name, stage in c.STAGES:
            docs = c.stored(stage(spark, docs, str(tmp_path)), "awkward")
            if name != "packing":
                docs = docs.selectExpr("*", "1 AS overlap_hits", "'x' AS id", "2 AS _hash")
        assert (docs.count() > 0) == bool(values)


def test_language_without_labels_keeps_all(spark):
    docs = documents(spark, [(i, f"some text {i}", None, "s", 0) for i in range(20)] + [(99, None, None, None, None)])
    assert sorted(map(str, c.identify_language(spark, docs, "").collect())) == sorted(map(str, docs.collect()))


def test_language_rejects_what_is_not_learned(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*c.COLUMNS)
    odd = [(10**9, "В лесу родилась ёлочка, в лесу она росла, зимой и летом стройная.", None, "s", 1),
           (10**9 + 1, "日本語の文章はここにあります。とても短いです。", None, "s", 1),
           (10**9 + 2, "--- 123 ###", None, "s", 1)]
    kept = rows(c.identify_language(spark, docs.union(documents(spark, odd)), ""))
    assert set(kept) == set(rows(docs))


def test_rows_of_one_id(spark):
    """Texts decide, not ids: what is no copy of anything stays."""
    one, two, three = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    docs = documents(spark, [(3, one, "en", "s", 1), (5, one, "en", "s", 1), (5, two, "en", "s", 1),
                             (5, three, "en", "s", 1), (5, three, "en", "s", 1), (5, None, "en", "s", 1),
                             (5, three + " more", "en", "s", 1), (7, two, "en", "s", 1)])
    kept = [(r.doc_id, r.text) for r in c.remove_near_duplicates(spark, docs, "").collect()]
    # Of the two near copies under one id either may stay.
    alike = [(5, three), (5, three + " more")]
    assert sorted((x for x in kept if x not in alike), key=str) == sorted([(3, one), (7, two), (5, None)], key=str)
    assert sum(x in alike for x in kept) == 1


def test_repeated_rows_leave_one(spark, tmp_path):
    docs = documents(spark).where(F.length("text") < 1000)
    kept = c.remove_near_duplicates(spark, docs, "").collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids))
    assert {5}.issubset(ids) and 6 not in ids and sum(r.doc_id is None for r in kept) == 1
