import random
from collections import defaultdict
from itertools import combinations

import pytest

from fleetmeter.llm import chosen_path
from fleetmeter.llm.components import components
from text_rows import AWKWARD, documents, texts, words


def shingles(text):
    w = words(text)
    if not w:
        t = (text or "").strip()
        return frozenset([("=", t)]) if t else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """(id, text class, class, links) of every row with an id."""
    rows = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for (a, (i, s)), (b, (j, t)) in combinations(enumerate(rows), 2):
        if s and t and 10 * len(s & t) >= 8 * len(s | t):
            links[a] += 1
            links[b] += 1
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    first = defaultdict(list)
    for i, s in rows:
        first[s].append(i)
    return sorted(
        (i, min(first[s]) if s else i, root(i), n) for (i, s), n in zip(rows, links)
    )


def joined(docs):
    return sorted(tuple(r) for r in chosen_path.jaccard_join(docs).collect())


def family(draw, base, n, edits):
    """Copies of a text with some words replaced."""
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(draw.randint(0, edits)):
            w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_equals_brute_force(spark):
    draw = random.Random(3)
    values = []
    for size in (8, 30, 120, 700):
        base = [f"w{draw.randrange(5000)}" for _ in range(size)]
        values += family(draw, base, 30, max(1, size // 40))
    values += [" ".join(f"w{draw.randrange(50)}" for _ in range(40)) for _ in range(60)]
    values += [values[0].upper()] * 5 + ["short text", "short text", "other", None, "", "!!!", "!!!"]
    rows = [(i, t) for i, t in enumerate(values)]
    assert joined(texts(spark, values)) == brute(rows)


def test_awkward_rows(spark):
    assert joined(documents(spark)) == brute(AWKWARD)


def test_texts_that_only_one_id_has_are_of_one_class(spark):
    docs = documents(
        spark,
        [(1, "a b c d e f g", "en", "s", 0), (1, "h i j k l m n", "en", "s", 0),
         (2, "h i j k l m n", "en", "s", 0)],
    )
    assert {r.class_id for r in chosen_path.jaccard_join(docs).collect()} == {1}


def test_a_text_of_an_id_has_the_class_of_the_text(spark):
    one, two = "a b c d e f g", "h i j k l m n"
    docs = documents(spark, [(3, one, "en", "s", 0), (5, one, "en", "s", 0), (5, two, "en", "s", 0)])
    got = sorted((r.doc_id, r.text_class, r.class_id) for r in chosen_path.jaccard_join(docs).collect())
    assert got == [(3, 3, 3), (5, 3, 3), (5, 5, 5)]


def test_large_buckets_and_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "SMALL_BUCKET", 10)
    monkeypatch.setattr(chosen_path, "BLOCK_SHINGLES", 2_000)
    draw = random.Random(5)
    common = [f"c{i}" for i in range(12)]
    base = [f"w{draw.randrange(5000)}" for _ in range(60)]
    values = family(draw, base, 120, 2)
    values += [
        " ".join([*common, *(f"x{draw.randrange(10**5)}" for _ in range(40))]) for _ in range(60)
    ]
    assert joined(texts(spark, values)) == brute(list(enumerate(values)))


@pytest.mark.parametrize("copies", [2, 3, 4])
@pytest.mark.parametrize("block", [150, 60])
def test_few_long_copies_over_several_blocks(spark, monkeypatch, copies, block):
    """Most blocks of a group are empty, or hold one set; links inside a block count once."""
    monkeypatch.setattr(chosen_path, "BLOCK_SHINGLES", block)
    values = []
    for k in range(12):
        values += [" ".join([*(f"g{k}w{i}" for i in range(100)), f"end{j}"]) for j in range(copies)]
    assert joined(texts(spark, values)) == brute(list(enumerate(values)))


def test_empty_table_and_extra_columns(spark):
    assert joined(texts(spark, [])) == []
    docs = texts(spark, ["a b c", "a b c"]).selectExpr("*", "7 AS class_id", "8 AS id", "'q' AS path")
    assert joined(docs) == [(0, 0, 0, 1), (1, 0, 0, 1)]


def test_recall_of_the_buckets(spark):
    """How often a pair just at the limit meets in a bucket whose sketches link it."""
    draw = random.Random(11)
    values = []
    for k in range(200):
        base = [f"p{k}w{i}" for i in range(100)]
        other = [*base[:89], *(f"q{k}w{i}" for i in range(11))]  # 85 of 107 shingles: 0.794
        other[89] = base[89]  # 86 of 106: 0.811
        values += [" ".join(base), " ".join(other)]
    del draw
    rows = joined(texts(spark, values))
    assert sum(r[3] == 1 for r in rows) >= 0.999 * len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)]
    edges += [(100 + i, 101 + i) for i in range(40)] + [(500, x) for x in range(600, 700)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "x long, y long")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted((x, root(x)) for x in linked)


def test_runs_needed():
    assert chosen_path.runs_needed(0.999) == 15 and chosen_path.runs_needed(0.5, 1) == 1
