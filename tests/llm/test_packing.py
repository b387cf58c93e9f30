import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetmeter.llm import packing as p
from text_rows import AWKWARD, documents, texts

OTHER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
OTHER.encode_special_tokens = True


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("aB1 '\n\t.éß日😀<|endoftext|>", max_size=60)))
def test_ids_are_those_of_the_tokenizer(text):
    want = OTHER.encode(text, add_special_tokens=False).ids
    assert p._encoding(p.TOKENIZER).encode_ordinary(text) == want


UNALTERED = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def unaltered(text):
    return UNALTERED.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(
    st.one_of(
        st.text("aB1 '\n\t.éß日😀<|endoftext|>", max_size=60),
        st.lists(st.sampled_from(["<|endoftext|>", " ", "\n", "a", "<", "|", "'s", "日"]), max_size=12).map("".join),
    )
)
def test_ids_with_added_tokens(text):
    assert p.token_ids(text) == unaltered(text)


def test_added_tokens_of_a_document(spark):
    values = ["a <|endoftext|> b", "<|endoftext|>" * 20, "x", "<|endoftext"]
    rows = p.pieces(texts(spark, values), with_ids=True).orderBy("doc_id", "start").collect()
    for i, text in enumerate(values):
        mine = [r for r in rows if r.doc_id == i]
        ids = [x for r in mine for x in r.ids]
        assert ids == [*unaltered(text), 0] and mine[0].doc_tokens == len(ids)
    assert unaltered(values[0]) == [64, 220, 50256, 275]


SPACES = [" ", "\n", "\t", "\u3000", "\x85", " \n", "\x1c"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "\n", "\u3000", "\x1c", "   ", "a", "'s", "1", "!", "<|endoftext|>"])), max_size=25))
def test_long_runs_are_cut_as_the_pattern_cuts(parts):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(p, "LONG_SPACE", 2)
        patch.setattr(p, "_LONG_RUN", p.re.compile(rf"(?<!{p._SPACE}){p._SPACE}{{2,}}+"))
        assert p.token_ids("".join(parts)) == unaltered("".join(parts))


@pytest.mark.parametrize("space", SPACES)
def test_very_long_white_space(space):
    run = space * (2_000_000 // len(space))
    texts_ = [run + "a"] if space != " " else [run, run + "a", f"a{run}!{run}"]
    for text in texts_:
        assert p.token_ids(text) == unaltered(text)


def test_runs_just_below_the_limit_take_linear_time():
    text = (" " * (p.LONG_SPACE - 1) + "a") * 30
    begin = time.perf_counter()
    assert len(p.token_ids(text)) > 30 and time.perf_counter() - begin < 20


def test_a_document_of_two_million_spaces(spark):
    (row, *_) = p.pieces(texts(spark, [" " * 2_000_000 + "a"])).collect()
    assert row.doc_tokens == len(unaltered(" " * 2_000_000 + "a")) + 1


@given(st.integers(1, 5000))
def test_cut_lengths(total):
    lengths = p.cut_lengths(total)
    assert sum(lengths) == total and min(lengths) > 0 and max(lengths) <= 1024
    assert sum(n not in (16, 32, 64, 128, 256, 512, 1024) for n in lengths) <= 1


def check(rows, wanted):
    """Rows hold each id of each document once, and sequences have no gaps."""
    by_sequence, by_document = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_document.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    want = []
    for doc_id, text in wanted:
        ids = np.array([*OTHER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for n in p.cut_lengths(len(ids)):
            crc = zlib.crc32(ids[start : start + n].tobytes())
            want.append((doc_id is None, doc_id or 0, start, n, crc, len(ids)))
            start += n
    assert got == sorted(want)


def test_awkward_rows(spark):
    docs = documents(spark).selectExpr("*", "1 AS offset", "2 AS length", "3 AS _class")
    check(p.packed(docs).collect(), [r[:2] for r in AWKWARD])


def test_empty_table(spark):
    assert p.packed(texts(spark, [])).collect() == []


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(p, "BUCKET_ROWS", 20)
    values = [f"word {i} " * (i % 97) for i in range(300)]
    check(p.packed(texts(spark, values)).collect(), list(enumerate(values)))


def test_all_documents_with_little_padding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = p.packed(docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    filled = {}
    for r in rows:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    slots = sum(n if n & (n - 1) == 0 else 1024 for n in filled.values())
    assert sum(filled.values()) / slots > 0.98


def test_ids_can_be_kept(spark):
    (row,) = p.pieces(texts(spark, ["hello world"]), with_ids=True).collect()
    assert row.ids == [*OTHER.encode("hello world").ids, 0]


def test_classes_must_not_mix(spark):
    with pytest.raises(ValueError):
        p.placed(p.pieces(texts(spark, ["a"])), smallest=64)
