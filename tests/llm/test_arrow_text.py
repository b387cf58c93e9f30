import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetmeter.llm.arrow_text import text_runs, window_hashes, words_of
from text_rows import words

TEXT = st.one_of(st.none(), st.text(), st.text("aB1 é\n,.", max_size=30))


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=12), st.integers(1, 40))
def test_words_and_hashes(texts, run_bytes):
    seen, row = {}, 0
    for run in text_runs(pa.array(texts, pa.string()), run_bytes):
        found = words_of(run)
        edge = found.per_row(run.rows)
        for i in range(run.rows):
            a, b = edge[i], edge[i + 1]
            want = words(texts[run.first + i])
            assert b - a == len(want)
            for word, key in zip(want, found.key[a:b].tolist()):
                assert seen.setdefault(word, key) == key
            row += 1
    assert row == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_sliced_columns_keep_their_offsets():
    column = pa.array(["aa", None, "bb cc", "", "dd"]).slice(2, 2)
    (run,) = text_runs(column)
    assert run.rows == 2 and bytes(run.data) == b"bb cc"


def test_windows():
    key = np.array([1, 2, 3, 1, 2, 3], dtype=np.uint64)
    found = window_hashes(key, 3)
    assert len(found) == 4 and found[0] == found[3] and len(set(found.tolist())) == 3
    assert len(window_hashes(key, 7)) == 0
