"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items make one automaton. The words of each document are
streamed through it, which gives at every word the longest stretch ending there that some
item contains. A stretch of ``window`` words, or a whole item of fewer, marks its words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z as a-z, compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.llm.arrow_text import Text, Words, text_runs, window_hashes, words_of
from fleetmeter.llm.stored import stored
from fleetmeter.workers import map_batches, send_package

WINDOW = 13
# A part of the benchmark that one automaton holds; about 1 KB a word in a Python worker.
PART_WORDS = 200_000
_FILTER_BITS = 20


class SuffixAutomaton:
    """All word stretches of the items, with the items that hold each stretch."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        items = [(name, words) for name, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(items)
        self.shortest = min([window, *(len(words) for _, words in items)])
        # No window fits into a stretch without grams of this many words.
        self.gram = min(3, self.shortest)
        grams = [
            window_hashes(np.array(words, dtype=np.uint64), self.gram) for _, words in items
        ]
        self.grams = np.unique(np.concatenate([np.zeros(0, np.uint64), *grams]))
        self.maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.maybe[(self.grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(follow)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, follower: int, word: int) -> int:
        """The state of the stretch that ends at ``state`` plus ``word``, apart from longer ones."""
        if self.length[follower] == self.length[state] + 1:
            return follower
        copy = self._state(
            self.length[state] + 1, dict(self.next[follower]), self.link[follower]
        )
        self.link[follower] = copy
        while state >= 0 and self.next[state].get(word) == follower:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, known, word)
        added = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = added
            state = self.link[state]
        if state >= 0:
            self.link[added] = self._split(state, self.next[state][word], word)
        return added

    def _mark(self, items: list[tuple[str | None, list[int]]]) -> None:
        """Per state the items of its window-long suffix, and the short items that end there."""
        holders: list[set] = [set() for _ in self.length]
        whole: dict[int, set] = {}
        for name, words in items:
            state = 0
            for word in words:
                state = self.next[state][word]
                above = state
                while above > 0 and name not in holders[above]:
                    holders[above].add(name)
                    above = self.link[above]
            if len(words) < self.window:
                whole.setdefault(state, set()).add(name)
        self.window_items: dict[int, frozenset] = {}
        self.short_items: dict[int, list[tuple[int, frozenset]]] = {}
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            above = self.link[state]
            if self.length[state] >= self.window:
                self.window_items[state] = (
                    frozenset(holders[state])
                    if self.length[above] < self.window
                    else self.window_items[above]
                )
            short = self.short_items.get(above, [])
            if state in whole:
                short = [*short, (self.length[state], frozenset(whole[state]))]
            if short:
                self.short_items[state] = short

    def stream(self, words: list[int], marks: np.ndarray, found: set) -> None:
        """Sets ``marks`` at the words inside a window and adds the items to ``found``."""
        state, matched = 0, 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            follower = self.next[state].get(word)
            if follower is None:
                continue
            state = follower
            matched += 1
            if matched >= self.window:
                marks[i + 1 - self.window : i + 1] = True
                # The state may stand for longer stretches than the matched one.
                found |= self.window_items[state]
            for length, names in self.short_items.get(state, ()):
                if length <= matched:
                    marks[i + 1 - length : i + 1] = True
                    found |= names

    def candidates(self, words: Words) -> Iterator[tuple[int, int]]:
        """Stretches of words outside which no window can lie."""
        gram = window_hashes(words.key, self.gram)
        if not len(gram):
            return
        same_row = words.row[self.gram - 1 :] == words.row[: len(gram)]
        at = np.flatnonzero(
            same_row & self.maybe[(gram >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
        )
        place = np.minimum(np.searchsorted(self.grams, gram[at]), len(self.grams) - 1)
        at = at[self.grams[place] == gram[at]]
        if not len(at):
            return
        row = words.row[at]
        breaks = np.flatnonzero((np.diff(at) != 1) | (row[1:] != row[:-1])) + 1
        first = at[np.concatenate([[0], breaks])]
        last = at[np.concatenate([breaks - 1, [len(at) - 1]])]
        long = last - first + self.gram >= self.shortest
        for a, b in zip(first[long].tolist(), last[long].tolist()):
            yield a, b + self.gram


def _items(benchmark: DataFrame, text: str, item_id: str) -> list[tuple[str | None, list[int]]]:
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text)).collect()
    items = []
    column = pa.array([r[1] for r in rows], pa.large_string())
    for run in text_runs(column):
        words = words_of(run)
        edge = words.per_row(run.rows)
        for i in range(run.rows):
            items.append((rows[run.first + i][0], words.key[edge[i] : edge[i + 1]].tolist()))
    return items


def _parts(items: list, part_words: int) -> list[list]:
    """Items in parts of about ``part_words`` words; every part is streamed."""
    parts, size = [[]], 0
    for item in items:
        if size and size + len(item[1]) > part_words:
            parts.append([])
            size = 0
        parts[-1].append(item)
        size += len(item[1])
    return parts


RESULT = T.StructType(
    [
        T.StructField("overlap_words", T.LongType()),
        T.StructField("overlap_hits", T.LongType()),
        T.StructField("overlap_items", T.ArrayType(T.StringType())),
        T.StructField("overlap_marks", T.BinaryType()),
    ]
)


def _scan_run(
    automaton: SuffixAutomaton, run: Text, past: list[dict] | None
) -> Iterator[tuple[int, int, list[str], bytes | None]]:
    words = words_of(run)
    edge = words.per_row(run.rows)
    marks = np.zeros(len(words.key), dtype=bool)
    found: dict[int, set] = {}
    if len(automaton.grams):
        for a, b in automaton.candidates(words):
            automaton.stream(
                words.key[a:b].tolist(), marks[a:b], found.setdefault(int(words.row[a]), set())
            )
    for i in range(run.rows):
        of_row, names = marks[edge[i] : edge[i + 1]], found.get(i, set()) - {None}
        if past and past[run.first + i]["overlap_marks"] is not None:
            bits = np.frombuffer(past[run.first + i]["overlap_marks"], np.uint8)
            of_row = of_row | np.unpackbits(bits, count=len(of_row)).astype(bool)
            names = names | set(past[run.first + i]["overlap_items"])
        hits = int(np.count_nonzero(of_row))
        yield len(of_row), hits, sorted(names), np.packbits(of_row).tobytes() if hits else None


def _scan(documents: DataFrame, items: list, window: int, text: str) -> DataFrame:
    """``documents`` with what this and the earlier parts of the benchmark mark in each text."""
    send_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(SuffixAutomaton(items, window))
    kept = [c for c in documents.columns if c not in RESULT.names]
    again = len(kept) < len(documents.columns)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            past = batch.select(RESULT.names[2:]).to_pylist() if again else None
            results = [
                x for run in text_runs(batch.column(text)) for x in _scan_run(automaton, run, past)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array([r[0] for r in results], pa.int64()),
                    pa.array([r[1] for r in results], pa.int64()),
                    pa.array([r[2] for r in results], pa.list_(pa.string())),
                    pa.array([r[3] for r in results], pa.binary()),
                ],
                names=[*kept, *RESULT.names],
            )

    schema = T.StructType([*(documents.schema[c] for c in kept), *RESULT])
    return map_batches(documents, scan, schema)


def overlaps(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    part_words: int = PART_WORDS,
) -> DataFrame:
    """All rows and columns of ``documents``, with the columns

    - ``overlap_words``: words of the text; ``overlap_hits``: those inside a window;
    - ``overlap_items``: ids of the items with such a window, sorted as strings, each once;
    - ``overlap_marks``: one bit per word, null without a hit.

    A null or empty text has no words. Items without words mark nothing; an item without id
    marks words but is not listed; repeated items are listed once per id. Columns of these
    names that ``documents`` already has are replaced. The benchmark is read by the driver.
    It is streamed in parts of ``part_words`` words, an automaton and a pass over the
    documents each, so that a larger benchmark takes longer, not more memory.
    """
    scanned = documents.drop(*RESULT.names)
    parts = _parts(_items(benchmark, item_text, item_id), part_words)
    for part in parts:
        scanned = _scan(scanned, part, window, text)
        if len(parts) > 1:
            scanned = stored(scanned, "overlaps")
    return scanned


def contaminated(coverage_limit: int = 20) -> F.Column:
    """Whether at least one word in ``coverage_limit`` of a document is a hit."""
    hits, words = F.col("overlap_hits"), F.col("overlap_words")
    return (hits > 0) & (hits * coverage_limit >= words)


def without_spans(
    scanned: DataFrame, min_words: int = WINDOW, text: str = "text"
) -> DataFrame:
    """The rows of :func:`overlaps` with every marked span of at least ``min_words`` words
    cut out of the text, from its first word to the end of its last. Other texts, nulls
    included, stay as they are to the byte; all other columns too."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, texts = batch.column("overlap_marks"), batch.column(text)
            values: list = []
            for run in text_runs(texts):
                words = words_of(run)
                edge = words.per_row(run.rows)
                for i in range(run.rows):
                    row = run.first + i
                    if not marks[row].is_valid:
                        values.append(texts[row].as_py())
                        continue
                    a, b = edge[i], edge[i + 1]
                    bits = np.unpackbits(
                        np.frombuffer(marks[row].as_py(), np.uint8), count=b - a
                    )
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], bits, [0]]).astype(int)))
                    pieces, at = [], run.edges[i]
                    for first, end in zip(turns[::2], turns[1::2]):
                        if end - first >= min_words:
                            pieces.append(run.data[at : words.start[a + first]])
                            at = words.end[a + end - 1]
                    pieces.append(run.data[at : run.edges[i + 1]])
                    values.append(np.concatenate(pieces).tobytes().decode())
            columns = [
                pa.array(values, pa.string()) if name == text else batch.column(name)
                for name in batch.schema.names
            ]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_batches(scanned, cut, scanned.schema)
