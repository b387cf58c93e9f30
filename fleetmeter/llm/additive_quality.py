"""Quality classifier: a generalised additive model with pairwise interactions.

Text statistics are cut into bins. Shallow trees are boosted feature by feature in turn, each on
one feature's bins, so that they add up to a lookup table per feature; then the same on the
pairs of features that explain most of what is left. A text's score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.llm.arrow_text import Text, range_hashes, text_runs, window_hashes, words_of
from fleetmeter.llm.block_rules import STOP_WORDS
from fleetmeter.llm.sampling import per_label
from fleetmeter.workers import map_batches

FEATURES = [
    "log_bytes",
    "log_words",
    "word_bytes",
    "longest_word",
    "upper_share",
    "digit_share",
    "symbol_share",
    "stop_mark_share",
    "bar_share",
    "line_words",
    "stop_word_share",
    "repeated_words",
    "repeated_next",
    "repeated_triples",
    "repeated_lines",
    "letter_share",
    "symbol_words",
    "upper_words",
]
# Labelled rows of each value that the model is fitted on, about; at most twice as many.
TRAIN_ROWS = 10_000
BINS = 24
PAIR_BINS = 8
PAIRS = 6

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_LETTER = _UPPER | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)
_SPACE = np.isin(_CODES, [9, 10, 11, 12, 13, 32])
_MARK = np.isin(_CODES, [ord(c) for c in ".,;:!?'\"()-"])
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _MARK)


def _hash_of(words: list[str]) -> np.ndarray:
    run = next(iter(text_runs(pa.array([" ".join(words)], pa.large_string()))))
    return np.unique(words_of(run).key)


_STOP_KEYS = _hash_of(sorted(STOP_WORDS))


def _repeats(row: np.ndarray, key: np.ndarray, rows: int) -> np.ndarray:
    """Per row the share of keys that occurred in the row before."""
    counts = np.bincount(row, minlength=rows)
    if not len(key):
        return np.zeros(rows)
    order = np.lexsort((key, row))
    r, k = row[order], key[order]
    first = np.ones(len(k), dtype=bool)
    first[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    distinct = np.bincount(r[first], minlength=rows)
    return np.where(counts > 0, 1 - distinct / np.maximum(counts, 1), 0.0)


def _lines(run: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every line, and the number of lines of each row."""
    breaks = np.flatnonzero(run.data == 10)
    start = np.unique(np.concatenate([run.edges[:-1], breaks + 1]))
    start = start[start < len(run.data)]
    end = np.concatenate([start[1:], [len(run.data)]]) if len(start) else start
    row = np.searchsorted(run.edges, start, side="right") - 1
    end = np.minimum(end, run.edges[row + 1])
    # Without the line break at its end.
    end = end - ((end > start) & (run.data[np.maximum(end - 1, 0)] == 10))
    return row, range_hashes(run.data, start, end), np.bincount(row, minlength=run.rows)


def statistics(run: Text) -> np.ndarray:
    """Row by feature, all finite; an empty text has zeros."""
    n = run.rows
    size = np.diff(run.edges)
    some = np.maximum(size, 1)

    def share(table: np.ndarray, of: np.ndarray = some) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[run.data])])
        return (sums[run.edges[1:]] - sums[run.edges[:-1]]) / of

    words = words_of(run)
    count = np.bincount(words.row, minlength=n)
    each = np.maximum(count, 1)
    length = words.end - words.start
    longest = np.zeros(n)
    np.maximum.at(longest, words.row, length)
    line_row, line_key, lines = _lines(run)
    next_same = words.key[1:] == words.key[:-1]
    next_same &= words.row[1:] == words.row[:-1]
    triples = window_hashes(words.key, 3)
    in_row = words.row[2:] == words.row[: len(triples)]
    # The byte after a word, a space for the last one of the run.
    after = np.append(run.data, 32)[words.end] if len(words.end) else words.end
    before_next = np.isin(after, np.flatnonzero(_SYMBOL | (_CODES == 33)))
    upper_word = _UPPER[run.data[words.start]] & _UPPER[run.data[words.end - 1]] & (length > 1)
    letters = np.maximum(share(_LETTER, 1), 1)
    features = {
        "log_bytes": np.log1p(size),
        "log_words": np.log1p(count),
        "word_bytes": np.bincount(words.row, length, n) / each,
        "longest_word": longest,
        "upper_share": share(_UPPER, letters),
        "digit_share": share(_DIGIT),
        "symbol_share": share(_SYMBOL),
        "stop_mark_share": share(_MARK),
        "bar_share": share(_CODES == ord("|")),
        "line_words": count / np.maximum(lines, 1),
        "stop_word_share": np.bincount(words.row, np.isin(words.key, _STOP_KEYS), n) / each,
        "repeated_words": _repeats(words.row, words.key, n),
        "repeated_next": np.bincount(words.row[1:][next_same], minlength=n) / each,
        "repeated_triples": _repeats(words.row[: len(triples)][in_row], triples[in_row], n),
        "repeated_lines": _repeats(line_row, line_key, n),
        "letter_share": share(_LETTER),
        "symbol_words": np.bincount(words.row, before_next, n) / each,
        "upper_words": np.bincount(words.row, upper_word, n) / each,
    }
    return np.stack([features[name] for name in FEATURES], axis=1)


def with_statistics(documents: DataFrame, text: str = "text", name: str = "stats") -> DataFrame:
    """All columns of ``documents`` but the text, and its statistics as an array of floats."""
    kept = [c for c in documents.columns if c not in (text, name)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(run) for run in text_runs(batch.column(text))]
            flat = np.concatenate(found) if found else np.zeros((0, len(FEATURES)))
            values = pa.array(flat.astype(np.float32).reshape(-1))
            offsets = pa.array(np.arange(len(flat) + 1) * len(FEATURES), pa.int32())
            column = pa.ListArray.from_arrays(offsets, values)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), column], names=[*kept, name]
            )

    kind = T.ArrayType(T.FloatType())
    schema = T.StructType([*(documents.schema[c] for c in kept), T.StructField(name, kind)])
    return map_batches(documents.select(*kept, text), measure, schema)


class AdditiveModel(NamedTuple):
    intercept: float
    edges: list[np.ndarray]  # bin edges of each feature
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.intercept)
        for i, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, i], side="right")]
        for i, j, table in self.pairs:
            a = np.searchsorted(self.pair_edges[i], x[:, i], side="right")
            b = np.searchsorted(self.pair_edges[j], x[:, j], side="right")
            total += table[a, b]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """Values per bin of a tree that cuts the bins into at most ``leaves`` intervals."""
    g = np.concatenate([[0], np.cumsum(gradient)])
    h = np.concatenate([[0], np.cumsum(weight)])

    def gain(a: int, b: int) -> float:
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + penalty)

    cuts = [0, len(gradient)]
    for _ in range(leaves - 1):
        best = (1e-9, 0)
        for a, b in zip(cuts, cuts[1:]):
            for c in range(a + 1, b):
                best = max(best, (gain(a, c) + gain(c, b) - gain(a, b), c))
        if not best[1]:
            break
        cuts = sorted([*cuts, best[1]])
    values = np.zeros(len(gradient))
    for a, b in zip(cuts, cuts[1:]):
        values[a:b] = (g[b] - g[a]) / (h[b] - h[a] + penalty)
    return values


def _pair_tree(
    gradient: np.ndarray, weight: np.ndarray, penalty: float
) -> tuple[float, np.ndarray]:
    """The best cut on both features of a table: its gain, and a value for each of 4 leaves."""
    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(weight.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = gradient.shape
    best = (0.0, np.zeros_like(gradient))
    for a in range(1, n):
        for b in range(1, m):
            parts = [(0, a, 0, b), (0, a, b, m), (a, n, 0, b), (a, n, b, m)]
            sums = [
                (z[q, s] - z[p, s] - z[q, r] + z[p, r]) for p, q, r, s in parts for z in (g, h)
            ]
            gain = sum(x * x / (y + penalty) for x, y in zip(sums[::2], sums[1::2]))
            if gain > best[0]:
                values = np.zeros_like(gradient)
                for (p, q, r, s), x, y in zip(parts, sums[::2], sums[1::2]):
                    values[p:q, r:s] = x / (y + penalty)
                best = (gain, values)
    return best


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 150,
    pair_rounds: int = 60,
    rate: float = 0.1,
    leaves: int = 3,
    penalty: float = 5.0,
) -> AdditiveModel:
    """Cyclic boosting of the log odds: every round visits each feature, later each pair."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    intercept = float(np.log(share / (1 - share)))
    edges = [_edges(c, BINS) for c in x.T]
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), intercept)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for i, b in enumerate(bins):
            g, h = residuals()
            n = len(tables[i])
            step = rate * _tree(np.bincount(b, g, n), np.bincount(b, h, n), leaves, penalty)
            tables[i] += step
            total += step[b]
    pair_edges = [_edges(c, PAIR_BINS) for c in x.T]
    coarse = [np.searchsorted(e, c, side="right") for e, c in zip(pair_edges, x.T)]

    def pair_step(i: int, j: int) -> tuple[float, np.ndarray, np.ndarray]:
        shape = len(pair_edges[i]) + 1, len(pair_edges[j]) + 1
        flat = coarse[i] * shape[1] + coarse[j]
        g, h = residuals()
        sums = [np.bincount(flat, z, shape[0] * shape[1]).reshape(shape) for z in (g, h)]
        return *_pair_tree(*sums, penalty), flat

    gains = {p: pair_step(*p)[0] for p in combinations(range(x.shape[1]), 2)}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    pair_tables = {p: np.zeros((len(pair_edges[p[0]]) + 1, len(pair_edges[p[1]]) + 1)) for p in chosen}
    for _ in range(pair_rounds):
        for p in chosen:
            _, values, flat = pair_step(*p)
            pair_tables[p] += rate * values
            total += rate * values.reshape(-1)[flat]
    pairs = [(i, j, pair_tables[i, j]) for i, j in chosen]
    return AdditiveModel(intercept, edges, tables, pair_edges, pairs)


def train(
    measured: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
    name: str = "stats",
) -> AdditiveModel | None:
    """A model fitted on about ``TRAIN_ROWS`` labelled rows of each label, those whose keys have
    the smallest hashes. Rows without key or label are left out; a row with several labels
    counts with each. None if there are no labelled rows."""
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).dropna()
    rows = measured.select(F.col(key).alias("key"), F.col(name).alias("stats")).join(marks, "key")
    rows = per_label(rows.where("label IN (0, 1)"), "label", F.col("key"), TRAIN_ROWS).collect()
    if not rows:
        return None
    x = np.array([r["stats"] for r in rows], dtype=np.float32)
    return fit(x, np.array([r["label"] for r in rows], dtype=float))


def scored(measured: DataFrame, model: AdditiveModel | None, name: str = "stats") -> DataFrame:
    """The rows of :func:`with_statistics` with ``score``, the probability of label 1, in place
    of the statistics. Without a model every score is 0.5. A column ``score`` is replaced."""
    kept = [c for c in measured.columns if c not in (name, "score")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
            values = flat.reshape(batch.num_rows, len(FEATURES))
            scores = model.scores(values) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.float64())],
                names=[*kept, "score"],
            )

    fields = [measured.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])
    return map_batches(measured.select(*kept, name), score, schema)
