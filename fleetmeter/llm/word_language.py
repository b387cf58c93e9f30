"""Language identification with a linear-chain conditional random field over words.

Each word has a score for every language, the sum of the weights of its features: the word
itself, its first and last letters, the letter n-grams inside, and the languages whose lexicon
has it. Learned transitions say how likely the language changes from word to word. Forward and
backward passes give every word the probability of each language, so that code-switched text gets
a label per word; a document's language is the one with the largest share of its words, wherever
they stand.

Chains are stretches of at most ``CHAIN`` words; together they cover the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.llm.arrow_text import LOWER, Text, mix, range_hashes, text_runs, word_spans
from fleetmeter.llm.sampling import per_label
from fleetmeter.workers import map_batches

UNKNOWN = "und"
CHAIN = 64
BITS = 16
AFFIXES = (1, 2, 3)
NGRAMS = (2, 3)
# Labelled rows of each language that a model is fitted on, about; at most twice as many.
TRAIN_ROWS = 300
TRAIN_WORDS = 600_000
# A word is in the lexicon of a language if labelled rows of it have the word so many times.
LEXICON_COUNT = 3

_LETTER = re.compile(r"[^\W\d_]")
_ASCII_LETTER = (LOWER >= 97) & (LOWER <= 122)


class Lexicon(NamedTuple):
    """Word hashes in ascending order, and for each a value of the set of languages that have it."""

    keys: np.ndarray
    values: np.ndarray

    def look_up(self, key: np.ndarray) -> np.ndarray:
        """0 for a word that no language has."""
        if not len(self.keys):
            return np.zeros(len(key), dtype=np.uint64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], np.uint64(0))


def lexicon_of(key: np.ndarray, label: np.ndarray, languages: int) -> Lexicon:
    keys, values = [], []
    for i in range(languages):
        found, count = np.unique(key[label == i], return_counts=True)
        found = found[count >= LEXICON_COUNT]
        keys.append(found)
        values.append(np.full(len(found), mix(np.array([i + 1]))[0]))
    keys, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(keys), dtype=np.uint64)
    np.add.at(total, at, np.concatenate(values))
    return Lexicon(keys, total)


class Features(NamedTuple):
    """Of the words of a run: their row, features at word positions (one array each, the same
    length as the words), and features of which a word has any number (word, feature)."""

    row: np.ndarray
    single: list[np.ndarray]
    many: list[tuple[np.ndarray, np.ndarray]]


def _slot(value: np.ndarray, kind: int) -> np.ndarray:
    return (mix(value + np.uint64(kind << 56)) >> np.uint64(64 - BITS)).astype(np.int32)


def features_of(text: Text, lexicon: Lexicon | None = None) -> Features:
    row, start, end = word_spans(text)
    key = range_hashes(text.data, start, end)
    single = [_slot(key, 0)]
    if lexicon is not None:
        single.append(_slot(lexicon.look_up(key), 41))
    n = len(text.data)
    letters = LOWER[text.data].astype(np.uint64)
    size = end - start
    prefix = np.zeros(len(start), dtype=np.uint64)
    suffix = np.zeros(len(start), dtype=np.uint64)

    def letter(at: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.where(there, letters[np.clip(at, 0, n - 1)] + np.uint64(1), np.uint64(0))

    for i in range(max(AFFIXES)):
        prefix = prefix * np.uint64(257) + letter(start + i, size > i)
        suffix = suffix * np.uint64(257) + letter(end - 1 - i, size > i)
        if i + 1 in AFFIXES:
            single += [_slot(prefix, 1 + i), _slot(suffix, 11 + i)]
    # The word of each byte; an n-gram counts if it lies in one word.
    of_byte = np.full(n, -1, dtype=np.int32)
    if len(start):
        turns = np.zeros(n + 1, dtype=np.int32)
        turns[start] += 1
        of_byte = np.cumsum(turns[:n], dtype=np.int32) - 1
        inside = np.zeros(n + 1, dtype=np.int8)
        inside[start] += 1
        inside[end] -= 1  # a word may begin where another row's ends
        of_byte[np.cumsum(inside[:n]) == 0] = -1
    many = []
    for width in NGRAMS:
        count = n - width + 1
        if count <= 0:
            continue
        at = np.flatnonzero((of_byte[:count] >= 0) & (of_byte[:count] == of_byte[width - 1 :]))
        value = np.zeros(len(at), dtype=np.uint64)
        for i in range(width):
            value = value * np.uint64(257) + letters[at + i]
        many.append((of_byte[at], _slot(value, 21 + width)))
    return Features(row, single, many)


class Chains(NamedTuple):
    """Where the words of each chain stand: chain and position of every word, and lengths."""

    chain: np.ndarray
    place: np.ndarray
    length: np.ndarray


def chains_of(row: np.ndarray) -> Chains:
    if not len(row):
        none = np.zeros(0, dtype=np.int64)
        return Chains(none, none, none)
    first = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])
    in_row = np.arange(len(row)) - np.repeat(first, np.diff(np.concatenate([first, [len(row)]])))
    place = in_row % CHAIN
    chain = np.cumsum(place == 0) - 1
    return Chains(chain, place, np.bincount(chain))


class LanguageModel(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # language by feature
    transitions: np.ndarray  # from language to language
    start: np.ndarray
    lexicon: Lexicon | None = None
    seen: np.ndarray | None = None  # of every feature, whether a letter n-gram that was fitted on has it

    def features(self, text: Text) -> Features:
        return features_of(text, self.lexicon)

    def emissions(self, features: Features) -> np.ndarray:
        """Word by language."""
        n = len(features.row)
        total = np.zeros((n, len(self.languages)))
        for label, weights in enumerate(self.weights):
            for slots in features.single:
                total[:, label] += weights[slots]
            for word, slots in features.many:
                total[:, label] += np.bincount(word, weights[slots], n)
        return total

    def posteriors(self, emissions: np.ndarray, chains: Chains) -> np.ndarray:
        """Word by language: probabilities by the forward and backward passes."""
        forward, backward, _ = _passes(self, emissions, chains)
        both = (forward * backward)[chains.chain, chains.place]
        return both / both.sum(axis=1, keepdims=True)

    def shares(self, row: np.ndarray, chances: np.ndarray, rows: int) -> np.ndarray:
        """Row by language: the mean probability over its words."""
        total = np.maximum(np.bincount(row, minlength=rows), 1)
        sums = [np.bincount(row, chances[:, i], rows) for i in range(chances.shape[1])]
        return np.stack(sums, axis=1) / total[:, None]

    def known(self, features: Features, rows: int) -> np.ndarray:
        """Per row the share of its letter n-grams that the fitted texts have; 1 without any."""
        total, met = np.zeros(rows), np.zeros(rows)
        for word, slots in features.many:
            row = features.row[word]
            total += np.bincount(row, minlength=rows)
            met += np.bincount(row, self.seen[slots], rows)
        return np.where(total > 0, met / np.maximum(total, 1), 1.0)


def _passes(model: LanguageModel, emissions: np.ndarray, chains: Chains) -> tuple:
    """Forward and backward messages, each scaled to sum to one, and the padded likelihoods."""
    n, k = len(chains.length), len(model.languages)
    scores = np.zeros((n, CHAIN, k))
    scores[chains.chain, chains.place] = emissions - emissions.max(axis=1, keepdims=True)
    like = np.exp(np.clip(scores, -50, 0))
    move = np.exp(model.transitions)
    forward, backward = np.empty_like(like), np.ones_like(like)
    message = np.exp(model.start) * like[:, 0]
    forward[:, 0] = message / message.sum(axis=1, keepdims=True)
    for t in range(1, CHAIN):
        message = (forward[:, t - 1] @ move) * like[:, t]
        forward[:, t] = message / message.sum(axis=1, keepdims=True)
    for t in range(CHAIN - 2, -1, -1):
        message = (backward[:, t + 1] * like[:, t + 1]) @ move.T
        message /= message.sum(axis=1, keepdims=True)
        backward[:, t] = np.where((chains.length > t + 1)[:, None], message, 1.0)
    return forward, backward, like


def fit(texts: list[str], labels: list[str], epochs: int = 4, batch: int = 256) -> LanguageModel:
    """The field of largest likelihood, by gradient steps over batches of chains.

    All words of a row have its label. So that switches are seen too, the tails of every third
    chain are exchanged with those of other chains.
    """
    languages = sorted(set(labels))
    index = {x: i for i, x in enumerate(languages)}
    draw = np.random.default_rng(8)
    singles: list[np.ndarray] = []
    many: list[tuple[np.ndarray, np.ndarray]] = []
    ys: list[np.ndarray] = []
    words = 0
    y_of_row = np.array([index[x] for x in labels])
    rows_of: list[np.ndarray] = []
    runs = list(text_runs(pa.array(texts, pa.large_string())))
    spans = [word_spans(run) for run in runs]
    keys = [range_hashes(run.data, start, end) for run, (_, start, end) in zip(runs, spans)]
    of_word = [y_of_row[row + run.first] for run, (row, _, _) in zip(runs, spans)]
    lexicon = lexicon_of(np.concatenate(keys), np.concatenate(of_word), len(languages))
    for run in runs:
        f = features_of(run, lexicon)
        singles.append(np.array(f.single))
        many += [(word + words, slots) for word, slots in f.many]
        rows_of.append(f.row + run.first)
        words += len(f.row)
    row = np.concatenate(rows_of)
    y = y_of_row[row]
    single = np.concatenate(singles, axis=1)
    # Features of which a word has several, ordered by word.
    word = np.concatenate([w for w, _ in many])
    slot = np.concatenate([s for _, s in many])
    order = np.argsort(word, kind="stable")
    word, slot = word[order], slot[order]
    begin = np.searchsorted(word, np.arange(words + 1))
    chains = chains_of(row)
    first = np.flatnonzero(chains.place == 0)
    k = len(languages)
    grams = np.zeros(1 << BITS, dtype=bool)
    grams[slot] = True
    weights = np.zeros((k, 1 << BITS))
    model = LanguageModel(languages, weights, np.zeros((k, k)), np.zeros(k), lexicon, grams)
    seen = [np.full_like(x, 1e-6) for x in model[1:4]]
    for _ in range(epochs):
        turn = draw.permutation(len(first))
        for at in range(0, len(turn), batch):
            chosen = turn[at : at + batch]
            ids = [np.arange(first[c], first[c] + chains.length[c]) for c in chosen]
            for i in range(0, len(ids) - 1, 3):
                a, b = ids[i], ids[i + 1]
                cut = int(draw.integers(0, min(len(a), len(b)) + 1))
                ids[i] = np.concatenate([a[:cut], b[cut:]])
                ids[i + 1] = np.concatenate([b[:cut], a[cut:]])
            ids = [x for x in ids if len(x)]
            flat = np.concatenate(ids)
            length = np.array([len(x) for x in ids])
            chain = np.repeat(np.arange(len(ids)), length)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            part = Chains(chain, place, length)
            counts = begin[flat + 1] - begin[flat]
            many_word = np.repeat(np.arange(len(flat)), counts)
            many_at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            many_slot = slot[np.repeat(begin[flat], counts) + many_at]
            features = Features(chain, list(single[:, flat]), [(many_word, many_slot)])
            _step(model, features, part, y[flat], seen)
    return model


def _step(
    model: LanguageModel, features: Features, chains: Chains, y: np.ndarray, seen: list
) -> None:
    emissions = model.emissions(features)
    forward, backward, like = _passes(model, emissions, chains)
    k, n = len(model.languages), len(chains.length)
    both = (forward * backward)[chains.chain, chains.place]
    error = both / both.sum(axis=1, keepdims=True)
    error[np.arange(len(y)), y] -= 1
    gradient = np.zeros_like(model.weights)
    for label in range(k):
        for slots in features.single:
            gradient[label] += np.bincount(slots, error[:, label], 1 << BITS)
        for word, slots in features.many:
            gradient[label] += np.bincount(slots, error[word, label], 1 << BITS)
    # Expected and seen transitions.
    pairs = forward[:, :-1, :, None] * np.exp(model.transitions) * (like * backward)[:, 1:, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    there = np.arange(1, CHAIN)[None, :] < chains.length[:, None]
    moves = (pairs * there[:, :, None, None]).sum(axis=(0, 1))
    inner = chains.place[1:] > 0
    np.subtract.at(moves, (y[:-1][inner], y[1:][inner]), 1)
    starts = error[chains.place == 0].sum(axis=0)
    for weights, g, s in zip(model[1:4], (gradient, moves, starts), seen):
        g = g / n + 1e-6 * weights
        s += g**2
        weights -= 0.1 * g / np.sqrt(s)


def train(
    documents: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id"
) -> LanguageModel | None:
    """A model fitted on about ``TRAIN_ROWS`` rows of each label, chosen by the hash of their
    key, of whole texts up to ``TRAIN_WORDS`` words in all. None without labelled rows."""
    rows = documents.select(F.col(text).alias("text"), F.col(label).alias("label"), F.col(key).alias("key"))
    rows = per_label(rows.where("text <> ''"), "label", F.col("key"), TRAIN_ROWS)
    texts, labels, words = [], [], 0
    for value, name, _ in rows.collect():
        size = len(value.split())
        if _LETTER.search(value) and (not words or words + size <= TRAIN_WORDS):
            texts.append(value)
            labels.append(name)
            words += size
    return fit(texts, labels) if texts else None


def _has_letter(run: Text, column: pa.Array) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[run.data])])
    found = sums[run.edges[1:]] > sums[run.edges[:-1]]
    for i in np.flatnonzero(~found & (np.diff(run.edges) > 0)):
        found[i] = bool(_LETTER.search(column[run.first + int(i)].as_py()))
    return found


def identified(
    documents: DataFrame, model: LanguageModel | None, text: str = "text"
) -> DataFrame:
    """All rows and columns of ``documents`` with

    - ``lang_pred``: the language of the largest share of the words, ``und`` for a null text or
      one without letters (and for all if there is no model);
    - ``score``: that share, the mean of the words' probabilities, 0 for ``und``;
    - ``lang_words``: the number of words of each language, by each word's likeliest one;
    - ``lang_known``: the share of the letter n-grams that the model was fitted on, whatever the
      language: low for a text in a language that the model has not learned, 1 for a text without
      n-grams or without a model.

    Columns of these names are replaced. A tie goes to the first language by name."""
    names = ["lang_pred", "score", "lang_words", "lang_known"]
    kept = [c for c in documents.columns if c not in names]
    languages = model.languages if model else []

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            predicted = [UNKNOWN] * batch.num_rows
            scores, known = np.zeros(batch.num_rows), np.ones(batch.num_rows)
            counts: list = [[] for _ in predicted]
            column = batch.column(text)
            for run in text_runs(column) if model else ():
                features = model.features(run)
                chances = model.posteriors(model.emissions(features), chains_of(features.row))
                known[run.first : run.first + run.rows] = model.known(features, run.rows)
                k = len(languages)
                shares = model.shares(features.row, chances, run.rows)
                votes = np.bincount(
                    features.row * k + chances.argmax(axis=1), minlength=run.rows * k
                ).reshape(run.rows, k)
                best = shares.argmax(axis=1)
                for i in np.flatnonzero(_has_letter(run, column)).tolist():
                    predicted[run.first + i] = languages[best[i]]
                    scores[run.first + i] = min(1.0, shares[i, best[i]])
                    counts[run.first + i] = [
                        (languages[j], int(c)) for j, c in enumerate(votes[i]) if c
                    ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(predicted, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(counts, pa.map_(pa.string(), pa.int64())),
                    pa.array(known, pa.float64()),
                ],
                names=[*kept, *names],
            )

    schema = T.StructType(
        [
            *(documents.schema[c] for c in kept),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("lang_words", T.MapType(T.StringType(), T.LongType())),
            T.StructField("lang_known", T.DoubleType()),
        ]
    )
    return map_batches(documents.select(*dict.fromkeys([*kept, text])), identify, schema)
