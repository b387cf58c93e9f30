"""Personal data replaced by surrogates over a whole corpus.

One pass finds the distinct entities. Their surrogates are checked against each other and
against all entities of the corpus; where two are equal, one draws again, until none are. A
second pass replaces every mention. Texts do not move between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.llm.arrow_text import Text, text_runs, words_of
from fleetmeter.llm.stored import stored
from fleetmeter.llm.surrogates import (
    GIVEN,
    SECRET_STARTS,
    SECRET_WORDS,
    TITLES,
    mentions,
    replaced,
    surrogate,
)
from fleetmeter.workers import map_batches, send_package

KEY = b"replace this key"
# Entities that drew more than once: up to here they are sent to all tasks, about 100 bytes each.
MAX_SENT = 100_000

_CODES = np.arange(256)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_CAPITAL = (_CODES >= 65) & (_CODES <= 90)
_LETTER = _CAPITAL | (_CODES >= 97) & (_CODES <= 122)
_HEX = _DIGIT | (_CODES >= 65) & (_CODES <= 70) | (_CODES >= 97) & (_CODES <= 102)
# What a pattern without regard to case takes for a letter, beside A-Z.
ALIKE = {"i": "iİı", "k": "kK", "s": "sſ"}
FOUND = "kind string, canonical string"
_PII = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)


@lru_cache(maxsize=1)
def _trigger_keys() -> np.ndarray:
    names = [n for group in GIVEN.values() for n in group]
    # A word of several parts, such as api_key, shows by any of them.
    secret = " ".join(SECRET_WORDS).replace("_", " ").split()
    spelled = ["".join(x) for w in secret for x in product(*(ALIKE.get(c, c) for c in w))]
    words = [*names, *TITLES, *SECRET_STARTS]
    # Only A-Z is folded, so other scripts need both cases.
    words += [w.lower() for w in words] + [w.upper() for w in words]
    run = next(iter(text_runs(pa.array([" ".join(words + spelled)], pa.large_string()))))
    return np.unique(words_of(run).key)


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point, whether it is a letter, and a digit."""
    points = [chr(i) for i in range(0x110000)]
    return np.array([c.isalpha() for c in points]), np.array([c.isdecimal() for c in points])


def _letters_and_digits(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every byte, whether it is part of a letter, and the first byte of a digit."""
    letter, digit = _LETTER[data], _DIGIT[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        alpha, decimal = _characters()
        first = data[lead].astype(np.int64)
        more = 1 + (first >= 0xE0) + (first >= 0xF0)  # bytes that follow
        point = first & (0x3F >> more)
        for i in (1, 2, 3):
            has = more >= i
            point[has] = point[has] << 6 | data[lead[has] + i] & 0x3F
        digit[lead] = decimal[point]
        is_letter = alpha[point]
        lead, more = lead[is_letter], more[is_letter]
        letter[lead] = True
        for i in (1, 2, 3):
            letter[lead[more >= i] + i] = True
    return letter, digit


def _suspects(run: Text, triggers: np.ndarray) -> np.ndarray:
    """All rows that have an entity, and some more: those with an at sign, four digits of any
    script, a word that introduces one, or the look of a key or of the start of an IBAN.

    Words are runs of letters. The patterns want their words between characters that are no
    letters, so each is a whole run here, whatever quote, dash or space it touches."""
    data = run.data
    letter, digit = _letters_and_digits(data)
    digits = np.concatenate([[0], np.cumsum(digit)])
    marks = np.concatenate([[0], np.cumsum(data == ord("@"))])
    low, high = run.edges[:-1], run.edges[1:]
    found = (digits[high] - digits[low] >= 4) | (marks[high] > marks[low])
    words = words_of(Text(np.where(letter, data, np.uint8(32)), run.edges, run.first))
    found[words.row[np.isin(words.key, triggers)]] = True
    a, k, i, s = (ord(c) for c in "AKIS")
    second = (data[1:-2] == k) | (data[1:-2] == s)
    key = (data[:-3] == a) & second & (data[2:-1] == i) & (data[3:] == a)
    capital = _CAPITAL[data]
    iban = capital[:-2] & capital[1:-1] & digit[2:]
    for start in (np.flatnonzero(key), np.flatnonzero(iban)):
        found[np.searchsorted(run.edges, start, side="right") - 1] = True
    # Long runs of hexadecimal digits; one over the edge of rows counts for all of them.
    ends = np.concatenate([[-1], np.flatnonzero(~_HEX[data]), [len(data)]])
    for n in np.flatnonzero(np.diff(ends) > 32).tolist():
        start, end = ends[n] + 1, ends[n + 1]
        if digits[end] > digits[start]:
            first, last = np.searchsorted(run.edges, [start, end - 1], side="right") - 1
            found[first : last + 1] = True
    return np.flatnonzero(found)


def entities(documents: DataFrame, text: str = "text") -> DataFrame:
    """The distinct entities of all texts: kind and canonical form."""

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triggers = _trigger_keys()
        for batch in batches:
            column, found = batch.column(0), set()
            for run in text_runs(column):
                for i in _suspects(run, triggers).tolist():
                    value = column[run.first + i].as_py()
                    found.update((m.kind, m.canonical) for m in mentions(value))
            pairs = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)],
                names=["kind", "canonical"],
            )

    return map_batches(documents.select(text), detect, FOUND).distinct()


def _drawn(state: DataFrame, key: bytes) -> DataFrame:
    """``state`` (kind, canonical, attempt) with the surrogate of that attempt."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            made = [surrogate(kind, canonical, n, key) for kind, canonical, n in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())],
                names=[*batch.schema.names, "made"],
            )

    return map_batches(state, draw, f"{FOUND}, attempt int, made string")


def collided(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """The entities whose first surrogate is another entity, or another's surrogate, with the
    number of the attempt that is neither. Of equal surrogates, the one of the earliest attempt
    stays, then the one of the first canonical form; so settled ones are never disturbed.

    A round draws only for the entities that are not settled. They end, as forms that are full are
    left (``surrogates.EXACT_ATTEMPTS``)."""
    originals = stored(found, "entities")
    pair = ["kind", "made"]
    taken = [originals.select("kind", F.col("canonical").alias("made"))]
    settled: list[DataFrame] = []
    draws = originals.withColumn("attempt", F.lit(0))
    while True:
        state = stored(_drawn(draws, key), "surrogates")
        wanted = state.select(*pair).distinct()
        gone = [table.join(wanted, pair, "left_semi").select(*pair) for table in taken]
        gone = reduce(DataFrame.union, gone).distinct()
        first = state.groupBy(*pair).agg(F.min("canonical").alias("canonical"))
        first = first.join(gone, pair, "left_anti")
        done = stored(state.join(first, [*pair, "canonical"], "left_semi"), "settled")
        settled.append(done.where("attempt > 0").select("kind", "canonical", "attempt"))
        taken.append(done.select(*pair))
        again = state.join(done.select("kind", "canonical"), ["kind", "canonical"], "left_anti")
        draws = again.select("kind", "canonical", (F.col("attempt") + 1).cast("int").alias("attempt"))
        if draws.isEmpty():
            return reduce(DataFrame.union, settled)


def _attempts_by_text(documents: DataFrame, text: str, exceptions: DataFrame) -> DataFrame:
    """Per hash of a text its entities that drew again."""

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triggers = _trigger_keys()
        for batch in batches:
            column, hashes = batch.column("_text"), batch.column("_hash").to_pylist()
            rows = []
            for run in text_runs(column):
                for i in _suspects(run, triggers).tolist():
                    value = column[run.first + i].as_py()
                    rows += {
                        (hashes[run.first + i], m.kind, m.canonical) for m in mentions(value)
                    }
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                names=["_hash", "kind", "canonical"],
            )

    texts = documents.select(F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    found = map_batches(texts, detect, f"_hash long, {FOUND}").distinct()
    return (
        found.join(exceptions, ["kind", "canonical"])
        .groupBy("_hash")
        .agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("_again"))
    )


def with_surrogates(
    documents: DataFrame, key: bytes = KEY, text: str = "text", max_sent: int = MAX_SENT
) -> DataFrame:
    """All rows and columns of ``documents`` with the text's entities replaced, and ``pii``: kind
    and place of each surrogate in the new text, in code points. A column ``pii`` is replaced.

    Equal entities get equal surrogates and different ones different surrogates, in the whole
    table; no surrogate is an entity of the table. Null texts stay null; texts without entities
    stay as they are. Rows may repeat, ids play no part.

    Entities whose first surrogate collided are few; they go to all tasks if they are at most
    ``max_sent``, else to the texts that mention them, by a join on the text's hash.
    """
    kept = [c for c in documents.columns if c != "pii"]
    exceptions = collided(entities(documents, text), key)
    few = exceptions.limit(max_sent + 1).count() <= max_sent
    known: dict[tuple[str, str], int] = {}
    rows = documents.select(*kept)
    if few:
        known = {(r["kind"], r["canonical"]): r["attempt"] for r in exceptions.collect()}
    else:
        again = _attempts_by_text(documents, text, exceptions)
        rows = rows.withColumn("_hash", F.xxhash64(text)).join(again, "_hash", "left")
        rows = rows.drop("_hash")
    send_package(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(known)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triggers, common = _trigger_keys(), sent.value
        for batch in batches:
            column = batch.column(text)
            texts, places = column.to_pylist(), [[] for _ in range(batch.num_rows)]
            again = None if few else batch.column("_again").to_pylist()
            for run in text_runs(column):
                for i in _suspects(run, triggers).tolist():
                    row, attempts = run.first + i, common
                    if again and again[row]:
                        attempts = {(x["kind"], x["canonical"]): x["attempt"] for x in again[row]}
                    texts[row], found = replaced(texts[row], attempts, key)
                    places[row] = [(m.kind, m.start, m.end) for m in found]
            fields = [pa.field("kind", pa.string()), pa.field("start", pa.int32())]
            kind = pa.list_(pa.struct([*fields, pa.field("end", pa.int32())]))
            listed = [[dict(zip(("kind", "start", "end"), p)) for p in row] for row in places]
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(listed, kind)], names=[*kept, "pii"]
            )

    schema = T.StructType([*(documents.schema[c] for c in kept), T.StructField("pii", _PII)])
    return map_batches(rows, replace, schema)
