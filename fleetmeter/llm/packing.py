"""Harmonic packing of tokenised documents into sequences of fixed capacity.

Classes are reciprocal parts of the capacity C: a bin of class k takes exactly k pieces, none
longer than C / k. Documents may be cut, so a document gives full pieces of C, one piece for each
binary digit of what is left down to ``SMALLEST`` (C/2, C/4, ..., which fill a bin to the last
token), and a rest below it, of class C // length. So every class's bins are filled by counting
alone, in any number of tasks at once: the n-th piece of a class goes to bin n // k.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmeter.llm.stored import stored
from fleetmeter.workers import map_batches

CAPACITY = 1024
SMALLEST = 16
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# Over a run of a million white space characters the pattern's backtracking fails.
LONG_SPACE = 100_000
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# A run is tried from its first character only, so the search takes linear time.
_LONG_RUN = re.compile(rf"(?<!{_SPACE}){_SPACE}{{{LONG_SPACE},}}+")
# Pieces of a class and bucket are numbered in one task.
BUCKET_ROWS = 10_000
MAX_BUCKETS = 4_096
PIECES = """start long, length long, ids_crc32 long, doc_tokens long"""


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The tokenizer of a byte-level BPE file, run by a library that is four times as fast and
    gives the same ids. Special tokens in a text are ordinary text: see :func:`token_ids`."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {token["content"] for token in content["added_tokens"]}
    # The file writes each byte as a printable character: itself, or one from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in content["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding(
        "byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=2)
def _added(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """A pattern for the file's added tokens, the longest first, and their ids."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    for token in tokens:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} takes more than its own text")
    ids = {token["content"]: token["id"] for token in tokens}
    longest = sorted(ids, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, longest))) if ids else None, ids


def _ordinary_ids(text: str, path: str) -> list[int]:
    """The ids of a text without added tokens. Of a long run of white space the pattern makes one
    piece, without the last character if more follows; such pieces are cut out here."""
    encoding = _encoding(path)
    if len(text) < LONG_SPACE:
        return encoding.encode_ordinary(text)
    whole = _encoding(path, r"(?s:.+)")
    ids: list[int] = []
    at = 0
    for match in _LONG_RUN.finditer(text):
        end = match.end() - (match.end() < len(text))
        ids += encoding.encode_ordinary(text[at : match.start()])
        ids += whole.encode_ordinary(text[match.start() : end])
        at = end
    return ids + encoding.encode_ordinary(text[at:])


def token_ids(text: str, path: str = TOKENIZER) -> list[int]:
    """The ids of a text as ``tokenizers`` gives them with ``add_special_tokens=False``: an added
    token of the file is one id wherever it stands, and parts the text."""
    pattern, added = _added(path)
    ids: list[int] = []
    at = 0
    for match in pattern.finditer(text) if pattern else ():
        ids += _ordinary_ids(text[at : match.start()], path)
        ids.append(added[match[0]])
        at = match.end()
    return ids + _ordinary_ids(text[at:], path)


def cut_lengths(total: int, capacity: int = CAPACITY, smallest: int = SMALLEST) -> list[int]:
    """Piece lengths of a document of ``total`` tokens, the longest first."""
    lengths = [capacity] * (total // capacity)
    rest, part = total % capacity, capacity // 2
    while part >= smallest:
        if rest >= part:
            lengths.append(part)
            rest -= part
        part //= 2
    return lengths + [rest] * (rest > 0)


def pieces(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    smallest: int = SMALLEST,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every row: its id under its name, ``start`` (tokens of the row before it),
    ``length``, ``ids_crc32`` (of the ids as little-endian 32-bit numbers), ``doc_tokens``, and
    ``ids`` themselves if asked for. A row's ids are its text's and ``end_id``; a null or empty
    text has only that one, so every row has at least one piece."""
    names = [id_column, "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    kind = documents.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            out: list[list] = [[], [], [], [], []]
            for row, value in enumerate(batch.column(text)):
                ids = np.array([*token_ids(value.as_py() or "", tokenizer), end_id], dtype="<u4")
                start = 0
                for length in cut_lengths(len(ids), capacity, smallest):
                    piece = ids[start : start + length]
                    rows.append(row)
                    for column, x in zip(out, (start, length, zlib.crc32(piece), len(ids))):
                        column.append(x)
                    if with_ids:
                        out[4].append(piece.astype(np.int32))
                    start += length
            columns = [pa.array(x, pa.int64()) for x in out[:4]]
            if with_ids:
                columns.append(pa.array(out[4], pa.list_(pa.int32())))
            of_row = batch.column(id_column).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([of_row, *columns], names=names)

    schema = f"`{id_column}` {kind}, {PIECES}" + ", ids array<int>" * with_ids
    return map_batches(documents.select(id_column, text), cut, schema)


def placed(
    cut: DataFrame,
    id_column: str = "doc_id",
    capacity: int = CAPACITY,
    smallest: int = SMALLEST,
) -> DataFrame:
    """The rows of :func:`pieces` with ``sequence_id`` and ``offset`` in that sequence.

    Pieces of a class are counted by hash bucket of the id; what the buckets before hold is added
    to a piece's place in its own, so the buckets fill bins independently and only the last bin
    of a class is not full. Pieces of a bin lie in the order of their places.
    """
    if smallest * smallest > capacity:
        raise ValueError("rests could be of the same class as cut pieces")
    cut = cut.withColumn("_class", F.expr(f"int({capacity} div length)"))
    total = cut.count()
    buckets = min(MAX_BUCKETS, max(1, -(-total // BUCKET_ROWS)))
    bucket = F.pmod(F.xxhash64(id_column, "start"), F.lit(buckets)).cast("int")
    cut = cut.withColumn("_bucket", bucket)
    # At most as many rows as classes times buckets, both bounded.
    counts = cut.groupBy("_class", "_bucket").agg(F.count("*").alias("_n")).collect()
    numbers, sequences = [], 0
    for k in sorted({r["_class"] for r in counts}):
        before = 0
        for r in sorted((r for r in counts if r["_class"] == k), key=lambda r: r["_bucket"]):
            numbers.append((k, r["_bucket"], sequences, before))
            before += r["_n"]
        sequences += -(-before // k)
    offsets = cut.sparkSession.createDataFrame(
        numbers, "_k int, _b int, _first_sequence long, _before long"
    )
    order = W.partitionBy("_class", "_bucket").orderBy(id_column, "start", "ids_crc32")
    numbered = cut.withColumn("_place", F.row_number().over(order) - 1)
    same = (F.col("_class") == F.col("_k")) & (F.col("_bucket") == F.col("_b"))
    numbered = numbered.join(F.broadcast(offsets), same)
    numbered = numbered.withColumn("_place", F.col("_place") + F.col("_before"))
    numbered = numbered.withColumn(
        "sequence_id", F.col("_first_sequence") + F.expr("_place div _class")
    )
    # Only rests differ in length within a class.
    in_bin = W.partitionBy("sequence_id").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
    exact = F.col("length") >= smallest
    arithmetic = numbered.where(exact).withColumn(
        "offset", F.col("_place") % F.col("_class") * F.col("length")
    )
    summed = numbered.where(~exact).withColumn(
        "offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0))
    )
    inner = ["_class", "_bucket", "_place", "_k", "_b", "_first_sequence", "_before"]
    return arithmetic.unionByName(summed).drop(*inner)


def packed(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every token of every row in a sequence: the columns of :func:`pieces` and
    :func:`placed`. Repeated rows are packed each; rows without id too, under a null id."""
    cut = stored(pieces(documents, id_column, text), "pieces")
    return placed(cut, id_column)
