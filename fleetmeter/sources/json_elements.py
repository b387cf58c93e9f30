"""Large JSON array files, read element by element by many tasks.

A file is read as text that ends at each closing brace, so Spark splits it like a file of lines.
Runs of that text are chunks. Where a chunk begins inside the document is not known when it is
read, but what it does is: it takes "in a string or not" to the same at its end, moves the depth
of brackets, and may open an outermost bracket. These effects compose, so the state at the start
of every chunk follows from the effects of those before it. Then each chunk cuts its own elements,
and only elements that lie across chunks are put together.

Depth never falls below zero: a closing bracket too many is text outside all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import groupby, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.functions.times import TimeLike, as_ntz, utc_now
from fleetmeter.operators.join_back import computed_and_counted
from fleetmeter.operators.running import with_total_before
from fleetmeter.schemas import LOADS
from fleetmeter.session import work_folder
from fleetmeter.sources.json_files import BAD_JSON, FULL_PATH, file_name, with_document
from fleetmeter.workers import map_batches

UNFINISHED = "file ends inside a document"

CHUNK_BYTES = 1 << 20
# An element, or what is set aside in one row, is at most about so long; more goes to more rows.
MAX_BYTES = 1 << 24
_CUT = "}"
_QUOTE, _ESCAPE, _COMMA = (ord(c) for c in '"\\,')
_OPEN, _CLOSE, _BRACKETS, _CUTTING = (
    np.isin(np.arange(256), [ord(c) for c in x]) for x in ("[{", "]}", '"[{]}', '"[{]},')
)
_STEP = _OPEN.astype(np.int64) - _CLOSE
_ARRAY = ord("[")
# Rows from a task go on in batches of about so many bytes of text, or so many rows.
_BATCH_BYTES, _BATCH_ROWS = 1 << 20, 10_000
_LISTING_TASKS = 4
_BLANK = b" \t\n\r"


class Effect(NamedTuple):
    """What text does, if it begins outside or inside a string (``quoted``): whether it ends in a
    string, the sum of its brackets, the least such sum on the way (at most 0), and the bracket
    that opened the document in which the text ends, if it begins at depth 0; 0 if it ends there."""

    quoted: bool
    depth: int = 0
    least: int = 0
    outer: int = 0

    def then(self, after: Effect) -> Effect:
        """This text and then one that begins as this ends."""
        least = min(self.least, self.depth + after.least)
        ends_at = self.depth - self.least
        outer = after.outer if ends_at + after.least <= 0 else self.outer
        return Effect(after.quoted, self.depth + after.depth, least, outer)


class Marks(NamedTuple):
    """The structural characters of a text, in strings or not: their places, and whether an odd
    number of quotation marks comes before; so of the whole text too."""

    place: np.ndarray
    code: np.ndarray
    odd: np.ndarray
    ends_odd: bool


class Brackets(NamedTuple):
    """Of the structural characters of a chunk: their places, and the depth before and after."""

    place: np.ndarray
    code: np.ndarray
    before: np.ndarray
    after: np.ndarray


def _quotes(data: np.ndarray) -> np.ndarray:
    """Quotation marks that are not escaped."""
    quotes = data == _QUOTE
    escapes = data == _ESCAPE
    if escapes.any():
        # An odd number of backslashes directly before a character escapes it.
        at = np.arange(len(data))
        last = np.maximum.accumulate(np.where(escapes, -1, at))
        run = np.concatenate([[0], (at - last)[:-1]])
        quotes &= run % 2 == 0
    return quotes


def _marks(data: np.ndarray, wanted: np.ndarray) -> Marks:
    place = np.flatnonzero(wanted[data])
    code = data[place]
    marks = code == _QUOTE
    odd = np.cumsum(_quotes(data)[place] if (data == _ESCAPE).any() else marks) % 2 == 1
    return Marks(place[~marks], code[~marks], odd[~marks], bool(odd[-1]) if len(odd) else False)


def _brackets(marks: Marks, quoted: bool, depth: int) -> Brackets:
    """The marks outside strings, if the text begins in a string or not and at this depth."""
    outside = marks.odd == quoted
    code = marks.code[outside]
    after = depth + np.cumsum(_STEP[code])
    if len(after) and after.min() < 0:
        after -= np.minimum(np.minimum.accumulate(after), 0)
    before = np.concatenate([[depth], after[:-1]]) if len(after) else after
    return Brackets(marks.place[outside], code, before, after)


def _effect(marks: Marks, quoted: bool) -> Effect:
    found, ends_quoted = _brackets(marks, quoted, 0), marks.ends_odd != quoted
    sums = np.cumsum(_STEP[found.code])
    if not len(sums):
        return Effect(ends_quoted)
    outer = 0
    if found.after[-1]:
        opens = np.flatnonzero((found.before == 0) & (found.after == 1))
        outer = int(found.code[opens[-1]])
    return Effect(ends_quoted, int(sums[-1]), int(min(0, sums.min())), outer)


def effects_of(data: np.ndarray) -> list[Effect]:
    """What the data does if it begins outside a string, and if inside."""
    marks = _marks(data, _BRACKETS)
    return [_effect(marks, quoted) for quoted in (False, True)]


def effect_of(data: np.ndarray, quoted: bool) -> Effect:
    return _effect(_marks(data, _BRACKETS), quoted)


class Piece(NamedTuple):
    """A part of a chunk between two places where elements end. ``left`` and ``right`` say what
    ends there: [ and ] of an outer array, its commas, o and c before and after an outer object;
    None where the chunk ends."""

    text: bytes
    left: str | None
    right: str | None


def pieces_of(data: np.ndarray, quoted: bool, depth: int, outer: int) -> list[Piece]:
    found = _brackets(_marks(data, _CUTTING), quoted, depth)
    opens = (found.before == 0) & (found.after == 1)
    last = np.maximum.accumulate(np.where(opens, np.arange(len(opens)), -1))
    within = np.where(last >= 0, found.code[last], outer)
    closes = (found.before == 1) & (found.after == 0)
    array = within == _ARRAY
    comma = (found.code == _COMMA) & (found.before == 1) & array
    kind = np.select([comma, array & opens, array, opens], [",", "[", "]", "o"], "c")
    cuts = opens | closes | comma
    place, kind = found.place[cuts], kind[cuts]
    kinds = kind.tolist()
    begins, ends = [0, *(place + (kind != "o")).tolist()], [*(place + (kind == "c")).tolist(), len(data)]
    raw = data.tobytes()
    return [Piece(raw[i:j], *x) for i, j, *x in zip(begins, ends, [None, *kinds], [*kinds, None])]


def _is_nothing(text: bytes, left: str | None, right: str | None) -> bool:
    """White space around documents and in empty arrays. After or before a comma it is missing."""
    return "," not in (left, right) and not text.strip(_BLANK)


_EFFECTS = "struct<quoted: boolean, depth: long, least: long, outer: int>"
_CHUNKS = f"file_path string, file_size long, block long, seq int, text binary, bytes long, before array<{_EFFECTS}>, after array<{_EFFECTS}>, unclosed array<{_EFFECTS}>"
_EFFECT_TYPE = pa.list_(
    pa.struct([("quoted", pa.bool_()), ("depth", pa.int64()), ("least", pa.int64()), ("outer", pa.int32())])
)
_CHUNK_SCHEMA = pa.schema(
    [
        ("file_path", pa.string()), ("file_size", pa.int64()), ("block", pa.int64()), ("seq", pa.int32()),
        ("text", pa.binary()), ("bytes", pa.int64()), ("before", _EFFECT_TYPE), ("after", _EFFECT_TYPE),
        ("unclosed", _EFFECT_TYPE),
    ]
)


def _read_chunks(chunk_bytes: int):
    """Rows of text, in the order of their file block, to chunks."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list[bytes], bool]]:
        """Runs of about ``chunk_bytes`` of one block: its key and texts, and if it is the last."""
        key, held, size = None, [], 0
        for batch in batches:
            all_texts, (names, sizes, starts) = batch.column(0).to_pylist(), batch.columns[1:]
            others = (pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False) for x in (names, starts))
            changes = (np.flatnonzero(np.logical_or(*others)) + 1).tolist()
            for begin, end in pairwise([0, *changes, batch.num_rows]):
                at = tuple(x[begin].as_py() for x in (names, sizes, starts)) if end else key
                for text in all_texts[begin:end]:
                    if held and (at != key or size >= chunk_bytes):
                        yield key, held, at != key
                        held, size = [], 0
                    key = at
                    held.append(text)
                    size += len(text) + 1
        if held:
            yield key, held, True

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seq, rows, held = None, 0, [], 0
        for key, texts, is_last in blocks(batches):
            if key != last:
                last, seq, size, state = key, 0, 0, [Effect(False), Effect(True)]
            # The closing brace that the reader took away; behind the last of a file it may be none.
            text = b"}".join([*texts, b""])
            data = np.frombuffer(text, np.uint8)
            own = effects_of(data)
            after = [x.then(own[x.quoted]) for x in state]
            size += len(text)
            row = dict(zip(_CHUNK_SCHEMA.names, [*key, seq, text]))
            row["before"] = [x._asdict() for x in state]
            if is_last:
                own = effects_of(data[:-1])
                unclosed = [x.then(own[x.quoted])._asdict() for x in state]
                row |= {"bytes": size, "after": [x._asdict() for x in after], "unclosed": unclosed}
            rows.append(row)
            held += len(text)
            if held >= _BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, _CHUNK_SCHEMA)
                rows, held = [], 0
            state, seq = after, seq + 1
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _CHUNK_SCHEMA)

    return read


def _chunks(spark: SparkSession, path: str | Sequence[str], only: Sequence[str] | None, chunk_bytes: int) -> DataFrame:
    """The chunks of all files, stored: the blocks of a later reading might be others. The last of
    a block has what the block does and how long it is."""
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", _CUT)
    with _few_listing_tasks(spark):
        text = reader.text(path)
    if only is not None:
        text = text.filter(F.col(FULL_PATH).isin(list(only)))
    rows = text.select(
        F.col("value").cast("binary").alias("value"),
        F.col(FULL_PATH).alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    chunks = map_batches(rows, _read_chunks(chunk_bytes), _CHUNKS)
    # Named here, where a row is a chunk and no longer a text between two braces.
    named = chunks.withColumn("file_name", file_name(spark, path, "file_path"))
    return _kept(named.drop("file_path"), "chunks")


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core; Spark's own are one a folder, up to 10,000, and
    each takes longer to start than to list a folder."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), _LISTING_TASKS * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_STATES = "file_name string, block long, last_seq int, drop boolean, quoted boolean, depth long, outer int"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states of files whose blocks come in order. One small row for each block."""
    rows = (row for batch in batches for row in batch.to_pylist())
    states = []
    for _, blocks in groupby(rows, key=lambda r: r["file_name"]):
        states += _states_of(list(blocks))
        if len(states) >= _BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(states, _STATE_SCHEMA)
            states = []
    if states:
        yield pa.RecordBatch.from_pylist(states, _STATE_SCHEMA)


def _states_of(rows: list[dict]) -> list[dict]:
    """The state at the start of each block of a file, from the effects of those before it, and in
    a row of block -1 that at the end.

    The reader does not tell whether the last text of a file had its brace. If not, all texts with
    a brace each are one byte longer than the file, not counting a byte order mark of three."""
    extra = (sum(r["bytes"] for r in rows) - rows[0]["file_size"]) % 3 == 1
    state, states = (False, 0, 0), []
    for row in [*rows, {"block": -1, "last_seq": -1}]:
        last = row is rows[-1]
        found = (rows[0]["file_name"], row["block"], row["last_seq"], last and extra, *state)
        states.append(dict(zip(_STATE_SCHEMA.names, found)))
        if "effect" in row:
            effect = "unclosed" if last and extra else "effect"
            state = _entered(*state, Effect(**row[effect][state[0]]))
    return states


_STATE_SCHEMA = pa.schema(
    [
        ("file_name", pa.string()), ("block", pa.int64()), ("last_seq", pa.int32()), ("drop", pa.bool_()),
        ("quoted", pa.bool_()), ("depth", pa.int64()), ("outer", pa.int32()),
    ]
)


def _entered(quoted: bool, depth: int, outer: int, effect: Effect) -> tuple[bool, int, int]:
    """The state after text of this effect."""
    if depth + effect.least <= 0:  # it meets depth 0, and goes on from there like any that does
        outer = effect.outer
    return effect.quoted, max(depth + effect.depth, effect.depth - effect.least), outer


def _states(chunks: DataFrame) -> DataFrame:
    ends = chunks.where("after IS NOT NULL")
    blocks = ends.groupBy("file_name", "block").agg(
        F.max("file_size").alias("file_size"),
        F.sum("bytes").alias("bytes"),
        F.max("seq").alias("last_seq"),
        F.max_by("after", "seq").alias("effect"),
        F.max_by("unclosed", "seq").alias("unclosed"),
    )
    in_order = blocks.repartition("file_name").sortWithinPartitions("file_name", "block")
    return _kept(map_batches(in_order, _walk, _STATES), "states")


_PIECES = "file_name string, block long, seq int, nth int, left string, right string, text binary"
_PIECE_SCHEMA = pa.schema(
    [
        ("file_name", pa.string()), ("block", pa.int64()), ("seq", pa.int32()), ("nth", pa.int32()),
        ("left", pa.string()), ("right", pa.string()), ("text", pa.binary()),
    ]
)


def _cut_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for batch in batches:
        texts = batch.column("text")
        for row, text in zip(batch.drop_columns(["text"]).to_pylist(), texts):
            before = Effect(**row["before"][row["quoted"]])
            state = _entered(row["quoted"], row["depth"], row["outer"], before)
            data = np.frombuffer(text.as_buffer(), np.uint8)
            if row["drop"] and row["seq"] == row["last_seq"]:
                data = data[:-1]
            at = row["file_name"], row["block"], row["seq"]
            rows += [
                (*at, i, p.left, p.right, p.text) for i, p in enumerate(pieces_of(data, *state))
                if p.left is None or p.right is None or not _is_nothing(*p)
            ]
            held += len(data)
            if held >= _BATCH_BYTES:
                yield _piece_batch(rows)
                rows, held = [], 0
    if rows:
        yield _piece_batch(rows)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(x, f.type) for x, f in zip(zip(*rows), _PIECE_SCHEMA)]
    return pa.RecordBatch.from_arrays(columns, schema=_PIECE_SCHEMA)


def _bucket(block: Column) -> Column:
    """Blocks are megabytes apart."""
    return F.floor(block / (1 << 20))


def _across(parts: DataFrame, max_bytes: int) -> DataFrame:
    """Elements that lie in several chunks, put together: where they begin, and all their text. Of
    one longer than ``max_bytes`` the parts stay as they are, ``whole`` false."""
    # What is counted is read without the text.
    order = ["block", "seq", "nth"]
    places = parts.select(
        "file_name", *order, "left", "right", F.length("text").alias("size"),
        F.col("left").isNotNull().cast("int").alias("begins"),
        _bucket(F.col("block")).alias("bucket"),
    )
    places = with_total_before(places, "file_name", "bucket", order, "begins", "chain")
    places = places.withColumn("chain", F.col("chain") + F.col("begins"))
    chains = places.groupBy("file_name", "chain").agg(
        F.sum("size").alias("total"), F.max("left").alias("from"), F.max("right").alias("to")
    )
    sized = places.select("file_name", *order, "chain").join(chains, ["file_name", "chain"])
    texts = parts.select("file_name", *order, F.col("text").cast("string").alias("text"))
    parts = texts.join(sized, ["file_name", *order])
    short = parts.where(F.col("total") <= max_bytes).groupBy("file_name", "chain").agg(
        F.array_sort(F.collect_list(F.struct(*order, "text"))).alias("parts"),
        F.first("from").alias("left"),
        F.first("to").alias("right"),
    )
    first = F.get("parts", F.lit(0))
    short = short.select(
        "file_name", *(first[c].alias(c) for c in order), "left", "right",
        F.array_join(F.col("parts.text"), "").alias("text"), F.lit(True).alias("whole"),
    )
    long = parts.where(F.col("total") > max_bytes).select(
        "file_name", *order, F.col("from").alias("left"), F.col("to").alias("right"), "text",
        F.lit(False).alias("whole"),
    )
    return short.union(long)


def load_elements(
    spark: SparkSession,
    path: str | Sequence[str],
    loaded_at: TimeLike | None = None,
    only: Sequence[str] | None = None,
    chunk_bytes: int = CHUNK_BYTES,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Load rows of JSON files: one per element of their arrays, and of a damaged file one with
    what is left, set aside.

    For a file that is one valid document the rows are those of reading it whole: the elements of
    an array, or the document. Further documents of a file are read too, arrays next to each other
    or objects one after the other. What cannot be read as an element, or is missing where a comma
    asks for it, is joined to one text a file, in order, by line breaks; so is an unfinished end. A
    number or word at a broken end is set aside, as it may be cut. A file that only lacks its last
    bracket gives a row with an empty text, so no damage goes without notice. Texts beyond
    ``max_bytes`` are set aside in parts, none of them lost.

    ``only`` keeps the files of these full paths. Files that are compressed as a whole are one
    task each, until they are cut.
    """
    chunks = _chunks(spark, path, only, chunk_bytes)
    states = _states(chunks)
    begins, few = computed_and_counted(states.where("block >= 0"))
    placed = chunks.drop("file_size", "bytes", "after", "unclosed").join(
        F.broadcast(begins) if few else begins, ["file_name", "block"]
    )
    pieces = _kept(map_batches(placed, _cut_chunks, _PIECES), "pieces")
    # Where a file begins, so does an element; a chunk that has no end in it is a part throughout.
    at_start = (F.col("block") == 0) & (F.col("seq") == 0) & (F.col("nth") == 0)
    left = F.when(at_start, F.lit("")).otherwise(F.col("left"))
    pieces = pieces.withColumn("left", left)
    cut = F.col("left").isNull() | F.col("right").isNull()
    inner = pieces.where(~cut).withColumn("text", F.col("text").cast("string"))
    parts = _kept(pieces.where(cut), "parts")
    elements = inner.withColumn("whole", F.lit(True)).unionByName(_across(parts, max_bytes))
    blank = ~F.col("text").rlike(r"[^ \t\n\r]")
    beside_comma = F.coalesce(F.col("left") == ",", F.lit(False)) | F.coalesce(F.col("right") == ",", F.lit(False))
    elements = elements.where(~blank | beside_comma & F.col("right").isNotNull())
    # A broken end: only a bracket or quotation mark shows that the element is all there.
    closed = F.col("right").isNotNull() | F.col("left").isin("", "c", "]") | F.col("text").rlike(r'["}\]][ \t\n\r]*$')
    read = with_document(elements, F.when(F.col("whole") & closed & ~blank, F.col("text")))
    # Stored, as what is good and what is set aside would each be parsed, and parsed for a filter.
    text = F.when(F.col("json_data").isNull(), F.col("text")).alias("text")
    read = _kept(read.select("file_name", "block", "seq", "nth", text, "json_data"), "elements")
    return _load_rows(read, states, loaded_at, max_bytes)


def _load_rows(read: DataFrame, states: DataFrame, loaded_at: TimeLike | None, max_bytes: int) -> DataFrame:
    stamp = utc_now() if loaded_at is None else as_ntz(loaded_at)
    good = read.where("json_data IS NOT NULL").select(
        "json_data",
        F.lit(None).cast("string").alias("raw"),
        F.lit(None).cast("string").alias("error"),
        "file_name",
    )
    order = ["block", "seq", "nth"]
    bad = read.where("json_data IS NULL").select("file_name", *order, "text", F.lit(BAD_JSON).alias("error"))
    far = F.lit(2**62)
    ends = states.where("block = -1 AND (quoted OR depth > 0)").select(
        "file_name", far.alias("block"), F.lit(0).alias("seq"), F.lit(0).alias("nth"),
        F.lit("").alias("text"), F.lit(UNFINISHED).alias("error"),
    )
    bad = _kept(bad.union(ends), "set-aside")
    bad = bad.withColumn("bucket", _bucket(F.col("block"))).withColumn("size", F.length("text"))
    bad = with_total_before(bad, "file_name", "bucket", order, "size", "begin")
    part = F.floor(F.col("begin") / max_bytes)
    texts = F.transform(
        F.array_sort(F.collect_list(F.struct(*order, "text"))), lambda x: x["text"]
    )
    aside = bad.groupBy("file_name", part.alias("part")).agg(
        F.array_join(F.filter(texts, lambda x: x != ""), "\n").alias("raw"),
        F.min("error").alias("error"),
    )
    nothing = F.lit(None).cast("variant").alias("json_data")
    rows = good.union(aside.select(nothing, "raw", "error", "file_name"))
    return rows.select(
        "json_data", "raw", "error", "file_name", stamp.alias("loaded_at"),
        F.col("error").isNull().alias("ok"),
    ).select(*LOADS.names)
