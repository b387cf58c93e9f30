"""Repair of conversation structure by generalised LR parsing with edits.

The roles of a conversation should read as the grammar has them:

    dialogue  -> (nothing) | exchanges | system exchanges
    exchanges -> exchange | exchanges exchange
    exchange  -> user assistant

A parser shifts the rows one by one. Each row may be kept, given another role or deleted, and
rows may be inserted before it; every edit has a cost and a letter. All parses go on side by side
in a graph-structured stack: one node per row and stack top, linked to the node it came from.
Parses whose stacks have equal tops are merged, and the one of least (cost, letters) stays.

Letters of equal stacks are compared by rank. The letters of one row (insertions, then one of
K, R and D) are never the beginning of another row's, so two parses that have read as many rows
differ at a row or not at all, and the order of earlier letters decides before later ones.

A conversation may be longer than one task should read. So rows are cut into pieces in order, a
piece is parsed from every stack top, and the pieces' tables of (top, top) are put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.stored import stored
from fleetmeter.workers import map_batches, send_package
from fleetmeter.operators.join_back import join_groups

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"

# Stack tops: nothing, a system row, a user row without answer, whole exchanges.
EMPTY, SYSTEM, USER, EXCHANGES = range(4)
TOPS = (EMPTY, SYSTEM, USER, EXCHANGES)
# Shifting an assistant row completes an exchange, which is reduced to exchanges at once.
SHIFT = {
    (EMPTY, "s"): SYSTEM,
    (EMPTY, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): EXCHANGES,
    (EXCHANGES, "u"): USER,
}
# Rows inserted at a top, and the top they lead to. Two at USER or EXCHANGES would lead back.
INSERTED = {
    EMPTY: [("", EMPTY), ("u", USER), ("ua", EXCHANGES)],
    SYSTEM: [("", SYSTEM), ("u", USER), ("ua", EXCHANGES)],
    USER: [("", USER), ("a", EXCHANGES)],
    EXCHANGES: [("", EXCHANGES), ("u", USER)],
}
ACCEPTED = {EMPTY: "", SYSTEM: "ua", USER: "a", EXCHANGES: ""}

# The live parses by top: (cost above the least, rank of the letters), or None.
Tops = tuple[tuple[int, int] | None, ...]


class Row(NamedTuple):
    """``initial`` of the role, whether the row must go, whether it is truncated, and how many
    more rows like it follow at once, which must all go."""

    initial: str
    must_go: bool
    truncated: bool
    again: int = 0


def _dominated(top: int, cost: int, costs: dict[int, int]) -> bool:
    """Whether another parse can do whatever this one does later at a lower total cost."""
    limits = {
        # From an empty stack a system row may be kept; others delete it.
        EMPTY: {USER: INSERT + DELETE, EXCHANGES: DELETE},
        SYSTEM: {USER: INSERT, EXCHANGES: 0},
        USER: {EXCHANGES: INSERT},
        EXCHANGES: {USER: INSERT},
    }[top]
    return any(other in costs and cost > costs[other] + more for other, more in limits.items())


@lru_cache(maxsize=None)
def _after(tops: Tops, row: Row) -> tuple[Tops, int, tuple]:
    """The tops after one row, the cost common to all, and for each top (top before, letters).

    Costs count from the least and dominated parses end, so there are few distinct arguments and
    a long conversation is mostly read from the cache."""
    found: dict[int, list] = {}

    def offer(top: int, cost: int, rank: int, letters: str, before: int) -> None:
        found.setdefault(top, []).append((cost, rank, letters, before))

    for top, live in enumerate(tops):
        if live is None:
            continue
        cost, rank = live
        offer(top, cost + DELETE, rank, "D", top)
        if row.must_go:
            continue
        late = TRUNCATED if row.truncated else 0
        for rows, at in INSERTED[top]:
            spent, letters = cost + INSERT * len(rows) + late, "I" * len(rows)
            if (at, row.initial) in SHIFT:
                offer(SHIFT[at, row.initial], spent, rank, letters + "K", top)
            for role in ROLES:
                if role != row.initial and (at, role) in SHIFT:
                    offer(SHIFT[at, role], spent + REROLE, rank, letters + "R", top)
    best = {top: min(offers) for top, offers in found.items()}
    costs = {top: offer[0] for top, offer in best.items()}
    best = {t: offer for t, offer in best.items() if not _dominated(t, costs[t], costs)}
    least = min((offer[0] for offer in best.values()), default=0)
    order = sorted({offer[1:3] for offer in best.values()})
    live = {t: (cost - least, order.index((rank, x))) for t, (cost, rank, x, _) in best.items()}
    links = tuple((best[t][3], best[t][2]) if t in best else None for t in TOPS)
    return tuple(live.get(t) for t in TOPS), least, links


class Parse:
    """All parses from one stack top over the rows read so far."""

    def __init__(self, top: int) -> None:
        self.tops: Tops = tuple((0, 0) if t == top else None for t in TOPS)
        self.cost = 0
        self.links: list[tuple] = []
        self.again: list[int] = []

    def read(self, row: Row) -> None:
        self.tops, cost, links = _after(self.tops, row._replace(again=0))
        self.cost += cost + DELETE * row.again
        self.links.append(links)
        self.again.append(row.again)

    def letters(self, top: int) -> str:
        """The edits of the parse that ends at ``top``, back along the links."""
        found = []
        for links, again in zip(reversed(self.links), reversed(self.again)):
            top, letters = links[top]
            found.append(letters + "D" * again)
        return "".join(reversed(found))

    def ends(self) -> list[tuple[int, int, int]]:
        """(top, cost, rank) of the live parses."""
        live = [(t, x) for t, x in enumerate(self.tops) if x is not None]
        return [(t, self.cost + cost, rank) for t, (cost, rank) in live]


def accepted(ends: Iterable[tuple[int, int, int]]) -> tuple[int, int, str]:
    """The best end of a whole conversation: its top, total cost and last insertions' letters."""
    offers = (
        (cost + INSERT * len(ACCEPTED[top]), rank, "I" * len(ACCEPTED[top]), top)
        for top, cost, rank in ends
    )
    cost, _, letters, top = min(offers)
    return top, cost, letters


def repaired(
    rows: Iterable[tuple[str, str, int]], letters: str, top: int = EMPTY
) -> Iterator[tuple[str, str]]:
    """The rows (role, text, copies) after the edits ``letters``, from ``top`` on: (role, text)."""
    edits = iter(letters)

    def inserted(top: int) -> tuple[str, int]:
        role = "a" if top == USER else "u"
        return ROLES[role], SHIFT[top, role]

    for role, text, copies in rows:
        for copy in range(copies):
            letter = next(edits)
            while letter == "I":
                new, top = inserted(top)
                yield new, ""
                letter = next(edits)
            if letter == "R":
                # The only role but the row's own that can follow.
                new, after = inserted(top)
                top = after
                yield new, text
            elif letter == "K":
                top = SHIFT[top, role[:1]]
                yield role, text
    for _ in edits:
        new, top = inserted(top)
        yield new, ""


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with the damage that a checksum of ``conv_id:turn`` decides, equal
    rows of a turn once with their number ``copies``. ``conv`` names the conversation, NULL too.
    NULL roles and texts are one space."""

    def or_space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))
    fault = F.crc32(key.cast("binary")) % 20
    text, role = or_space("text"), or_space("role")
    rows = conversations.select(
        conversation(),
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "")
        .when(fault == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("n"),
    )
    return rows.where("n > 0").groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("copies"))


def conversation() -> Column:
    """A name of the conversation that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``blank``, ``repeats`` (role and text of an earlier row) and ``truncated``;
    of the copies of a row all but the first repeat it.

    Sayings that occur at several turns are few; their first turns are joined by salted keys."""
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    said = F.sha2(F.to_json(F.array("conv", "role", "text")).cast("binary"), 256)
    rows = stored(
        rows.withColumn("said", F.unhex(said))
        .withColumn("blank", last == "")
        .withColumn("truncated", ~last.isin("", ".", "!", "?")),
        "sayings",
    )
    firsts = rows.groupBy("said").agg(
        F.when(F.count("turn") == F.count("*"), F.min("turn")).alias("first_turn"),
        F.count("*").alias("times"),
    )
    joined = join_groups(rows, firsts.where("times > 1"), "said", ["conv", "turn"])
    repeats = F.col("times").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return joined.withColumn("repeats", repeats).drop("said", "times", "first_turn")


def _in_order() -> list[Column]:
    return [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


# What the pieces give: results of conversations that lie in one piece (kind "whole"), and of the
# first and last of each piece, which may go on in others: their counts and table ("piece"), the
# letters of each way through ("way") and their rows ("row").
_PIECES = """kind string, conv string, piece int, at long, role string, text string, copies long,
blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long,
first_initial string, last_initial string, first_top int, last_top int, cost long, rank int, letters string, digest string"""
_SCHEMA = pa.schema(
    [
        (name, {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[kind])
        for name, kind in (x.split() for x in _PIECES.split(","))
    ]
)
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_LEGAL = {"su", "ua", "au"}


class _Faults:
    """Counts over the rows of one conversation in a piece, in order."""

    def __init__(self) -> None:
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None
        self.initials: tuple[str, str] | None = None

    def read(self, row: dict) -> Row:
        counts, copies, initial = self.counts, row["copies"], row["role"][:1]
        if row["blank"]:
            counts["blank"] += copies
        elif row["repeats"]:
            counts["duplicate"] += copies
        else:
            counts["duplicate"] += copies - 1
            counts["truncated"] += row["truncated"]
        if self.initials and self.initials[1] + initial not in _LEGAL:
            counts["illegal"] += 1
        counts["illegal"] += copies - 1
        self.initials = (self.initials[0] if self.initials else initial, initial)
        if row["turn"] is not None and row["turn"] != self.last:
            counts["turns"] += 1
            self.first = row["turn"] if self.first is None else self.first
            self.last = row["turn"]
        return Row(initial, row["blank"] or row["repeats"], row["truncated"], copies - 1)

    def values(self) -> dict:
        first, last = self.initials
        return self.counts | {
            "first_turn": self.first, "last_turn": self.last,
            "first_initial": first, "last_initial": last,
        }


def _whole(conv: str, rows: list[dict]) -> dict:
    faults, parse = _Faults(), Parse(EMPTY)
    for row in rows:
        parse.read(faults.read(row))
    top, cost, tail = accepted(parse.ends())
    letters = parse.letters(top) + tail
    lines = repaired(((r["role"], r["text"], r["copies"]) for r in rows), letters)
    joined = "\n".join(f"{role}:{text}" for role, text in lines)
    digest = hashlib.sha256(joined.encode()).hexdigest()
    return {"kind": "whole", "conv": conv, "cost": cost, "letters": letters, "digest": digest} | faults.values()


def _part(conv: str, piece: int, rows: Iterable[dict]) -> Iterator[dict]:
    """A conversation that may begin before the piece or go on after it."""
    faults, parses = _Faults(), [Parse(top) for top in TOPS]
    key = {"conv": conv, "piece": piece}
    for at, row in enumerate(rows):
        read = faults.read(row)
        for parse in parses:
            parse.read(read)
        yield key | {"kind": "row", "at": at} | {c: row[c] for c in ("role", "text", "copies")}
    yield key | {"kind": "piece"} | faults.values()
    for top, parse in zip(TOPS, parses):
        for end, cost, rank in parse.ends():
            yield key | {"kind": "way", "first_top": top, "last_top": end, "cost": cost, "rank": rank,
                         "letters": parse.letters(end)}


def _batches_of(rows: Iterable[dict], schema: pa.Schema, at_most: int = 2_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("text") or "") + len(row.get("letters") or "")
        if len(held) >= at_most or size > 1 << 22:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 1_000):
            yield from batch.slice(begin, 1_000).to_pylist()


def _read_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One piece: its conversations in order. The first and the last are parts; only the rows of
    one conversation that is neither are held."""

    def made() -> Iterator[dict]:
        held: tuple[str, int, list[dict]] | None = None
        for i, (conv, rows) in enumerate(groupby(_rows_of(batches), key=lambda r: r["conv"])):
            if held:
                yield _whole(held[0], held[2])
                held = None
            rows = iter(rows)
            first = next(rows)
            if i == 0:
                yield from _part(conv, first["piece"], _chain(first, rows))
            else:
                held = conv, first["piece"], [first, *rows]
        if held:
            yield from _part(*held)

    yield from _batches_of(made(), _SCHEMA)


def _chain(first: dict, rows: Iterator[dict]) -> Iterator[dict]:
    yield first
    yield from rows


_ROUTE = "conv string, piece int, first_top int, last_top int, tail string, cost long"


def _route(tables: pa.Table) -> pa.Table:
    """Through the pieces of one conversation: which top each begins and ends with.

    The pieces' letters stay where they are: ranks within a piece order them, and pieces compare
    like rows do."""
    by_piece: dict[int, list[dict]] = {}
    for row in tables.to_pylist():
        by_piece.setdefault(row["piece"], []).append(row)
    live, links = {EMPTY: (0, 0)}, []
    for piece in sorted(by_piece):
        found: dict[int, tuple] = {}
        for way in by_piece[piece]:
            if way["first_top"] in live:
                cost, rank = live[way["first_top"]]
                offer = (cost + way["cost"], rank, way["letters_rank"], way["first_top"])
                found[way["last_top"]] = min(offer, found.get(way["last_top"], offer))
        order = sorted({offer[1:3] for offer in found.values()})
        live = {top: (offer[0], order.index(offer[1:3])) for top, offer in found.items()}
        links.append((piece, {top: offer[3] for top, offer in found.items()}))
    top, cost, tail = accepted((t, c, r) for t, (c, r) in live.items())
    conv, route = tables["conv"][0].as_py(), []
    for piece, before in reversed(links):
        route.append({"conv": conv, "piece": piece, "first_top": before[top], "last_top": top,
                      "tail": "" if route else tail, "cost": cost})
        top = before[top]
    schema = pa.schema([("conv", pa.string()), ("piece", pa.int32()), ("first_top", pa.int32()),
                        ("last_top", pa.int32()), ("tail", pa.string()), ("cost", pa.int64())])
    return pa.Table.from_pylist(route, schema)


_BLOCKS = pa.schema([("conv", pa.string()), ("piece", pa.int32()), ("at", pa.int64()), ("text", pa.string())])


def _repair_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of parts in order, each part led by its letters: the repaired lines, some at a time."""

    def made() -> Iterator[dict]:
        for (conv, piece), rows in groupby(_rows_of(batches), key=lambda r: (r["conv"], r["piece"])):
            way = next(rows)
            lines, size, at = [], 0, 0
            given = ((r["role"], r["text"], r["copies"]) for r in rows)
            for role, text in repaired(given, way["letters"], way["first_top"]):
                lines.append(f"{role}:{text}")
                size += len(lines[-1])
                if size > 1 << 18:
                    yield {"conv": conv, "piece": piece, "at": at, "text": "\n".join(lines)}
                    lines, size, at = [], 0, at + 1
            if lines:
                yield {"conv": conv, "piece": piece, "at": at, "text": "\n".join(lines)}

    yield from _batches_of(made(), _BLOCKS, 16)


_DIGESTS = pa.schema([("conv", pa.string()), ("digest", pa.string())])


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the blocks of each conversation, which come in order. Nothing is held."""

    def made() -> Iterator[dict]:
        for conv, blocks in groupby(_rows_of(batches), key=lambda r: r["conv"]):
            digest = hashlib.sha256(next(blocks)["text"].encode())
            for block in blocks:
                digest.update(b"\n" + block["text"].encode())
            yield {"conv": conv, "digest": digest.hexdigest()}

    yield from _batches_of(made(), _DIGESTS)


_RESULT = ["conv", *_COUNTS, "first_turn", "last_turn", "cost", "letters", "digest"]


def _joined_parts(pieces: DataFrame) -> DataFrame:
    """The conversations that lie in several pieces, or may, put together."""
    spark = pieces.sparkSession
    ways = pieces.where("kind = 'way'").select("conv", "piece", "first_top", "last_top", "cost", "rank", "letters")
    # Ways of one piece are ranked by their letters; at most 16 a piece.
    tables = ways.groupBy("conv", "piece").agg(
        F.array_sort(F.collect_set("letters")).alias("order"),
        F.collect_list(F.struct("first_top", "last_top", "cost", "letters")).alias("ways"),
    )
    way = F.explode(
        F.transform(
            "ways",
            lambda w: F.struct(
                w["first_top"].alias("first_top"),
                w["last_top"].alias("last_top"),
                w["cost"].alias("cost"),
                F.array_position("order", w["letters"]).alias("letters_rank"),
            ),
        )
    )
    send_package(spark)
    ranked = tables.select("conv", "piece", way.alias("way")).select("conv", "piece", "way.*")
    route = stored(ranked.groupBy("conv").applyInArrow(_route, _ROUTE), "route")
    taken = route.withColumnRenamed("cost", "total").join(ways, ["conv", "piece", "first_top", "last_top"])
    taken = stored(
        taken.select(
            "conv", "piece", "first_top", "total", F.concat("letters", "tail").alias("letters")
        ),
        "ways",
    )
    # The rows of a part after its letters, then the lines of a conversation in order.
    rows = pieces.where("kind = 'row'").select(
        "conv", "piece", "at", "role", "text", "copies",
        F.lit(None).cast("string").alias("letters"), F.lit(None).cast("int").alias("first_top"),
    )
    none = F.lit(None)
    leads = taken.select(
        "conv", "piece", F.lit(-1).cast("long").alias("at"), none.cast("string").alias("role"),
        none.cast("string").alias("text"), none.cast("long").alias("copies"), "letters", "first_top",
    )
    in_parts = rows.union(leads).repartition("conv", "piece").sortWithinPartitions("conv", "piece", "at")
    lines = map_batches(in_parts, _repair_pieces, "conv string, piece int, at long, text string")
    in_line = lines.repartition("conv").sortWithinPartitions("conv", "piece", "at")
    digests = map_batches(in_line, _hash_blocks, "conv string, digest string")
    letters = taken.groupBy("conv").agg(
        F.max("total").alias("cost"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("piece", "letters"))), lambda x: x["letters"]
            ),
            "",
        ).alias("letters"),
    )
    # Between two pieces: one more pair of neighbours, and perhaps one turn counted twice.
    parts = pieces.where("kind = 'piece'").groupBy("conv").agg(
        *(F.sum(c).alias(c) for c in _COUNTS),
        F.min("first_turn").alias("first_turn"),
        F.max("last_turn").alias("last_turn"),
        F.array_sort(
            F.collect_list(F.struct("piece", "first_initial", "last_initial", "first_turn", "last_turn"))
        ).alias("edges"),
    )
    edges = F.col("edges")
    pairs = F.transform(
        F.slice(edges, 2, F.greatest(F.size(edges) - 1, F.lit(0))),
        lambda right, i: F.struct(
            F.concat(edges[i]["last_initial"], right["first_initial"]).alias("pair"),
            (edges[i]["last_turn"] == right["first_turn"]).alias("same_turn"),
        ),
    )
    parts = parts.withColumn("pairs", pairs)
    parts = parts.withColumn(
        "illegal", F.col("illegal") + F.size(F.filter("pairs", lambda p: ~p["pair"].isin(*sorted(_LEGAL))))
    ).withColumn("turns", F.col("turns") - F.size(F.filter("pairs", lambda p: p["same_turn"])))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        parts.join(letters, "conv")
        .join(digests, "conv", "left")
        .withColumn("digest", F.coalesce("digest", empty))
        .select(*_RESULT)
    )


def repairs(conversations: DataFrame) -> DataFrame:
    """Every ``conv_id`` with the faults of its damaged rows and its cheapest repair: ``gaps``,
    ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    Rows are taken by turn, NULL first; rows of one turn by role, then text; so equal rows lie side
    by side and the order of the rows given does not matter. NULL is a conversation of its own; a
    NULL role or text is one space. A role that is empty or has another initial than s, u and a
    cannot be kept. A conversation without rows after damage has zeros, an empty audit and the
    digest of the empty string. A table without rows gives no rows. Other columns are not read.
    """
    rows = with_faults(damaged(conversations))
    pieces = rows.repartitionByRange(*_in_order()).sortWithinPartitions(*_in_order())
    pieces = map_batches(pieces.withColumn("piece", F.spark_partition_id()), _read_piece, _PIECES)
    pieces = stored(pieces, "pieces")
    found = pieces.where("kind = 'whole'").select(*_RESULT).union(_joined_parts(pieces))
    every = conversations.select("conv_id", conversation()).distinct()
    zero = F.lit(0).cast("long")
    span = F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")
    return every.join(found, "conv", "left").select(
        "conv_id",
        F.coalesce(span, zero).alias("gaps"),
        *(F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("letters", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
