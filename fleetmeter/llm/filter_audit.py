"""How filters act on a corpus in every order, by coalition counts and their potential.

A document is the set of filters it fails. Counted by part and set, that is all the audit needs:
a coalition of filters removes the documents that fail at least one of them, whatever the order.
A step of an order removes the difference of two coalitions, and a filter's Shapley value is the
Hart-Mas-Colell potential of all filters minus the potential without it. The potential of a
coalition S is (v(S) + the sum of the potentials of S without one member) / |S|. Only built-in
functions; no order is ever applied to a document.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
_WORD = r"[^\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Every potential of at most five players is a whole multiple of 1/60 of the counts.
_SCALE = 60


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The conditions of one text, by filter. Filter E compares texts and is not among them."""
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _mask(fails: dict[str, Column]) -> Column:
    bits = [F.when(c, 1 << FILTERS.index(f)).otherwise(0) for f, c in fails.items()]
    return sum(bits[1:], bits[0])


def _documents(documents: DataFrame) -> DataFrame:
    """One row per text, id, part and set of failed filters among A to D, with its copies ``n``."""
    rows = documents.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("words", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    rows = rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        _mask(failures(F.col("text"), F.col("words"))).alias("mask"),
    )
    return rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n"))


def cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``documents`` by ``part`` and ``mask`` of failed filters (bit 0 is A): all of them
    ``n``, those with a label of quality 1 ``good``, of toxic 1 ``toxic``.

    A row repeats a text if the same text has a smaller id anywhere in the table. A null text is
    empty, a null ``lang`` the part of the empty string. A row without id repeats nothing, is
    repeated by nothing and has no label; rows of one id and text do not repeat each other. Of
    several labels of a document any 1 counts.
    """
    rows = _documents(documents)
    first = (
        rows.where("doc_id IS NOT NULL")
        .groupBy(F.col("digest").alias("of_text"))
        .agg(F.min("doc_id").alias("first_id"))
    )
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    # Text and id together, so that the copies of one text do not meet in one task.
    is_first = (F.col("digest") == F.col("of_text")) & (F.col("doc_id") == F.col("first_id"))
    repeats = F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    marked = rows.join(first, is_first, "left").join(known, F.col("doc_id") == F.col("labelled"), "left")
    return (
        marked.withColumn("mask", F.col("mask") + F.when(repeats, 1 << FILTERS.index("E")).otherwise(0))
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )


def _coalitions(count: str) -> Column:
    """What each set of filters removes: an array by the number of the set."""
    sets = range(1 << len(FILTERS))
    fails = F.col("mask").bitwiseAND
    return F.array(*(F.sum(F.when(fails(s) != 0, F.col(count)).otherwise(0)) for s in sets))


def potentials(removed: Column) -> Column:
    """The potential of each coalition times 60, in whole numbers. Every set comes after its
    subsets, so the array grows by one entry from the entries before it."""

    def append(known: Column, s: Column) -> Column:
        below = [
            F.when(s.bitwiseAND(1 << i) != 0, F.get(known, s - (1 << i))).otherwise(0)
            for i in range(len(FILTERS))
        ]
        total = _SCALE * F.get(removed, s) + sum(below[1:], below[0])
        return F.array_append(known, F.call_function("div", total, F.bit_count(s).cast("long")))

    sets = F.sequence(F.lit(1), F.lit((1 << len(FILTERS)) - 1))
    return F.aggregate(sets, F.array(F.lit(0).cast("long")), append)


def audited(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per ``part``, ``filter_order`` (all 120) and ``step``: documents of the part kept after the
    step, removed by it, failing its filter but removed before (``redundant``), failing its filter
    only (``unique_fails``), good and toxic ones removed (``good_lost``, ``toxic_lost``), and
    ``shapley``, what its filter removes in all orders together.

    Nulls and repeats are as in ``cells``. A table without rows has no parts and gives no rows.
    Other columns are not read.
    """
    everything = (1 << len(FILTERS)) - 1
    parts = cells(documents, labels).groupBy("part").agg(
        F.sum("n").alias("total"),
        *(_coalitions(c).alias(f"v_{c}") for c in ("n", "good", "toxic")),
    )
    parts = parts.withColumn("potential", potentials(F.col("v_n")))
    orders = F.array(*(F.lit("".join(o)) for o in permutations(FILTERS)))
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )
    places = {1 << i: F.locate(f, F.col("filter_order")) for i, f in enumerate(FILTERS)}

    def filters_at(holds: Callable[[Column], Column]) -> Column:
        bits = [F.when(holds(place), bit).otherwise(0) for bit, place in places.items()]
        return sum(bits[1:], bits[0])

    steps = steps.withColumn("before", filters_at(lambda place: place < F.col("step")))
    steps = steps.withColumn("bit", filters_at(lambda place: place == F.col("step")))

    def value(of: str, s: Column) -> Column:
        return F.get(F.col(of), s)

    after, others = F.col("before") + F.col("bit"), F.lit(everything) - F.col("bit")

    def lost(of: str) -> Column:
        return value(of, after) - value(of, F.col("before"))

    share = value("potential", F.lit(everything)) - value("potential", others)
    return steps.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        (F.col("total") - value("v_n", after)).alias("kept"),
        lost("v_n").alias("removed"),
        (value("v_n", F.col("bit")) - lost("v_n")).alias("redundant"),
        (value("v_n", F.lit(everything)) - value("v_n", others)).alias("unique_fails"),
        lost("v_good").alias("good_lost"),
        lost("v_toxic").alias("toxic_lost"),
        (share * (factorial(len(FILTERS)) // _SCALE)).alias("shapley"),
    )
