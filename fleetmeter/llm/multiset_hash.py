"""Document fingerprints that add up: a homomorphic hash of the multiset of paragraphs.

Each paragraph is hashed to a wide vector, and a text's fingerprint is the sum of its
paragraphs' vectors, every entry modulo a power of two. So the order of paragraphs is of no
account, and adding or taking away a paragraph adds or subtracts its vector.

The vector of a paragraph has ``1``, four 32-bit parts of its hashes (added modulo 2^32, for
equality) and the 128 single bits of its hashes (each added modulo 2^30, two to a long). A bit
counts as +1 or -1 in the likeness: two sums agree as far as they share paragraphs, since the
bits of different paragraphs cancel out. The signed sums are exact below 2^30 paragraphs, more
than a text of Spark can hold. Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmeter.llm.ranges import range_bounds, range_number

# A paragraph ends at a line break or, as many texts have long lines, with a sentence.
PARAGRAPH_END = r"\s*\n\s*|(?<=[.!?])\s+"
_SUM_MASK = 0xFFFFFFFF
_BIT_MASK = 0x0000000100000001
# Two entries, or one and the complement of another, add up without carry or overflow.
_MODULUS = 1 << 30
_BITS_MASK = 0x3FFFFFFF3FFFFFFF
WIDE = 5  # longs of count and 32-bit sums, before the packed bits
BIT_LONGS = 64


def paragraphs(text: Column, end: str = PARAGRAPH_END) -> Column:
    """The trimmed, non-empty paragraphs; none for a null text."""
    parts = F.split(F.coalesce(text, F.lit("")), end)
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def fingerprint(parts: Column) -> Column:
    """The fingerprint of an array of paragraphs: an array of 69 longs."""

    def of(hashes: Column) -> Column:
        def total(name: str, shift: int, entry: int, sums: int) -> Column:
            def add(s: Column, h: Column) -> Column:
                part = F.shiftrightunsigned(h[name], shift).bitwiseAND(F.lit(entry))
                return (s + part).bitwiseAND(F.lit(sums))

            return F.aggregate(hashes, F.lit(0).cast("long"), add)

        wide = [total(n, k, _SUM_MASK, _SUM_MASK) for n in "ab" for k in (0, 32)]
        bits = [total(n, k, _BIT_MASK, _BITS_MASK) for n in "ab" for k in range(32)]
        return F.array(F.size(hashes).cast("long"), *wide, *bits)

    def hashed(part: Column) -> Column:
        return F.struct(F.xxhash64(part).alias("a"), F.xxhash64(part, F.lit(1)).alias("b"))

    return _once(F.transform(parts, hashed), of)


def _combined(a: Column, b: Column, minus: bool) -> Column:
    count = F.get(a, 0) - F.get(b, 0) if minus else F.get(a, 0) + F.get(b, 0)
    wide = F.zip_with(
        F.slice(a, 2, WIDE - 1),
        F.slice(b, 2, WIDE - 1),
        lambda x, y: (x - y if minus else x + y).bitwiseAND(F.lit(_SUM_MASK)),
    )
    # x - y in each packed entry is x + (mask - y) + 1: nothing is borrowed between entries.
    bits = F.zip_with(
        F.slice(a, WIDE + 1, BIT_LONGS),
        F.slice(b, WIDE + 1, BIT_LONGS),
        lambda x, y: (
            x + (F.lit(_BITS_MASK) - y) + F.lit(_BIT_MASK) if minus else x + y
        ).bitwiseAND(F.lit(_BITS_MASK)),
    )
    return F.concat(F.array(count), wide, bits)


def inserted(vector: Column, more: Column) -> Column:
    """The fingerprint of both multisets together."""
    return _combined(vector, more, minus=False)


def deleted(vector: Column, part: Column) -> Column:
    """The fingerprint of the paragraphs left when those of ``part`` are taken away."""
    return _combined(vector, part, minus=True)


def _signed_bits(vector: Column) -> Column:
    """The 128 sums of +1 and -1."""
    count = F.get(vector, 0)

    def entries(x: Column) -> Column:
        return F.array(
            *(
                (F.shiftrightunsigned(x, 32 * i).bitwiseAND(F.lit(_MODULUS - 1)) * 2 - count + _MODULUS)
                .bitwiseAND(F.lit(2 * _MODULUS - 1))
                - _MODULUS
                for i in range(2)
            )
        )

    return F.flatten(F.transform(F.slice(vector, WIDE + 1, BIT_LONGS), entries))


def _product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: (x * y).cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """How much two fingerprints share, 0 to 1: 1 if they are equal, else the cosine of their
    signed sums, about the shared paragraphs over the geometric mean of both counts."""

    def cosine(v: Column) -> Column:
        return _once(
            F.struct(
                _product(v["x"], v["y"]).alias("xy"),
                F.sqrt(_product(v["x"], v["x"]) * _product(v["y"], v["y"])).alias("scale"),
            ),
            lambda p: F.when(p["scale"] > 0, p["xy"] / p["scale"]).otherwise(F.lit(0.0)),
        )

    both = F.struct(_signed_bits(a).alias("x"), _signed_bits(b).alias("y"))
    unequal = F.greatest(F.lit(0.0), F.least(F.lit(1.0), _once(both, cosine)))
    return F.when(a == b, F.lit(1.0)).otherwise(unequal)


def hex_of(vector: Column) -> Column:
    """The fingerprint as a string of 16 hexadecimal digits a long."""
    return F.lower(F.concat_ws("", F.transform(vector, lambda x: F.lpad(F.hex(x), 16, "0"))))


def with_next(
    documents: DataFrame, carried: list[str], id_column: str = "doc_id", tie: str = "text"
) -> DataFrame:
    """``documents`` with ``next_<c>`` for each carried column: its value in the next row by
    ascending id, after the last row the first one's. Rows without id come first; rows of equal
    ids are ordered by the hash of ``tie``.

    Rows are dealt out by ranges of ids. The row that begins a range also goes, as a guest, to
    the range before, whose last row precedes it; so each range is ordered by itself. A range
    begins at an id that occurs.
    """
    bounds = range_bounds(documents.select(id_column), id_column)
    without_id = not documents.select(id_column).where(F.col(id_column).isNull()).isEmpty()
    key, last = F.col(id_column), len(bounds)
    homes = range_number(key, bounds)
    begins = F.lit(False)
    if bounds:
        begins = F.coalesce(F.array_contains(F.lit(bounds), key), F.lit(False))
    # With a bound at the least id, the range before it holds the rows without id, or nothing.
    first = key.isNull() if without_id or not bounds else key == documents.agg(F.min(key)).first()[0]
    places = F.array_compact(
        F.array(
            F.struct(homes.alias("range"), F.lit(False).alias("guest")),
            F.when(begins, F.struct((homes - 1).alias("range"), F.lit(True).alias("guest"))),
            F.when(first, F.struct(F.lit(last).alias("range"), F.lit(True).alias("guest"))),
        )
    )
    dealt = documents.withColumn("_place", F.explode(places))
    order = W.partitionBy("_place.range").orderBy(
        F.col("_place.guest"), key.asc_nulls_first(), F.xxhash64(tie)
    )
    following = F.lead(F.struct(*carried)).over(order)
    dealt = dealt.withColumn("_next", following).where(~F.col("_place.guest"))
    named = {f"next_{c}": F.col(f"_next.{c}") for c in carried}
    return dealt.withColumns(named).drop("_place", "_next")


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the text's code points (rounded down) replaced by as many first ones of
    the following text, or all if it is shorter."""
    half = F.floor(F.length(text) / 2).cast("int")
    kept = (F.length(text) - half).cast("int")
    return F.concat(F.substr(text, F.lit(1), kept), F.substr(following, F.lit(1), half))


def fingerprinted(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``documents``: id and text under their names (a null text is empty),
    ``vector``, the following row's ``next_text`` and ``next_vector``, ``edited`` and
    ``edited_vector``. A single row follows itself. Other columns are not read."""
    rows = documents.select(
        F.col(id_column), F.coalesce(F.col(text), F.lit("")).alias(text)
    )
    rows = rows.withColumn("vector", fingerprint(paragraphs(F.col(text))))
    rows = with_next(rows, [text, "vector"], id_column, text)
    rows = rows.withColumn("edited", edited_text(F.col(text), F.col(f"next_{text}")))
    return rows.withColumn("edited_vector", fingerprint(paragraphs(F.col("edited"))))
