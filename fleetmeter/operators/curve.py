"""A table stored along a space-filling curve, so that a filter on any of its keys skips files.

A sort by (site, hour, device) lets a filter on the first key skip files, and one on the last key
none. Here each key is turned into its rank among quantiles, the bits of the ranks are interleaved,
and files are cut by ranges of that number: each file covers a small box of all keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
# Rows that the quantiles are taken from, about. They only shape the files.
SAMPLE_ROWS = 16_384


def quantile_bounds(table: DataFrame, keys: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """For each key ``2 ** bits - 1`` values, in order, that part its rows evenly.

    They come from a sample of about ``SAMPLE_ROWS`` rows, so keys of any type that has an order
    will do. A value that holds many rows is named as often as parts begin with it, so that a key
    of few values has ranks that differ in their high bits. NULL is no bound; a key of which the
    sample has no value has none. Runs at once.
    """
    rows = max(table.count(), 1)
    chosen = table.sample(min(1.0, SAMPLE_ROWS / rows), seed=7) if rows > SAMPLE_ROWS else table
    parts = 2**bits
    ordered = chosen.select(*keys).agg(*[F.array_sort(F.collect_list(k)).alias(k) for k in keys])
    cuts = F.sequence(F.lit(1), F.lit(parts - 1))

    def at_cuts(values: Column) -> Column:
        place = F.transform(cuts, lambda i: F.floor(i * F.size(values) / parts).cast("int"))
        picked = F.transform(place, lambda p: F.get(values, p))
        return F.when(F.size(values) > 0, picked).otherwise(F.slice(values, 1, 0))

    row = ordered.select(*[at_cuts(F.col(k)).alias(k) for k in keys]).first()
    return {k: list(row[k]) for k in keys}


def rank(table: DataFrame, key: str, bounds: Sequence) -> Column:
    """The number of bounds below the key's value; a NULL key comes first, at 0."""
    if not bounds:
        return F.lit(0)
    kind = table.schema[key].dataType
    # Times are given as texts, which no session zone shifts.
    listed = F.array(*[F.lit(str(b) if isinstance(b, date) else b).cast(kind) for b in bounds])
    below = F.size(F.filter(listed, lambda b: b < F.col(key)))
    return F.when(F.col(key).isNull(), 0).otherwise(below)


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The Z-order number of some ranks below ``2 ** bits``: the highest bits of all come first."""
    number = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for value in ranks:
            one = F.shiftright(value, bit).bitwiseAND(F.lit(1)).cast("long")
            number = number * 2 + one
    return number


def write_curve_layout(
    table: DataFrame, path: str, keys: Sequence[str], files: int | None = None, bits: int = BITS
) -> None:
    """Store a table in files that each cover one range of the curve, rows within sorted by it.

    ``files`` fixes their number; without it, adaptive execution sizes them. A cell of the curve
    with many rows is cut on by the keys themselves, and rows of equal keys by a checksum of the
    row. The ranks go to 63 bits together. Takes the bounds first, with two jobs over ``keys``.
    """
    if bits * len(keys) > 63:
        raise ValueError("bits times keys must not pass 63")
    bounds = quantile_bounds(table, keys, bits)
    number = interleaved([rank(table, k, bounds[k]) for k in keys], bits)
    order = ["_curve", *keys, "_row"]
    placed = table.withColumns({"_curve": number, "_row": F.xxhash64(*map(F.col, table.columns))})
    ranged = placed.repartitionByRange(*([files] if files else []), *order)
    ranged.sortWithinPartitions(*order).drop("_curve", "_row").write.mode("overwrite").parquet(path)


def file_bounds(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(file, low_<key>, high_<key>, ...)``: what the statistics of each file of a stored table
    tell a filter. ``table`` has its column ``file`` from ``layout.with_file``."""
    ends = [f(k).alias(f"{name}_{k}") for k in keys for name, f in (("low", F.min), ("high", F.max))]
    return table.groupBy("file").agg(*ends)


def share_of_files(bounds: DataFrame, key: str, low, high) -> DataFrame:
    """One row: ``files``, and the ``share`` of them that a filter of ``key`` between ``low`` and
    ``high`` has to open."""
    meets = (F.col(f"low_{key}") <= F.lit(high)) & (F.col(f"high_{key}") >= F.lit(low))
    return bounds.agg(
        F.count("*").alias("files"), (F.count_if(meets) / F.count("*")).alias("share")
    )
