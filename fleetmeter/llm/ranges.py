"""Value ranges of about equal row counts, to order a large table piece by piece."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_RANGE = 2_000
# The driver holds this many bounds at most; beyond it the ranges grow with the table.
MAX_RANGES = 4_096


def range_bounds(
    df: DataFrame, column: str, rows_per_range: int = ROWS_PER_RANGE
) -> list[int]:
    """Ascending values of ``column`` that begin the ranges. Each occurs in the table."""
    wanted = min(MAX_RANGES, max(1, -(-df.count() // rows_per_range)))
    shares = [i / wanted for i in range(wanted)]
    found = df.agg(F.percentile_approx(column, shares, 20 * wanted).alias("v")).first()["v"]
    return sorted(set(found or []))


def range_number(value: Column, bounds: list[int]) -> Column:
    """How many of the bounds are not above ``value``, by binary search; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    n, steps = len(bounds), []
    while not steps or steps[-1] * 2 <= n:
        steps.append(steps[-1] * 2 if steps else 1)
    values = F.lit(bounds)
    return F.aggregate(
        F.lit(steps[::-1]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= n) & (F.get(values, at + step - 1) <= value), at + step
        ).otherwise(at),
    )
