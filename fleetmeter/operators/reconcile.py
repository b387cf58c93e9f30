"""Which rows of two tables differ, found by a tree of checksums.

A row's checksum is a hash of its key and values; checksums of rows add up, so those of an hour are
the sum of its sites' and those of a day the sum of its hours'. Both tables keep the sums of their
leaves, which a batch can add to and take from. A comparison goes down from the days only where two
sums differ, and reads rows of those days and hours alone: the work grows with the differences, not
with the tables. Rows that differ are then compared exactly, key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.operators.join_back import computed_and_counted
from fleetmeter.operators.upsert import same_key

HOUR, SITE, DAY = "analysis_hour", "site_id", "day"
_LEVELS = ([DAY], [DAY, HOUR], [DAY, HOUR, SITE])
# Days that a read of the rows names.
NAMED_DAYS = 400


def checksums(table: DataFrame, values: Sequence[str]) -> DataFrame:
    """The leaves of a table's tree: per day, hour and site the number of rows and the sum of
    their checksums. Sums of batches add up to those of the table; NULL is an hour like any other."""
    day = F.col(HOUR).cast("date").alias(DAY)
    # A hash skips NULL values, so which of them are NULL is hashed too.
    null_mask = F.concat(*(F.when(F.col(c).isNull(), "n").otherwise("v") for c in values))
    row = F.xxhash64(HOUR, SITE, null_mask, *values).cast("decimal(38,0)")
    return table.groupBy(day, HOUR, SITE).agg(F.count("*").alias("n"), F.sum(row).alias("sum"))


def added(leaves: DataFrame, more: DataFrame, sign: int = 1) -> DataFrame:
    """Leaves after the rows of ``more`` were added, or removed (``sign`` -1)."""
    signed = more.withColumns({c: F.col(c) * sign for c in ("n", "sum")})
    both = leaves.unionByName(signed).groupBy(DAY, HOUR, SITE)
    return both.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).filter("n <> 0")


def differing_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """Days, hours and sites whose sums differ: the levels are compared from the top, each only
    below what differed above."""
    found = None
    for level in _LEVELS:
        sides = []
        for side in (left, right):
            if found is not None:
                same = same_key("t", "f", found.columns, null_safe=True)
                side = side.alias("t").join(found.alias("f"), same, "left_semi")
            sides.append(side.groupBy(*level).agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")))
        signed = sides[0].unionByName(sides[1].withColumns({c: -F.col(c) for c in ("n", "sum")}))
        net = signed.groupBy(*level).agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
        found, _ = computed_and_counted(net.filter("n <> 0 OR sum <> 0").select(*level))
    return found


def _rows_of(table: DataFrame, leaves: DataFrame) -> DataFrame:
    """The rows of some leaves; few days are named in the scan, which then skips other files."""
    days = leaves.select(DAY).distinct().limit(NAMED_DAYS + 1).collect()
    named = [row[DAY] for row in days if row[DAY] is not None]
    if len(days) <= NAMED_DAYS:
        # A range of hours for each day, on the stored column itself.
        wanted: Column = F.lit(False)
        if any(row[DAY] is None for row in days):
            wanted = F.col(HOUR).isNull()
        if named:
            first = F.lit(min(named)).cast("timestamp_ntz")
            end = F.date_add(F.lit(max(named)), 1).cast("timestamp_ntz")
            wanted = wanted | ((F.col(HOUR) >= first) & (F.col(HOUR) < end))
        table = table.filter(wanted)
    same = same_key("t", "f", [HOUR, SITE], null_safe=True)
    return table.alias("t").join(leaves.drop(DAY).alias("f"), same, "left_semi")


def differences(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    left_leaves: DataFrame,
    right_leaves: DataFrame,
) -> DataFrame:
    """Hour and site of all rows that differ, and ``side``: where the row is, ``left`` or ``right``
    only, or in ``both`` with other values. Each table has a key once. Two different leaves have
    equal sums by chance in one of some 10^19 cases."""
    leaves = differing_leaves(left_leaves, right_leaves)
    here = F.lit(True).alias("here")
    sides = [
        _rows_of(t, leaves).select(HOUR, SITE, F.struct(*values).alias("row"), here).alias(name)
        for t, name in ((left, "l"), (right, "r"))
    ]
    both = sides[0].join(sides[1], same_key("l", "r", [HOUR, SITE], null_safe=True), "full")
    side = (
        F.when(F.col("r.here").isNull(), "left")
        .when(F.col("l.here").isNull(), "right")
        .when(~F.col("l.row").eqNullSafe(F.col("r.row")), "both")
    )
    keys = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in (HOUR, SITE)]
    return both.select(*keys, side.alias("side")).filter(F.col("side").isNotNull())
