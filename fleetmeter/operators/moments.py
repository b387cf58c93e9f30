"""Mean and deviation of all history from stored moments, merged and withdrawn batch by batch.

The moments of a set of values are their number, their mean and the sum of squared distances from
it. Two sets are put together by the pairwise formula, which holds on values far from zero, where
sums of squares would cancel; a set that is replaced is taken out by the same formula backwards. So
a new batch is scored against everything before it, and no earlier row is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.operators.join_back import BROADCAST_ROWS, join_groups
from fleetmeter.operators.upsert import same_key

MOMENTS = ["n", "mean", "m2"]


def moments(rows: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """``n``, ``mean`` and ``m2`` of a column per group, NULL values left out. A group without
    values has n 0 and a NULL mean."""
    n = F.count(value)
    m2 = F.coalesce(F.var_pop(value) * n, F.lit(0.0))
    return rows.groupBy(*by).agg(n.alias("n"), F.avg(value).alias("mean"), m2.alias("m2"))


def _sides(a: DataFrame, b: DataFrame, by: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Both tables by group, NULL a group like any other; what is missing has no values."""
    joined = a.alias("a").join(b.alias("b"), same_key("a", "b", by, null_safe=True), "full")
    found = {
        f"{side}{name}": F.coalesce(F.col(f"{side}.{name}"), F.lit(0))
        for side in "ab" for name in MOMENTS
    }
    return joined, found


def added(total: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """The moments of two sets together. Both tables have one row per group."""
    joined, x = _sides(total, new, by)
    n, apart = x["an"] + x["bn"], x["bmean"] - x["amean"]
    both = (x["an"] > 0) & (x["bn"] > 0)
    mean = (
        F.when(both, x["amean"] + apart * x["bn"] / n)
        .when(x["an"] > 0, x["amean"])
        .when(x["bn"] > 0, x["bmean"])
    )
    between = F.when(both, apart * apart * (x["an"] * x["bn"] / n)).otherwise(0.0)
    return _rows(joined, by, n, mean, x["am2"] + x["bm2"] + between)


def withdrawn(total: DataFrame, old: DataFrame, by: Sequence[str]) -> DataFrame:
    """The moments of a set without a part of it. Groups of which nothing is left have n 0."""
    joined, x = _sides(total, old, by)
    n = x["an"] - x["bn"]
    left = n > 0
    mean = F.when(left & (x["bn"] > 0), x["amean"] + (x["amean"] - x["bmean"]) * x["bn"] / n).when(left, x["amean"])
    apart = x["bmean"] - mean
    between = F.when(left & (x["bn"] > 0), apart * apart * (n * x["bn"] / x["an"])).otherwise(0.0)
    m2 = F.when(n > 1, F.greatest(x["am2"] - x["bm2"] - between, F.lit(0.0))).otherwise(0.0)
    return _rows(joined, by, n, mean, m2)


def _rows(joined: DataFrame, by: Sequence[str], n: Column, mean: Column, m2: Column) -> DataFrame:
    # A NULL key is NULL on both sides, and coalesce keeps it so.
    keys = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in by]
    return joined.select(*keys, n.alias("n"), mean.alias("mean"), m2.alias("m2"))


def scored(
    silver: DataFrame, total: DataFrame, threshold: float = 2, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``anomaly.zscore_anomalies`` of the given rows against the moments ``total`` per site."""
    deviation = F.when(F.col("n") > 1, F.nullif(F.sqrt(F.col("m2") / (F.col("n") - 1)), F.lit(0.0)))
    stats = total.select("site_id", F.col("mean").alias("_mean"), deviation.alias("_deviation"))
    rows = silver.select("device_id", "site_id", "hour_bucket", "avg_temperature")
    joined = join_groups(rows, stats, "site_id", ["device_id", "hour_bucket"], broadcast_rows)
    score = F.try_divide(F.col("avg_temperature") - F.col("_mean"), F.col("_deviation"))
    return joined.select(
        "device_id",
        "site_id",
        "hour_bucket",
        "avg_temperature",
        score.alias("z_score"),
        (F.abs(score) > threshold).alias("is_anomaly"),
    )
