"""What is new, and what changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.times import TimeLike, as_ntz
from fleetmeter.operators.history import BATCH_ID, LOADED_AT, is_live, row_identity, version_pairs
from fleetmeter.operators.upsert import same_key


def rows_since(table: DataFrame, last: TimeLike, column: str = "load_ts") -> DataFrame:
    """Rows appended after the last consumed load time."""
    return table.filter(F.col(column) > as_ntz(last))


def rows_between(
    table: DataFrame, after: TimeLike, until: TimeLike, column: str = "loaded_at"
) -> DataFrame:
    """Rows of an append-only table added after one time and up to another."""
    loaded = F.col(column)
    return table.filter((loaded > as_ntz(after)) & (loaded <= as_ntz(until)))


def rows_until(table: DataFrame, when: TimeLike, column: str = "loaded_at") -> DataFrame:
    """An append-only table as it was at a time."""
    return table.filter(F.col(column) <= as_ntz(when))


def has_new_data(table: DataFrame, last: TimeLike, column: str = "load_ts") -> DataFrame:
    """One row, ``has_data``: whether anything was appended after ``last``."""
    newer = F.max(F.col(column)) > as_ntz(last)
    return table.agg(F.coalesce(newer, F.lit(False)).alias("has_data"))


def stream_status(streams: dict[str, DataFrame]) -> DataFrame:
    """``(stream_name, has_data)`` of several change streams."""
    rows = [
        status.select(F.lit(name).alias("stream_name"), "has_data")
        for name, status in streams.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def changes_between(
    history: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    after: TimeLike,
    until: TimeLike,
    null_safe: bool = False,
) -> DataFrame:
    """Rows loaded after one time and up to another: their last values and the action.

    The action is INSERT for a row that did not exist at the first time, else UPDATE.
    """
    identity = row_identity(keys, null_safe)
    version, loaded = F.struct(LOADED_AT, BATCH_ID), F.col(LOADED_AT)
    in_interval = loaded > as_ntz(after)
    grouped = (
        history.filter(loaded <= as_ntz(until))
        .groupBy(*identity)
        .agg(
            F.max_by(F.struct(*values), F.when(in_interval, version)).alias("row"),
            F.min(loaded).alias("first"),
        )
        .filter(F.col("row").isNotNull())
    )
    action = F.when(F.col("first") > as_ntz(after), "INSERT").otherwise("UPDATE")
    return grouped.select(*keys, "row.*", action.alias("action"))


def net_changes(
    history: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    after: TimeLike,
    until: TimeLike,
    null_safe: bool = False,
) -> DataFrame:
    """What the log of versions between two times comes to, tombstones included: one row per key
    with its action, INSERT, UPDATE or DELETE, and the values it leaves (those of before for a
    delete). Inserted and deleted again is nothing; deleted and inserted again is an update.

    One aggregate over the log, combined before its shuffle; the two states are never built. The
    newest version of each key up to the first time says whether the row was there.
    """
    version, loaded = F.struct(LOADED_AT, BATCH_ID), F.col(LOADED_AT)
    until_now = history.filter(loaded <= as_ntz(until))
    state = F.struct(is_live(history).alias("live"), F.struct(*values).alias("row"))
    in_interval = loaded > as_ntz(after)
    grouped = until_now.groupBy(*row_identity(keys, null_safe)).agg(
        F.max_by(state, F.when(~in_interval, version)).alias("before"),
        F.max_by(state, F.when(in_interval, version)).alias("after"),
    )
    was = F.coalesce(F.col("before.live"), F.lit(False))
    action = (
        F.when(~was & F.col("after.live"), "INSERT")
        .when(was & F.col("after.live"), "UPDATE")
        .when(was & ~F.col("after.live"), "DELETE")
    )
    row = F.when(F.col("after.live"), F.col("after.row")).otherwise(F.col("before.row"))
    changed = grouped.select(*keys, row.alias("row"), action.alias("action"))
    return changed.filter(F.col("action").isNotNull()).select(*keys, "row.*", "action")


def changed_values(
    history: DataFrame, keys: Sequence[str], value: str, now: TimeLike, earlier: TimeLike
) -> DataFrame:
    """Keys whose value differs between two times; a NULL on either side is no change."""
    pairs = version_pairs(history, keys, [value], now, earlier, include_earlier=True)
    new, old = F.col(f"now.{value}"), F.col(f"earlier.{value}")
    return pairs.filter(new != old).select(*keys, new.alias("value_now"), old.alias("value_old"))


def version_delta(
    history: DataFrame, keys: Sequence[str], value: str, now: TimeLike, earlier: TimeLike
) -> DataFrame:
    """Value now, value just before an earlier time, and their difference, largest first."""
    pairs = version_pairs(history, keys, [value], now, earlier, include_earlier=False)
    new, old = F.col(f"now.{value}"), F.col(f"earlier.{value}")
    delta = pairs.select(
        *keys, new.alias("value_now"), old.alias("value_before"), (new - old).alias("delta")
    )
    return delta.orderBy(F.col("delta").desc_nulls_first())


def version_changes(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Insert, update and delete rows that lead from one version of a table to another.

    An update carries the new values, a delete the old ones. Unchanged rows are left out.
    """
    sides = [
        side.select(*keys, F.struct(*values).alias("row"), F.lit(True).alias("here")).alias(name)
        for side, name in ((old, "o"), (new, "n"))
    ]
    joined = sides[0].join(sides[1], same_key("o", "n", keys, null_safe), "full")
    action = (
        F.when(F.col("o.here").isNull(), "INSERT")
        .when(F.col("n.here").isNull(), "DELETE")
        .when(~F.col("o.row").eqNullSafe(F.col("n.row")), "UPDATE")
    )
    is_delete = F.col("n.here").isNull()
    key_columns = [
        F.when(is_delete, F.col(f"o.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in keys
    ]
    row = F.when(is_delete, F.col("o.row")).otherwise(F.col("n.row")).alias("row")
    changed = joined.select(*key_columns, row, action.alias("action"))
    return changed.filter(F.col("action").isNotNull()).select(*keys, "row.*", "action")


def refresh_stats(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row, ``(rows_added, rows_removed)``, of a refresh that replaced ``old`` by ``new``.

    A changed row counts on both sides. Both directions come from one aggregate over the
    two versions, with equal rows cancelling out.
    """
    signed = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))
    columns = [c for c in signed.columns if c != "_sign"]
    net = signed.groupBy(*columns).agg(F.sum("_sign").alias("net"))

    def total(part):
        return F.coalesce(F.sum(F.greatest(part, F.lit(0))), F.lit(0))

    return net.agg(
        total(F.col("net")).alias("rows_added"),
        total(-F.col("net")).alias("rows_removed"),
    )
