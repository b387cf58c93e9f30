"""Point-in-time reads over an append-only history.

A history holds every version of every row: the key and value columns, ``loaded_at`` and
``batch_id``. Versions are ordered by ``(loaded_at, batch_id)`` and a batch has a key at
most once. The newest version per key is the table.

A history with a column ``is_deleted`` holds deletes as versions of their own, tombstones: a key
whose newest version is one has no row then. All reads here leave such keys out, retention forgets
what was deleted before its cutoff, and a later version brings a key back. Without the column rows
are replaced, never deleted, and plans are as they were.

A plain upsert never matches a row whose key holds a NULL; it stays as one row per batch.
The functions here keep it that way unless ``null_safe`` is set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.functions.times import TimeLike, as_ntz, before_by
from fleetmeter.operators.upsert import has_full_key

LOADED_AT = "loaded_at"
BATCH_ID = "batch_id"
IS_DELETED = "is_deleted"


def row_identity(keys: Sequence[str], null_safe: bool = False) -> list[Column]:
    """Columns that tell one table row from another over all its versions."""
    columns = [F.col(key) for key in keys]
    if null_safe:
        return columns
    has_null = reduce(or_, [F.col(key).isNull() for key in keys])
    return [*columns, F.when(has_null, F.col(BATCH_ID)).alias("_null_key_batch")]


def is_live(history: DataFrame) -> Column:
    """Whether a version is a row, not a tombstone. A NULL mark is none."""
    if IS_DELETED not in history.columns:
        return F.lit(True)
    return ~F.coalesce(F.col(IS_DELETED), F.lit(False))


def tombstones(
    rows: DataFrame, history: DataFrame, keys: Sequence[str], loaded_at: TimeLike, batch_id: int
) -> DataFrame:
    """Versions that delete the keys of ``rows``, in the columns of ``history`` with the mark: a
    batch to append to it. Values are NULL; a key given twice is deleted once."""
    marked = {
        LOADED_AT: as_ntz(loaded_at), BATCH_ID: F.lit(batch_id), IS_DELETED: F.lit(True),
    }
    names = [f for f in history.schema.names if f != IS_DELETED]
    columns = [
        F.col(name) if name in keys
        else marked.get(name, F.lit(None)).cast(history.schema[name].dataType).alias(name)
        for name in names
    ]
    return rows.select(*keys).distinct().select(*columns, marked[IS_DELETED].alias(IS_DELETED))


def with_deletes(history: DataFrame, deletes: DataFrame) -> DataFrame:
    """A history and batches of tombstones together; versions without a mark are rows."""
    if IS_DELETED not in history.columns:
        history = history.withColumn(IS_DELETED, F.lit(False))
    return history.unionByName(deletes)


def newest(history: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The newest version of every row, deleted ones left out.

    Spark keeps only the first row per key on each map task before it shuffles, so a key
    with very many versions does not gather in one task.
    """
    order = Window.partitionBy(*row_identity(keys, null_safe)).orderBy(
        F.col(LOADED_AT).desc(), F.col(BATCH_ID).desc()
    )
    ranked = history.withColumn("_version_rank", F.row_number().over(order))
    first = ranked.filter(F.col("_version_rank") == 1).drop("_version_rank")
    return first.filter(is_live(history)) if IS_DELETED in history.columns else first


def at_time(
    history: DataFrame, keys: Sequence[str], when: TimeLike, null_safe: bool = False
) -> DataFrame:
    """The table as it was at a time, loads of that instant included."""
    return newest(history.filter(F.col(LOADED_AT) <= as_ntz(when)), keys, null_safe)


def at_offset(
    history: DataFrame, keys: Sequence[str], now: TimeLike, seconds: int, null_safe: bool = False
) -> DataFrame:
    """The table as it was ``seconds`` before ``now``."""
    return at_time(history, keys, before_by(as_ntz(now), seconds), null_safe)


def before_time(
    history: DataFrame, keys: Sequence[str], when: TimeLike, null_safe: bool = False
) -> DataFrame:
    """The table as it was just before a time, loads of that instant left out."""
    return newest(history.filter(F.col(LOADED_AT) < as_ntz(when)), keys, null_safe)


def before_batch(
    history: DataFrame, keys: Sequence[str], batch_id: int, null_safe: bool = False
) -> DataFrame:
    """The table as it was before a batch was loaded."""
    return newest(history.filter(F.col(BATCH_ID) < batch_id), keys, null_safe)


def version_pairs(
    history: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    now: TimeLike,
    earlier: TimeLike,
    include_earlier: bool,
) -> DataFrame:
    """Keys present both now and earlier, with ``now`` and ``earlier`` value structs.

    Gives the rows of an inner self-join of two versions, in one pass: the newest version
    up to each time is an aggregate that is combined before its single shuffle.
    """
    version = F.struct(LOADED_AT, BATCH_ID)
    loaded, bound = F.col(LOADED_AT), as_ntz(earlier)
    is_earlier = loaded <= bound if include_earlier else loaded < bound
    picked = F.struct(*values)
    if IS_DELETED in history.columns:  # a tombstone counts as the newest version, but gives no row
        picked = F.when(is_live(history), picked)
        history = history.withColumn("_picked", picked)
        picked = F.col("_picked")
        pairs = (
            history.filter(has_full_key(keys) & (loaded <= as_ntz(now)))
            .groupBy(*keys)
            .agg(
                F.max_by(F.struct(picked.alias("row")), version)["row"].alias("now"),
                F.max_by(F.struct(picked.alias("row")), F.when(is_earlier, version))["row"].alias("earlier"),
            )
        )
        return pairs.filter(F.col("now").isNotNull() & F.col("earlier").isNotNull())
    pairs = (
        history.filter(has_full_key(keys) & (loaded <= as_ntz(now)))
        .groupBy(*keys)
        .agg(
            F.max_by(picked, version).alias("now"),
            F.max_by(picked, F.when(is_earlier, version)).alias("earlier"),
        )
    )
    return pairs.filter(F.col("earlier").isNotNull())


def row_counts_at(
    history: DataFrame,
    keys: Sequence[str],
    points: Mapping[str, TimeLike],
    null_safe: bool = False,
) -> DataFrame:
    """Number of table rows at several times: ``(point_in_time, rows)``.

    A row exists from its first version on, so one pass over the history answers all
    times together. With tombstones the newest version up to each time decides.
    """
    if IS_DELETED in history.columns:
        version, loaded = F.struct(LOADED_AT, BATCH_ID), F.col(LOADED_AT)
        live = history.withColumn("_live", is_live(history)).groupBy(*row_identity(keys, null_safe)).agg(
            *[
                F.max_by("_live", F.when(loaded <= as_ntz(when), version)).alias(name)
                for name, when in points.items()
            ]
        )
        counts = live.agg(*[F.count_if(F.col(name)).alias(name) for name in points])
        return counts.unpivot([], list(points), "point_in_time", "rows")
    first = history.groupBy(*row_identity(keys, null_safe)).agg(F.min(LOADED_AT).alias("first"))
    counts = first.agg(
        *[F.count_if(F.col("first") <= as_ntz(when)).alias(name) for name, when in points.items()]
    )
    return counts.unpivot([], list(points), "point_in_time", "rows")


def restore_subset(
    history: DataFrame,
    keys: Sequence[str],
    now: TimeLike,
    restore_to: TimeLike,
    subset: Column,
    null_safe: bool = False,
) -> DataFrame:
    """The current table with the rows of ``subset`` set back to an earlier state.

    Rows that did not exist then are kept as they are. One pass: of each row the newest of its
    old versions wins if there is one, else the newest of all. Rows deleted since come back; those
    that were deleted at the time did not exist then. ``subset`` is a condition on the keys, as
    tombstones have no values.
    """
    loaded = F.col(LOADED_AT)
    old = (loaded <= as_ntz(restore_to)) & subset
    if IS_DELETED in history.columns:
        # The state then comes first, if it was a row; else the state now.
        until, version = history.filter(loaded <= as_ntz(now)), F.struct(LOADED_AT, BATCH_ID)
        row = F.struct(*history.columns)
        old = F.coalesce(old, F.lit(False)) & (F.lit(True) if null_safe else has_full_key(keys))
        states = until.groupBy(*row_identity(keys, null_safe)).agg(
            F.max_by(row, F.when(old, version)).alias("then"), F.max_by(row, version).alias("now")
        )
        lived = F.col("then").isNotNull() & ~F.coalesce(F.col(f"then.{IS_DELETED}"), F.lit(False))
        state = states.select(F.when(lived, F.col("then")).otherwise(F.col("now")).alias("row"))
        return state.select("row.*").filter(is_live(history))
    if not null_safe:  # a row with a NULL key is never updated, only added
        old = old & has_full_key(keys)
    order = Window.partitionBy(*row_identity(keys, null_safe)).orderBy(
        F.coalesce(old, F.lit(False)).desc(), loaded.desc(), F.col(BATCH_ID).desc()
    )
    ranked = history.filter(loaded <= as_ntz(now)).withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def prune_history(
    history: DataFrame, keys: Sequence[str], cutoff: TimeLike, null_safe: bool = False
) -> DataFrame:
    """The history without versions no read at or after ``cutoff`` can see."""
    recent = history.filter(F.col(LOADED_AT) > as_ntz(cutoff))
    return at_time(history, keys, cutoff, null_safe).unionByName(recent)


def store_pruned(
    history: DataFrame,
    keys: Sequence[str],
    cutoff: TimeLike,
    history_path: str,
    current_path: str,
    null_safe: bool = False,
) -> None:
    """The retention job: write what ``prune_history`` leaves, and the current table.

    The history goes to a new path, by batch, and the current table is taken from there, so
    that dashboards read one version of each row. Readers change over when both are written;
    the old path can then be deleted.
    """
    pruned = prune_history(history, keys, cutoff, null_safe)
    spark = history.sparkSession
    pruned.write.mode("overwrite").partitionBy(BATCH_ID).parquet(history_path)
    stored = spark.read.schema(pruned.schema).parquet(history_path)
    newest(stored, keys, null_safe).write.mode("overwrite").parquet(current_path)
