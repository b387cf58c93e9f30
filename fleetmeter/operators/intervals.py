"""A history coded by intervals: each version with the time from which and until which it held.

Open versions are those that still hold, closed ones have an end. A batch ends only the open
versions of its own keys, so what it costs does not depend on the length of the history. A read at
a time is a filter on the two times: no version is ranked and no row is moved. Closed versions are
stored by the day of their end, so a read opens only files of versions that ended later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.functions.times import TimeLike, as_ntz
from fleetmeter.operators.history import IS_DELETED
from fleetmeter.operators.upsert import same_key
from fleetmeter.sources.commits import commits, publish, read_committed, remove_unnamed

FROM, TO, ENDED = "valid_from", "valid_to", "ended_on"


def apply_batch(
    open_versions: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    loaded_at: TimeLike,
    null_safe: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The open versions after a batch, and the versions that it ends.

    The rows of ``batch``, one per key, begin at ``loaded_at``; tombstones (``is_deleted``) only
    end what is open. With plain equality a row with a NULL key ends nothing. A batch that is not
    later than the version it ends leaves an interval without length, which no read sees.
    """
    stamp, values = as_ntz(loaded_at), [c for c in open_versions.columns if c != FROM]
    begins = batch if IS_DELETED not in batch.columns else batch.filter(f"NOT coalesce({IS_DELETED}, false)")
    begins = begins.select(*values, stamp.alias(FROM))
    ended = batch.select(*keys).distinct().alias("b")
    same = same_key("o", "b", keys, null_safe)
    sides = open_versions.alias("o")
    stays = sides.join(ended, same, "left_anti")
    closed = sides.join(ended, same, "left_semi").withColumn(TO, stamp)
    return stays.unionByName(begins), closed


def at_time(open_versions: DataFrame, closed: DataFrame, when: TimeLike) -> DataFrame:
    """The table as it was at a time, loads of that instant included."""
    at = as_ntz(when)
    return _held(open_versions, closed, F.col(FROM) <= at, F.col(TO) > at, F.col(ENDED) >= at.cast("date"))


def before_time(open_versions: DataFrame, closed: DataFrame, when: TimeLike) -> DataFrame:
    """The table as it was just before a time."""
    at = as_ntz(when)
    return _held(open_versions, closed, F.col(FROM) < at, F.col(TO) >= at, F.col(ENDED) >= at.cast("date"))


def _held(
    open_versions: DataFrame, closed: DataFrame, begun: Column, not_ended: Column, on_days: Column
) -> DataFrame:
    names = open_versions.columns
    old = closed.filter(on_days) if ENDED in closed.columns else closed
    old = old.filter(begun & not_ended).select(*names)
    return open_versions.filter(begun).unionByName(old).drop(FROM)


def add_batch(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    batch: DataFrame,
    keys: Sequence[str],
    loaded_at: TimeLike,
    batch_id: int,
    null_safe: bool = False,
) -> None:
    """Apply a batch to the stored tables. Closed versions are published before the open ones of
    the batch; a reader takes both up to the newest batch whose open versions are there, so it
    sees the state before or after, and a batch that is run again finds what it has written."""
    before, _ = read_stored(spark, path, schema)
    now_open, ended = apply_batch(before, batch, keys, loaded_at, null_safe)
    by_end = ended.withColumn(ENDED, F.col(TO).cast("date"))
    publish(by_end, f"{path}/closed", str(batch_id), [ENDED])
    publish(now_open, f"{path}/open", str(batch_id))


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The open and the closed versions after the last whole batch."""
    number = F.col("commit_id").cast("long")
    last = commits(spark, f"{path}/open").agg(F.max(number)).first()[0]
    last = -1 if last is None else last
    open_schema = T.StructType([*schema, T.StructField(FROM, T.TimestampNTZType())])
    closed_schema = T.StructType(
        [*open_schema, T.StructField(TO, T.TimestampNTZType()), T.StructField(ENDED, T.DateType())]
    )
    open_versions = read_committed(spark, f"{path}/open", open_schema, number == last)
    closed = read_committed(spark, f"{path}/closed", closed_schema, number <= last)
    return open_versions.drop("commit_id"), closed.drop("commit_id")


def drop_old_open(spark: SparkSession, path: str) -> list[str]:
    """Remove the stored open versions of all batches but the last; none may be read meanwhile."""
    number = F.col("commit_id").cast("long")
    last = commits(spark, f"{path}/open").agg(F.max(number)).first()[0]
    return remove_unnamed(spark, f"{path}/open", number == F.lit(last))
