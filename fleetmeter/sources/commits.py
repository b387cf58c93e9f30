"""Tables that grow by committed batches, and consumers that take each batch once.

A batch is written to a folder of its own below ``data``, and counts once a marker below
``commits`` names that folder: one small file, written last. Readers join the markers, so they see
a batch as a whole or not at all, without any rename; what a broken write left is named by no
marker and never read.

A consumer's position is not a time. Its own output is such a table, and each of its markers names
the batches it was made from. So output and position appear together, a consumer that failed reads
the same batches again, and a batch that is committed late, with whatever stamp, is still waiting.
One writer at a time may commit a batch of one name, and one instance of a consumer may run.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.functions.times import utc_now
from fleetmeter.schemas import COMMITS
from fleetmeter.sources.tables import child_folders, ensure_folder, read_table, remove_folder

# Batches that a consumer takes at once: their names are in its marker.
MAX_BATCHES = 1_000
# Folders that a scan names.
NAMED_PARTS = 1_000


def publish(
    rows: DataFrame,
    path: str,
    commit_id: str,
    partition_by: Sequence[str] = (),
    source: str | None = None,
    consumed: Sequence[str] = (),
) -> bool:
    """Add ``rows`` as the batch ``commit_id``, visible as a whole. A batch that is there already
    stays as it is, and the rows are not computed again; False then."""
    spark = rows.sparkSession
    if not commits(spark, path).filter(F.col("commit_id") == commit_id).isEmpty():
        return False
    part = f"{re.sub('[^A-Za-z0-9_.-]', '-', commit_id)}-{uuid.uuid4().hex[:8]}"
    rows.write.partitionBy(*partition_by).parquet(f"{path}/data/part={part}")
    marker = spark.range(1).select(
        F.lit(commit_id).alias("commit_id"),
        F.lit(part).alias("part"),
        utc_now().alias("committed_at"),
        F.lit(source).cast("string").alias("source"),
        F.array(*map(F.lit, consumed)).cast("array<string>").alias("consumed"),
    )
    marker.coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return True


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The markers of a table, one per batch: of two of one name the first."""
    ensure_folder(spark, f"{path}/commits")
    markers = read_table(spark, f"{path}/commits", COMMITS)
    first = F.min_by(F.struct("part", "committed_at", "source", "consumed"), F.struct("committed_at", "part"))
    return markers.groupBy("commit_id").agg(first.alias("first")).select("commit_id", "first.*")


def marker_stream(spark: SparkSession, path: str, max_commits: int | None = None) -> DataFrame:
    """The markers of a table as a stream: what a streaming job takes for its new batches."""
    ensure_folder(spark, f"{path}/commits")
    reader = spark.readStream.schema(COMMITS)
    if max_commits is not None:
        reader = reader.option("maxFilesPerTrigger", max_commits)
    return reader.parquet(f"{path}/commits")


def read_committed(
    spark: SparkSession, path: str, schema: T.StructType, only: DataFrame | Column | None = None
) -> DataFrame:
    """The rows of all committed batches, or of those whose marker ``only`` keeps: a condition, or
    a table of ``commit_id``. ``schema`` may have the folder columns of the batches; ``commit_id``
    is added. Up to ``NAMED_PARTS`` batches are named in the scan, which opens only their folders;
    with more the rows are joined with the markers."""
    done = commits(spark, path).select("commit_id", "part")
    if isinstance(only, DataFrame):
        done = done.join(only.select("commit_id").distinct(), "commit_id", "left_semi")
    elif only is not None:
        done = done.filter(only)
    ensure_folder(spark, f"{path}/data")
    stored = read_table(spark, f"{path}/data", T.StructType([*schema, T.StructField("part", T.StringType())]))
    named = done.limit(NAMED_PARTS + 1).collect()
    if len(named) <= NAMED_PARTS:
        stored = stored.filter(F.col("part").isin([row["part"] for row in named]))
        done = F.broadcast(spark.createDataFrame(named, "commit_id string, part string"))
    return stored.join(done, "part").select(*schema.names, "commit_id")


def pending(spark: SparkSession, source: str, target: str, name: str) -> DataFrame:
    """The batches of ``source`` that the consumer ``name`` has not taken into ``target``."""
    taken = commits(spark, target).filter(F.col("source") == name)
    taken = taken.select(F.explode("consumed").alias("commit_id"))
    return commits(spark, source).join(taken, "commit_id", "left_anti")


def has_pending(spark: SparkSession, source: str, target: str, name: str) -> DataFrame:
    """One row, ``has_data``: whether a batch is waiting for the consumer, in the form of
    ``changes.has_new_data``."""
    return pending(spark, source, target, name).agg((F.count("*") > 0).alias("has_data"))


def consume(
    spark: SparkSession,
    source: str,
    target: str,
    name: str,
    schema: T.StructType,
    work: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
    max_batches: int = MAX_BATCHES,
) -> list[str]:
    """Take the batches that are waiting, at most ``max_batches`` in the order of their commit,
    and publish what ``work`` makes of their rows. Returns their names, none if none is waiting.

    If this breaks off before the output is published, the next call takes the same batches."""
    waiting = pending(spark, source, target, name).orderBy("committed_at", "commit_id")
    names = [row["commit_id"] for row in waiting.select("commit_id").limit(max_batches).collect()]
    if names:
        rows = read_committed(spark, source, schema, F.col("commit_id").isin(names))
        listed = "\n".join(sorted(names)).encode()
        commit_id = f"{name}-{len(names)}-{zlib.crc32(listed):08x}-{zlib.adler32(listed):08x}"
        publish(work(rows), target, commit_id, partition_by, name, names)
    return names


def remove_unnamed(spark: SparkSession, path: str, keep: Column | None = None) -> list[str]:
    """Remove the folders that no marker names, and those of batches that ``keep`` does not keep.
    No batch may be written meanwhile. Returns the names of the removed folders."""
    kept = commits(spark, path)
    kept = kept if keep is None else kept.filter(keep)
    parts = {row["part"] for row in kept.select("part").collect()}
    unnamed = [x for x in child_folders(spark, f"{path}/data") if x.removeprefix("part=") not in parts]
    for folder in unnamed:
        remove_folder(spark, f"{path}/data/{folder}")
    return unnamed
