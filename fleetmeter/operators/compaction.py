"""Compaction of a table of committed batches: only files that lie too deep or are too small.

The files are intervals of a sort key. Intervals that meet hang together; a group of them is
rewritten in key order if some key is covered by too many files, and neighbouring small groups are
rewritten together. All other files stay as they are, names included. The rewritten rows are one
more committed batch, whose marker also says which files it stands for: a reader sees the table as
it was or as it is, with the same rows.

One compaction of a table may run at a time; batches may be appended meanwhile. A consumer of
batches (``commits.consume``) must not read such a table, as a compaction is a batch as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.operators.layout import file_depths, file_ranges
from fleetmeter.operators.running import with_total_before
from fleetmeter.session import cut_lineage
from fleetmeter.sources import commits
from fleetmeter.sources.tables import ensure_folder, read_table, remove_folder

REPLACED = T.StructType([T.StructField("run", T.StringType()), T.StructField("file", T.StringType())])
# Files that a scan names; more are joined.
NAMED_FILES = 1_000
MAX_DEPTH = 4
TARGET_BYTES = 256 << 20
SMALL_BYTES = 64 << 20
COMPONENTS_PER_BUCKET = 2_000


def append(rows: DataFrame, path: str, commit_id: str) -> bool:
    """Add rows as a batch. False if a batch of that name is there already."""
    return commits.publish(rows.withColumn("bin", F.lit(0).cast("long")), path, commit_id, ["bin"])


def _replaced(spark: SparkSession, path: str) -> DataFrame:
    """The files that committed compactions stand for."""
    ensure_folder(spark, f"{path}/replaced")
    runs = commits.commits(spark, path).filter("source = 'compaction'").select(F.explode("consumed").alias("run"))
    return read_table(spark, f"{path}/replaced", REPLACED).join(runs, "run", "left_semi").select("file")


def read_live(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the table with their ``file`` (below the data folder) and its ``bytes``. Up to
    ``NAMED_FILES`` replaced files are named in the scan, which then does not open them."""
    ensure_folder(spark, f"{path}/data")
    folders = [T.StructField("part", T.StringType()), T.StructField("bin", T.LongType())]
    stored = read_table(spark, f"{path}/data", T.StructType([*schema, *folders]))
    stored = stored.withColumns(
        {
            "file": F.regexp_extract(F.col("_metadata.file_path"), "part=.*$", 0),
            "bytes": F.col("_metadata.file_size"),
        }
    )
    parts = commits.commits(spark, path).select("part")
    named = parts.limit(commits.NAMED_PARTS + 1).collect()
    if len(named) <= commits.NAMED_PARTS:
        stored = stored.filter(F.col("part").isin([row["part"] for row in named]))
    else:
        stored = stored.join(parts, "part", "left_semi")
    gone = _replaced(spark, path)
    names = [row["file"] for row in gone.limit(NAMED_FILES + 1).collect()]
    if len(names) > NAMED_FILES:
        stored = stored.join(gone, "file", "left_anti")
    elif names:
        stored = stored.filter(~F.col("file").isin(names))
    return stored.select(*schema.names, "file", "bytes")


def _components(files: DataFrame) -> DataFrame:
    """``files`` with ``component``, the number of their group of intervals that hang together,
    in key order. A file begins a group if it lies above all that begin before it. The greatest
    end so far runs within ranges of files; only one row for each range is put in one order."""
    order = ["low", "high", "file"]
    dealt = cut_lineage(files.repartitionByRange(*order).withColumn("deal", F.spark_partition_id()))
    earlier = W.orderBy("deal").rowsBetween(W.unboundedPreceding, -1)
    carried = dealt.groupBy("deal").agg(F.max("high").alias("high"))
    carried = carried.select("deal", F.max("high").over(earlier).alias("high_before_deal"))
    within = W.partitionBy("deal").orderBy(*order)
    so_far = F.max("high").over(within.rowsBetween(W.unboundedPreceding, -1))
    reached = F.greatest("high_within", "high_before_deal")
    begun = (
        dealt.withColumn("high_within", so_far)
        .join(carried, "deal")
        .withColumn("begins", F.coalesce(F.col("low") > reached, F.lit(True)).cast("long"))
        .withColumns({"all": F.lit(0), "deal": F.col("deal").cast("long")})
        .drop("high_within", "high_before_deal")
    )
    counted = with_total_before(cut_lineage(begun), "all", "deal", order, "begins", "before")
    return counted.select(*files.columns, (F.col("before") + F.col("begins")).alias("component"))


def files_to_rewrite(files: DataFrame, max_depth: int, small_bytes: int, target_bytes: int) -> DataFrame:
    """``(file, bytes, bin)`` of the files to rewrite, those of one ``bin`` together.

    ``files`` is a stored table of ``(file, low, high, bytes)``. A group of intervals that hang
    together is taken if a file's depth in it is above ``max_depth``, or if it is smaller than
    ``small_bytes`` as a whole. Taken groups that follow each other with none left out between are
    put into bins of about ``target_bytes``; a group is not parted. A bin of one file is left
    alone, and so is a file of one key value that is not small: it can lie no better.
    """
    point = (F.col("low") == F.col("high")) & (F.col("bytes") >= small_bytes)
    files = files.filter(~point)
    # Each step reads its input several times, so that of the one before is stored: a row per file.
    placed = cut_lineage(_components(files.join(file_depths(files), "file")))
    groups = placed.groupBy("component").agg(
        F.max("depth").alias("depth"), F.sum("bytes").alias("bytes")
    )
    taken = (F.col("depth") > max_depth) | (F.col("bytes") < small_bytes)
    groups = groups.withColumns(
        {
            "left_out": (~taken).cast("long"),
            "all": F.lit(0),
            "bucket": F.floor(F.col("component") / COMPONENTS_PER_BUCKET),
        }
    )
    groups = with_total_before(cut_lineage(groups), "all", "bucket", ["component"], "left_out", "run")
    groups = cut_lineage(groups.filter("left_out = 0"))
    groups = cut_lineage(with_total_before(groups, "run", "bucket", ["component"], "bytes", "offset"))
    groups = groups.withColumn("slot", F.floor(F.col("offset") / target_bytes))
    slots = groups.groupBy("run", "slot").agg(F.min("component").alias("bin"))
    bins = groups.join(slots, ["run", "slot"]).select("component", "bin")
    found = cut_lineage(placed.join(bins, "component").select("file", "bytes", "bin"))
    more = found.groupBy("bin").agg(F.count("*").alias("n")).filter("n > 1").select("bin")
    return found.join(more, "bin", "left_semi")


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: Sequence[str],
    max_depth: int = MAX_DEPTH,
    small_bytes: int = SMALL_BYTES,
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Rewrite what needs it, sorted by ``key``, and return the number of files replaced, 0 if all
    lie well. Measuring reads the key columns of the live files; rewriting reads the files that
    are replaced. If it breaks off before its marker is written, nothing has changed."""
    if small_bytes * 2 > target_bytes:
        raise ValueError("target_bytes must be at least twice small_bytes")
    live = read_live(spark, path, schema)
    sizes = live.groupBy("file").agg(F.max("bytes").alias("bytes"))
    files = cut_lineage(file_ranges(live, key).join(sizes, "file"))
    chosen = cut_lineage(files_to_rewrite(files, max_depth, small_bytes, target_bytes))
    per_bin = chosen.groupBy("bin").agg(F.count("*").alias("n"), F.ceil(F.sum("bytes") / target_bytes).alias("new"))
    total = per_bin.agg(F.sum("n").alias("old"), F.sum("new").alias("new")).first()
    if total["old"] is None:
        return 0
    run = uuid.uuid4().hex
    chosen.select(F.lit(run).alias("run"), "file").write.mode("append").parquet(f"{path}/replaced")
    if total["old"] <= NAMED_FILES:
        live = live.filter(F.col("file").isin([row["file"] for row in chosen.select("file").collect()]))
    rows = live.join(chosen.select("file", "bin"), "file").select(*schema.names, "bin")
    order = ["bin", *key]
    ranged = rows.repartitionByRange(int(total["new"]), *order).sortWithinPartitions(*order)
    commits.publish(ranged, path, f"compaction-{run}", ["bin"], "compaction", [run])
    return int(total["old"])


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Remove the files that committed compactions stand for, when no reader of an older state is
    left. The list of them stays; returns its length."""
    removed = 0
    for row in _replaced(spark, path).toLocalIterator():
        remove_folder(spark, f"{path}/data/{row['file']}")
        removed += 1
    return removed
