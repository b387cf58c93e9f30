"""Which files were loaded, and how that went."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.functions.times import TimeLike, as_ntz, before_by, utc_now
from fleetmeter.operators.join_back import BROADCAST_ROWS, computed_and_counted
from fleetmeter.schemas import LOAD_LOG, LOADS
from fleetmeter.session import work_folder
from fleetmeter.sources.json_elements import load_elements
from fleetmeter.sources.json_files import list_files, parse_loads, read_raw
from fleetmeter.sources.tables import append, ensure_folder, read_table

DAY_SECONDS = 86_400

# How long a loaded file name is remembered, and the span of the history.
SKIP_DAYS = 64
HISTORY_DAYS = 14

# Files of one load: their names are in the driver and in a plan.
FILES_PER_LOAD = 10_000


def only_new_files(
    incoming: DataFrame,
    loads: DataFrame,
    now: TimeLike,
    force: bool = False,
    skip_days: int = SKIP_DAYS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of files that were not loaded in the last ``skip_days``.

    ``loads`` is any table with ``file_name`` and ``loaded_at``: stored rows, or better
    one row per file. ``force`` loads everything again. The known names are computed once
    and broadcast if they are few, so that rows of one large file do not gather in one
    task; otherwise Spark joins by a shuffle and splits such a file there.
    """
    if force:
        return incoming
    since = before_by(as_ntz(now), skip_days * DAY_SECONDS)
    names = loads.filter(F.col("loaded_at") > since).select("file_name").distinct()
    seen, few = computed_and_counted(names, broadcast_rows)
    known = F.broadcast(seen) if few else seen
    return incoming.join(known, "file_name", "left_anti").select(*incoming.columns)


def load_history(
    loads: DataFrame, as_of: TimeLike, days: int = HISTORY_DAYS
) -> DataFrame:
    """One row per file and load of the last days: status, counts, an error, load time.

    A file that was loaded twice has two rows. Of several messages the first by alphabet is
    given. One hash aggregate; a file's messages are few.
    """
    recent = loads.filter(F.col("loaded_at") > before_by(as_ntz(as_of), days * DAY_SECONDS))
    return _with_status(_counts(recent, ["file_name", "loaded_at"]))


def _counts(loads: DataFrame, by: list[str]) -> DataFrame:
    bad = ~F.col("ok")
    return loads.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(bad).alias("error_count"),
        F.array_min(F.collect_set(F.when(bad, F.col("error")))).alias("first_error_message"),
    )


def _with_status(counts: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("error_count") == 0, "LOADED")
        .when(F.col("error_count") == F.col("row_count"), "LOAD_FAILED")
        .otherwise("PARTIALLY_LOADED")
    )
    kept = [c for c in counts.columns if c not in LOAD_LOG.names]
    return counts.select(
        "file_name", status.alias("status"), "row_count", "error_count",
        "first_error_message", "loaded_at", *kept,
    )


def load_files(
    spark: SparkSession,
    landing: str,
    loads_path: str,
    log_path: str,
    loaded_at: TimeLike | None = None,
    layout: str = "whole",
    force: bool = False,
    skip_days: int = SKIP_DAYS,
    max_files: int = FILES_PER_LOAD,
) -> DataFrame:
    """A batch load: list, skip what the log knows, read, set bad rows aside, store, log.

    Known files are not opened. The rows go to a folder of their load below ``loads_path``, in
    the form of ``parse_loads``; the log comes last and makes them count for ``loaded_rows``. A
    load that broke off leaves a folder that no log names, and the same files are loaded again.
    A file without rows is logged too. ``force`` loads everything again, as a load of its own.
    ``layout`` is one of ``read_raw``, or ``elements`` for ``load_elements``.

    New files are listed once and kept as a table. They are loaded in parts of at most
    ``max_files``, by name, so that neither the driver nor a plan holds the names of more. Each
    part is a load with log rows of its own; one that breaks off leaves the earlier ones loaded.
    Returns the log rows of all parts, none if there was nothing to do.
    """
    stamp = spark.range(1).select(
        (utc_now() if loaded_at is None else as_ntz(loaded_at)).alias("at")
    ).first()["at"]
    ensure_folder(spark, landing)
    ensure_folder(spark, log_path)
    log = read_table(spark, log_path, LOAD_LOG)
    listed = work_folder(spark, "new-files")
    only_new_files(list_files(spark, landing), log, stamp, force, skip_days).write.parquet(listed)
    new = spark.read.schema("file_name string, full_path string").parquet(listed)
    done: list[str] = []
    after = F.lit(True)
    while part := new.filter(after).orderBy("file_name").limit(max_files).collect():
        names = [row["file_name"] for row in part]
        load_id = f"{stamp:%Y%m%dT%H%M%S%f}-{zlib.crc32(chr(10).join(names).encode()):08x}"
        paths = [row["full_path"] for row in part]
        if layout == "elements":
            rows = load_elements(spark, landing, stamp, only=paths)
        else:
            rows = parse_loads(read_raw(spark, landing, layout, only=paths), stamp)
        folder = f"{loads_path}/load_id={load_id}"
        rows.write.mode("overwrite").partitionBy("ok").parquet(folder)
        found = _counts(read_table(spark, folder, LOADS), ["file_name"])
        files = spark.createDataFrame([(name,) for name in names], "file_name string")
        counts = files.join(found, "file_name", "left").fillna(0, ["row_count", "error_count"])
        logged = _with_status(counts.withColumn("loaded_at", F.lit(stamp).cast("timestamp_ntz")))
        logged = logged.withColumn("load_id", F.lit(load_id)).select(*LOAD_LOG.names)
        append(logged, log_path)
        done.append(load_id)
        after = F.col("file_name") > names[-1]
    return read_table(spark, log_path, LOAD_LOG).filter(F.col("load_id").isin(done))


def loaded_rows(spark: SparkSession, loads_path: str, log_path: str) -> DataFrame:
    """The rows of all logged loads; folders of other loads are not read."""
    stored = read_table(spark, loads_path, T.StructType([*LOADS, LOAD_LOG["load_id"]]))
    done = read_table(spark, log_path, LOAD_LOG).select("load_id").distinct()
    return stored.join(done, "load_id", "left_semi")
