"""The jobs that keep the layers up to date, as Structured Streaming queries.

Each query keeps its position in its own checkpoint, which belongs to its output: delete
both or neither. With ``available_now`` a query takes all that is waiting and stops, and
does nothing when nothing is new; otherwise it runs at the given interval.

The rows of a micro-batch are aggregated by the batch operators inside ``foreachBatch``,
each into a batch that is committed as a whole (``sources/commits.py``), so that a batch that is
run again after a failure finds its output there, or writes it for the first time. Jobs that read
such a table stream its markers, and read the batches that new markers name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fleetmeter.functions.payload import extract_readings
from fleetmeter.functions.times import TimeLike
from fleetmeter.operators.gold import (
    add_fleet_partials,
    finish_fleet,
    fleet_partials,
    gold_rows,
)
from fleetmeter.operators.join_back import BROADCAST_ROWS
from fleetmeter.operators.silver import READING_COLUMNS, Thresholds, silver_hourly
from fleetmeter.operators.upsert import same_key
from fleetmeter.schemas import LOADS
from fleetmeter.sources.commits import commits, marker_stream
from fleetmeter.sources.json_files import bronze_rows, parse_loads, read_raw
from fleetmeter.sources.layers import (
    append_history,
    append_silver,
    drop_states_before,
    read_silver,
    read_state,
    store_state,
)
from fleetmeter.sources.tables import ensure_folder

# How often the jobs look for new rows.
SILVER_INTERVAL = "5 minutes"
GOLD_INTERVAL = "10 minutes"

# Up to this many touched days are named in the scan of the silver table, so that it
# reads only their folders. With more, it reads all days from the first to the last of them.
NAMED_DAYS = 400


def _start(
    writer: DataStreamWriter, checkpoint: str, available_now: bool, interval: str
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def _stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def ingest_files(
    spark: SparkSession,
    landing: str,
    loads_path: str,
    checkpoint: str,
    layout: str = "whole",
    loaded_at: TimeLike | None = None,
    available_now: bool = True,
    interval: str = "10 seconds",
    max_files: int | None = None,
) -> StreamingQuery:
    """New files to load rows, each file once, in batches of at most ``max_files``.

    Good and quarantined rows go into one table in one pass, told apart by the folder
    column ``ok``, and the file sink commits each batch as a whole.
    """
    ensure_folder(spark, landing)
    loads = parse_loads(read_raw(spark, landing, layout, stream=True, max_files=max_files), loaded_at)
    writer = loads.writeStream.format("parquet").option("path", loads_path).partitionBy("ok")
    return _start(writer, checkpoint, available_now, interval)


def silver_job(
    spark: SparkSession,
    loads_path: str,
    silver_path: str,
    checkpoint: str,
    load_ts: TimeLike | None = None,
    thresholds: Thresholds = Thresholds(),
    on_bad_value: str = "fail",
    available_now: bool = True,
    interval: str = SILVER_INTERVAL,
    max_files: int | None = None,
) -> StreamingQuery:
    """New bronze rows to hourly rows, appended batch by batch. A batch appears as a whole, and is
    not written again once it is there."""
    ensure_folder(spark, loads_path)
    bronze = bronze_rows(_stream(spark, loads_path, LOADS, max_files))
    readings = extract_readings(bronze, on_bad_value=on_bad_value).select(*READING_COLUMNS)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_silver(silver_hourly(batch, load_ts, thresholds), silver_path, batch_id)

    writer = readings.writeStream.foreachBatch(write)
    return _start(writer, checkpoint, available_now, interval)


def gold_job(
    spark: SparkSession,
    silver_path: str,
    history_path: str,
    checkpoint: str,
    loaded_at: TimeLike | None = None,
    available_now: bool = True,
    interval: str = GOLD_INTERVAL,
    max_batches: int | None = None,
) -> StreamingQuery:
    """New silver rows to KPI versions, those of at most ``max_batches`` silver batches at once.

    The KPIs come from the new rows alone and stand in for the stored ones of the same
    hour and site, so a late part of an hour hides the earlier part. ``gold_refresh_job``
    does not have that effect.
    """

    def write(markers: DataFrame, batch_id: int) -> None:
        new = read_silver(markers.sparkSession, silver_path, markers)
        append_history(gold_rows(new, loaded_at), history_path, batch_id)

    writer = marker_stream(spark, silver_path, max_batches).writeStream.foreachBatch(write)
    return _start(writer, checkpoint, available_now, interval)


def gold_refresh_job(
    spark: SparkSession,
    silver_path: str,
    history_path: str,
    checkpoint: str,
    loaded_at: TimeLike | None = None,
    available_now: bool = True,
    interval: str = GOLD_INTERVAL,
    max_batches: int | None = None,
) -> StreamingQuery:
    """New silver rows name the hours and sites to compute again from the whole table.

    Only the folders of the touched days are opened. Rows without a time have no day and grow
    for ever, so their KPIs are not computed again but added up: partial rows per device are
    kept beside the history, the version after the last batch and the one before it.

    Read the history with ``null_safe=True``: the NULL hour is one group for each site.
    """

    def write(markers: DataFrame, batch_id: int) -> None:
        session = markers.sparkSession
        batch = read_silver(session, silver_path, markers)
        keys = batch.filter("day IS NOT NULL").select("hour_bucket", "site_id", "day")
        rows = gold_rows(touched_rows(read_silver(session, silver_path), keys), loaded_at)
        timeless = batch.filter("day IS NULL")
        if not timeless.isEmpty():
            added = _add_timeless(timeless, history_path, batch_id)
            rows = rows.unionByName(finish_fleet(added, loaded_at))
        append_history(rows, history_path, batch_id)

    writer = marker_stream(spark, silver_path, max_batches).writeStream.foreachBatch(write)
    return _start(writer, checkpoint, available_now, interval)


def state_folder(history_path: str) -> str:
    """Where the refreshing job keeps the partial rows of the NULL hour."""
    return f"{history_path}_null_hour"


def _add_timeless(new: DataFrame, history_path: str, batch_id: int) -> DataFrame:
    """Add silver rows without a time to the state before this batch, and store the sum as this
    batch's version; the same batch again finds it there. Returns the sites that the batch has.

    The version before stays until the next batch, for one that is run again; older ones go."""
    spark, folder = new.sparkSession, state_folder(history_path)
    earlier = F.col("commit_id").cast("long")
    newest = commits(spark, folder).filter(earlier < batch_id).agg(F.max(earlier)).first()[0]
    before = read_state(spark, folder).filter(F.col("batch_id") == F.lit(-1 if newest is None else newest))
    sites = new.select("site_id").distinct()
    state = add_fleet_partials(before.drop("batch_id").unionByName(fleet_partials(new)))
    store_state(state, folder, batch_id)
    if newest is not None:
        drop_states_before(spark, folder, newest)
    written = read_state(spark, folder).filter(F.col("batch_id") == batch_id)
    same = same_key("p", "s", ["site_id"], null_safe=True)
    return written.drop("batch_id").alias("p").join(sites.alias("s"), same, "left_semi")


def touched_rows(
    stored: DataFrame,
    batch: DataFrame,
    named_days: int = NAMED_DAYS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All stored silver rows of the hours and sites that occur in a batch.

    The touched groups are counted per day first. Few groups are broadcast, so that the
    stored rows do not move before they are aggregated; more are joined by a shuffle.
    """
    groups = batch.select("hour_bucket", "site_id", "day").distinct()
    totals = groups.agg(
        F.count("*").alias("groups"),
        F.min("day").alias("first"),
        F.max("day").alias("last"),
        F.count_if(F.col("day").isNull()).alias("without"),
    ).first()
    days = groups.select("day").where("day IS NOT NULL").distinct().limit(named_days + 1).collect()
    groups = groups.drop("day")
    day = F.col("day")
    in_days = day.isin([row["day"] for row in days])
    if len(days) > named_days:
        in_days = day.between(totals["first"], totals["last"])
    stored = stored.filter(in_days | day.isNull() if totals["without"] else in_days)
    if totals["groups"] <= broadcast_rows:
        groups = F.broadcast(groups)
    same = same_key("s", "b", ["hour_bucket", "site_id"], null_safe=True)
    return stored.alias("s").join(groups.alias("b"), same, "left_semi")
