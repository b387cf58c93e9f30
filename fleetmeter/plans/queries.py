"""Every operator as a named query over the given tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.functions import times, values
from fleetmeter.functions.payload import extract_readings, payload_field
from fleetmeter.operators import (
    anomaly,
    changes,
    compaction,
    curve,
    episodes,
    gold,
    history as versions,
    intervals,
    layout,
    maintained,
    moments,
    reconcile,
    reports,
    rules,
    silver,
)
from fleetmeter.operators.upsert import merge, upsert
from fleetmeter.plans import fleet_view as view
from fleetmeter.schemas import (
    GOLD,
    GOLD_HISTORY,
    GOLD_KEYS,
    LOADS,
    SILVER,
    SILVER_PARTIALS,
    SILVER_STORED,
)
from fleetmeter.session import work_folder
from fleetmeter.sources import commits, csv_files, json_elements, json_files, layers, loads, tables
from fleetmeter.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = "2024-02-01 02:30:00"
HOUR = 3600
SILVER_CURVE = ["hour_bucket", "site_id", "device_id"]
METRICS = [c for c in GOLD.names if c not in (*GOLD_KEYS, "loaded_at")]
SILVER_FLOATS = [f.name for f in SILVER if f.dataType.simpleString() == "double"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _rounded(table: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Float results to fixed digits: the last bits of a sum depend on its order."""
    return table.withColumns({c: values.round_fixed(F.col(c), digits) for c in columns})


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fleet_metrics(view.silver(spark, sf_dir))


def _latest_hour(spark: SparkSession, sf_dir: str):
    """The newest hour in the data; reports look back from it."""
    newest = view.readings(spark, sf_dir).agg(F.max("reading_time").alias("t"))
    return newest.select(times.hour_bucket(F.col("t"))).scalar()


# --- sources -----------------------------------------------------------------------


@query
def bronze_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects, one-element arrays and two-element arrays of payloads to rows."""
    shape, raw = F.col("reading_id") % 3, F.col("raw")
    text = (
        F.when(shape == 0, F.concat(F.lit("["), raw, F.lit("]")))
        .when(shape == 1, F.concat(F.lit("[ "), raw, F.lit(",\n"), raw, F.lit("]")))
        .otherwise(raw)
    )
    pieces = view.payload_json(spark, sf_dir).select(text.alias("raw"), "file_name")
    bronze = json_files.bronze_rows(json_files.parse_loads(pieces, NOW))
    fields = {"reading_id": "bigint", "device_id": "string", "site_id": "string"}
    return extract_readings(bronze, fields).select(*fields, "file_name", "loaded_at")


@query
def null_if_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that stand for NULL, as they come through a load."""
    token = F.when(F.col("reading_id") % 2 == 0, "NULL").otherwise("")
    rows = view.telemetry(spark, sf_dir).withColumn("alert_type", F.coalesce("alert_type", token))
    text = F.to_json(F.struct("reading_id", "alert_type")).alias("raw")
    loaded = json_files.parse_loads(rows.select(text, "file_name"), NOW)
    fields = {"reading_id": "bigint", "alert_type": "string"}
    return extract_readings(json_files.bronze_rows(loaded), fields).select(*fields)


@query
def bronze_parse_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole files of several forms: compact and indented arrays, one object over several
    lines, an object that holds an array, and damaged ones. Rows by file and whether it is good."""
    work = work_folder(spark, "bronze_parse_files")
    rows = view.payload_json(spark, sf_dir).withColumn("file", F.expr("reading_id div 500"))
    records = F.array_sort(F.collect_list("raw"))
    files = rows.groupBy("file").agg(records.alias("r"), F.min("reading_id").alias("reading_id"))
    shape = F.col("file") % 6
    indented = F.concat(F.lit("[\n  "), F.array_join("r", ",\n  "), F.lit("\n]\n"))
    compact = F.concat(F.lit("["), F.array_join("r", ","), F.lit("]"))
    text = (
        F.when(shape == 0, indented)
        .when(shape == 1, compact)
        .when(shape == 2, F.concat(F.lit('{"file": '), "file", F.lit(',\n "readings": '), compact, F.lit("}")))
        .when(shape == 3, F.regexp_replace(F.get("r", 0), ",", ",\n  "))
        .when(shape == 4, F.expr("array_join(r, '\n')"))
        .otherwise(F.regexp_replace(indented, r"\]\s*$", ""))
    )
    # One file for each row: its folder is the number, its text has line breaks of its own.
    named = files.select(text.alias("value"), "file")
    named.write.partitionBy("file").text(work)
    loads_ = json_files.parse_loads(json_files.read_raw(spark, work), NOW)
    number = F.regexp_extract("file_name", r"^file=(\d+)/", 1).cast("bigint")
    found = loads_.groupBy(number.alias("file"), "ok").agg(F.count("*").alias("rows"))
    return found


@query
def array_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files read by element: one with texts full of brackets and quotes, one cut short, two
    arrays in one file, one with a damaged element, and one in which a string never ends. Good
    rows by id; of what is set aside, how many readings it holds."""
    work = work_folder(spark, "array_salvage")
    # Dealt out as they are read: the few tasks of a table in few files do not write the JSON texts.
    # A stated number of tasks is kept; it takes longer to write a file than its bytes tell.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = view.telemetry(spark, sf_dir).withColumn("file", F.expr("reading_id div 500"))
    rows = rows.repartition(tasks, "file").withColumn("raw", view.payload_text())
    records = F.array_sort(F.collect_list(F.struct("reading_id", "raw")))
    files = rows.groupBy("file").agg(records.alias("r")).withColumn("r", F.col("r.raw"))
    shape, n = F.col("file") % 5, F.size("r")
    note = '{"note": "a ] } , [ { \\\\ \\" é \\\\\\" ", '

    def changed(at: Column, new: Callable[[Column], Column]) -> Column:
        return F.transform("r", lambda x, i: F.when(i == at, new(x)).otherwise(x))

    def array(records: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(records, ",\n "), F.lit("]"))

    noted = F.transform("r", lambda x: F.concat(F.lit(note), F.substr(x, F.lit(2))))
    half = F.floor(n / 2).cast("int")
    parts = F.concat(array(F.slice("r", 1, half)), array(F.slice("r", half + 1, n - half)))
    broken = changed(F.least(n, F.lit(8)) - 1, lambda x: F.replace(x, F.lit('"device_id":'), F.lit('"device_id" ')))
    endless = changed(F.least(n, F.lit(251)) - 1, lambda x: F.replace(x, F.lit('"device_id":"'), F.lit('"device_id":')))
    text = (
        F.when(shape == 0, array(noted))
        .when(shape == 1, F.expr("substring(a, 1, length(a) - 10)"))
        .when(shape == 2, parts)
        .when(shape == 3, array(broken))
        .otherwise(array(endless))
    )
    named = files.withColumn("a", array(F.col("r"))).select(text.alias("value"), "file")
    named.write.partitionBy("file").text(work)
    found = json_elements.load_elements(spark, work, NOW, chunk_bytes=1 << 14)
    held = F.when(~F.col("ok"), F.regexp_count("raw", F.lit('"reading_id":')))
    return found.select(
        F.regexp_extract("file_name", r"^file=(\d+)/", 1).cast("bigint").alias("file"),
        F.coalesce(payload_field(F.col("json_data"), "reading_id", "bigint"), F.lit(-1)).alias("reading_id"),
        "ok",
        F.coalesce(held, F.lit(0)).cast("bigint").alias("held"),
    )


def _write_landing(rows: DataFrame, path: str) -> None:
    """Payloads as lines, in subfolders whose files have equal names."""
    folder = F.concat(F.lit("b"), "batch_id").alias("folder")
    rows.select("raw", folder).write.mode("append").partitionBy("folder").text(path)


_LOADED_FIELDS = {
    "reading_id": "bigint",
    "device_id": "string",
    "site_id": "string",
    "temperature": "double",
    "signal_rssi": "int",
}


def _with_folder(bronze: DataFrame) -> DataFrame:
    """Loaded fields and the subfolder that the file name begins with."""
    rows = extract_readings(bronze, _LOADED_FIELDS)
    folder = F.split("file_name", "/")[0].alias("folder")
    return rows.select(*_LOADED_FIELDS, folder, "loaded_at")


@query
def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files written out, loaded in one batch, read back."""
    work = work_folder(spark, "bronze_load")
    _write_landing(view.payload_json(spark, sf_dir), f"{work}/landing")
    paths = f"{work}/landing", f"{work}/loads", f"{work}/log"
    loads.load_files(spark, *paths, NOW, "lines")
    return _with_folder(json_files.bronze_rows(loads.loaded_rows(spark, *paths[1:])).drop("load_id"))


@query
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files taken in by the streaming job."""
    work = work_folder(spark, "bronze_stream")
    _write_landing(view.payload_json(spark, sf_dir), f"{work}/landing")
    jobs.ingest_files(
        spark, f"{work}/landing", f"{work}/loads", f"{work}/ck", "lines", NOW, max_files=1
    ).awaitTermination()
    return _with_folder(json_files.bronze_rows(tables.read_table(spark, f"{work}/loads", LOADS)))


@query
def load_new_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three subfolders one was loaded an hour ago and one too long ago to count; what the
    next load takes. Its files have the names of those already loaded."""
    work = work_folder(spark, "load_new_files_only")
    _write_landing(view.payload_json(spark, sf_dir), f"{work}/staged")
    paths = f"{work}/landing", f"{work}/loads", f"{work}/log"
    tables.ensure_folder(spark, paths[0])
    for batch, at in ((0, "2024-02-01 01:30:00"), (1, "2023-10-01 00:00:00")):
        tables.rename(spark, f"{work}/staged/folder=b{batch}", f"{paths[0]}/folder=b{batch}")
        loads.load_files(spark, *paths, at, "lines")
    tables.rename(spark, f"{work}/staged/folder=b2", f"{paths[0]}/folder=b2")
    loads.load_files(spark, *paths, NOW, "lines")
    stored = json_files.bronze_rows(loads.loaded_rows(spark, *paths[1:])).drop("load_id")
    return _with_folder(stored.filter(F.col("loaded_at") == times.as_ntz(NOW)))


def _loads_with_bad_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed payloads, some of them cut short on the way; the file of batch 2 all of them."""
    damaged = (F.col("reading_id") % 89 == 0) | (F.col("batch_id") == 2)
    cut = F.expr("substring(raw, 1, length(raw) - 5)")
    raw = F.when(damaged, cut).otherwise(F.col("raw"))
    pieces = view.payload_json(spark, sf_dir).withColumn("raw", raw)
    return json_files.parse_loads(pieces, F.col("loaded_at"))


@query
def quarantine_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = json_files.quarantine_rows(_loads_with_bad_text(spark, sf_dir))
    text_id = F.regexp_extract("raw", r'"reading_id":(\d+)', 1).cast("bigint")
    return bad.select(text_id.alias("reading_id"), "file_name", "error", "loaded_at")


@query
def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads of three files, the first of which was loaded again an hour later, repaired."""
    rows = _loads_with_bad_text(spark, sf_dir)
    again = json_files.parse_loads(
        view.payload_json(spark, sf_dir).filter("batch_id = 0"),
        F.col("loaded_at") + F.expr("INTERVAL 1 HOUR"),
    )
    return loads.load_history(rows.unionByName(again), NOW)


@query
def stage_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines a peek shows, how many of them are in the files, and of how many folders
    their names may be. Which lines it shows depends on how the files lie."""
    work = work_folder(spark, "stage_peek")
    rows = view.payload_json(spark, sf_dir)
    _write_landing(rows, work)
    seen = json_files.peek(spark, work).select(
        "value", F.regexp_extract("file_name", r"^folder=b(\d)/", 1).cast("int").alias("batch")
    )
    known = rows.select(F.col("raw").alias("value"), F.col("batch_id").alias("batch"))
    matched = seen.join(known.withColumn("_there", F.lit(1)), ["value", "batch"], "left")
    return matched.agg(
        F.count("*").alias("lines"), F.count("_there").alias("lines_of_their_files")
    )


@query
def csv_raw_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of eleven columns into a table of six."""
    work = work_folder(spark, "csv_raw_load")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.csv(work)
    columns = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    ]
    return csv_files.read_csv_raw(spark, work, columns)


@query
def silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three load batches appended one after the other, read back."""
    work = work_folder(spark, "silver_append")
    rows = view.readings(spark, sf_dir)
    for batch, loaded_at in enumerate(view.BATCH_TIMES):
        hourly = silver.silver_hourly(rows.filter(F.col("batch_id") == batch), loaded_at)
        tables.append(hourly, work)
    return _rounded(tables.read_table(spark, work, SILVER), SILVER_FLOATS)


# --- projection, filter, scalar ----------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = view.payload_json(spark, sf_dir)
    return json_files.bronze_rows(json_files.parse_loads(pieces, F.col("loaded_at")))


@query
def variant_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_readings(_bronze(spark, sf_dir)).drop("reading_id", "batch_id")


@query
def try_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("timestamp")
    return view.telemetry(spark, sf_dir).select(
        "reading_id", text.alias("text"), times.try_timestamp(text).alias("reading_time")
    )


@query
def try_cast_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers delivered as text, some of them no numbers, read tolerantly."""
    text = F.when(F.col("reading_id") % 10 == 0, "x").otherwise(F.col("signal_rssi").cast("string"))
    rows = view.telemetry(spark, sf_dir).withColumn("text", text)
    payload = F.parse_json(F.to_json(F.struct("text")))
    return rows.select(
        "reading_id",
        payload_field(payload, "text", "int", on_bad_value="null").alias("from_payload"),
        F.col("text").try_cast("int").alias("from_text"),
    )


@query
def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("reading_time")
    return view.readings(spark, sf_dir).select(
        "reading_id",
        times.hour_bucket(time).alias("hour_bucket"),
        times.day_bucket(time).alias("day_bucket"),
    )


@query
def mask_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view.telemetry(spark, sf_dir).select(
        "reading_id", "file_name", F.col("file_name").alias("engineer_view")
    )
    masked = rules.mask_file_name(rows, "iot_analyst")
    return rules.mask_file_name(masked, "iot_engineer", column="engineer_view")


@query
def freshness_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.freshness_lag(view.silver(spark, sf_dir), "2024-02-01 02:41:59")


@query
def filter_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hour range of one device, from the table stored by day."""
    work = work_folder(spark, "filter_patterns")
    layout.write_silver_layout(view.silver(spark, sf_dir), work)
    rows = tables.read_table(spark, work, SILVER_STORED)
    found = silver.filter_silver(
        rows, "2024-01-05 00:00:00", "2024-01-25 23:00:00", "Factory_A", "dev-001"
    )
    return _rounded(found.select(*SILVER.names), SILVER_FLOATS)


# --- silver and gold ---------------------------------------------------------------


@query
def silver_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(silver.silver_hourly(view.readings(spark, sf_dir), NOW), SILVER_FLOATS)


@query
def silver_alert_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.alert_flags(view.readings(spark, sf_dir))


@query
def silver_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial rows stored batch by batch, added up again to one row per hour."""
    work = work_folder(spark, "silver_compact")
    rows = view.readings(spark, sf_dir)
    for batch in range(len(view.BATCH_TIMES)):
        tables.append(silver.hourly_partials(rows.filter(F.col("batch_id") == batch)), work)
    partials = tables.read_table(spark, work, SILVER_PARTIALS)
    return _rounded(silver.finish_hourly(silver.add_partials(partials), NOW), SILVER_FLOATS)


@query
def silver_compact_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored hourly rows to one per hour, weighted by their record counts."""
    return _rounded(silver.compact_silver(view.silver(spark, sf_dir)), SILVER_FLOATS)


@query
def silver_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.silver_sites(view.silver(spark, sf_dir))


@query
def gold_fleet_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir)


@query
def gold_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_dynamic(view.silver(spark, sf_dir))


@query
def gold_dynamic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declarative form with readings, not silver rows, as the record count."""
    return gold.gold_dynamic(view.silver(spark, sf_dir), count_rows=False)


@query
def gold_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.gold_status(gold.gold_dynamic(view.silver(spark, sf_dir)))


@query
def site_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(gold.site_summary(_gold(spark, sf_dir)), ["avg_temperature"])


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after each load batch was merged in turn."""
    versions_ = view.history(spark, sf_dir)
    target = None
    for batch in range(len(view.BATCH_TIMES)):
        source = versions_.filter(F.col("batch_id") == batch).select(*GOLD.names)
        target = source if target is None else upsert(target, source, GOLD_KEYS)
    return target


@query
def gold_merge_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


@query
def gold_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delta-merged table repaired from the whole silver table."""
    source = gold.gold_rows(view.silver(spark, sf_dir), NOW)
    current = versions.newest(view.history(spark, sf_dir), GOLD_KEYS)
    return upsert(current.select(*GOLD.names), source, GOLD_KEYS)


# --- history and change ------------------------------------------------------------


@query
def as_of_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.at_time(view.history(spark, sf_dir), GOLD_KEYS, "2024-02-01 01:30:00")


@query
def as_of_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.at_offset(view.history(spark, sf_dir), GOLD_KEYS, NOW, 2 * HOUR)


@query
def before_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table before the load of 01:00, that load left out."""
    return versions.before_time(view.history(spark, sf_dir), GOLD_KEYS, view.BATCH_TIMES[1])


@query
def bronze_as_of_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as it was an hour ago."""
    rows = view.telemetry(spark, sf_dir).select("reading_id", "file_name", "loaded_at")
    return changes.rows_until(rows, times.before_by(times.as_ntz(NOW), HOUR))


@query
def bronze_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came into the raw table in the last hour."""
    rows = view.telemetry(spark, sf_dir).select("reading_id", "file_name", "loaded_at")
    return changes.rows_between(rows, times.before_by(times.as_ntz(NOW), HOUR), NOW)


@query
def before_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.before_batch(view.history(spark, sf_dir), GOLD_KEYS, 2)


@query
def restore_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.restore_subset(
        view.history(spark, sf_dir),
        GOLD_KEYS,
        NOW,
        times.before_by(times.as_ntz(NOW), HOUR),
        F.col("site_id") == rules.COLD_SITE,
    )


def _pruned(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    work = work_folder(spark, purpose)
    rows = view.history(spark, sf_dir)
    paths = f"{work}/history", f"{work}/current"
    versions.store_pruned(rows, GOLD_KEYS, "2024-02-01 01:30:00", *paths)
    return work


@query
def prune_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the retention job leaves of the history."""
    work = _pruned(spark, sf_dir, "prune_history")
    stored = tables.read_table(spark, f"{work}/history", GOLD_HISTORY)
    return stored.withColumn("batch_id", F.col("batch_id").cast("int"))


@query
def current_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current table that the retention job stores."""
    work = _pruned(spark, sf_dir, "current_table")
    return tables.read_table(spark, f"{work}/current", GOLD)


@query
def counts_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = times.as_ntz(NOW)
    points = {
        "now": now,
        "1h ago": times.before_by(now, HOUR),
        "6h ago": times.before_by(now, 6 * HOUR),
        "24h ago": times.before_by(now, 24 * HOUR),
    }
    return versions.row_counts_at(view.history(spark, sf_dir), GOLD_KEYS, points)


@query
def report_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_at(view.history(spark, sf_dir), GOLD_KEYS, "2024-02-01 01:30:00")


@query
def version_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts now against just before the batch that came 30 minutes ago."""
    earlier = times.before_by(times.as_ntz(NOW), HOUR // 2)
    delta = changes.version_delta(
        view.history(spark, sf_dir), GOLD_KEYS, "total_alerts", NOW, earlier
    )
    return delta.select(
        "site_id",
        F.col("value_now").alias("alerts_now"),
        F.col("value_before").alias("alerts_30min_ago"),
        "delta",
    )


@query
def changed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = times.before_by(times.as_ntz(NOW), HOUR)
    changed = changes.changed_values(
        view.history(spark, sf_dir), GOLD_KEYS, "avg_temperature", NOW, earlier
    )
    return changed.select(
        "site_id", F.col("value_now").alias("temp_now"), F.col("value_old").alias("temp_old")
    )


@query
def changes_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.changes_between(
        view.history(spark, sf_dir), GOLD_KEYS, METRICS, "2024-02-01 00:30:00", NOW
    )


@query
def version_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the table after the first batch to the table after the last, from which a retired
    site was deleted: inserts, updates and deletes."""
    rows = view.history(spark, sf_dir)
    before = versions.before_batch(rows, GOLD_KEYS, 1)
    after = versions.newest(rows, GOLD_KEYS).filter("site_id <> 'Railway_1'")
    return changes.version_changes(before, after, GOLD_KEYS, METRICS)


@query
def refresh_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a refresh after the last batch changed in the declarative table."""
    rows = view.silver(spark, sf_dir)
    before = gold.gold_dynamic(rows.filter("batch_id < 2"))
    return changes.refresh_stats(before, gold.gold_dynamic(rows))


@query
def stream_rows_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.rows_since(view.silver(spark, sf_dir), "2024-02-01 00:30:00")
    return _rounded(rows.select(*SILVER.names), SILVER_FLOATS)


@query
def has_new_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.has_new_data(view.silver(spark, sf_dir), view.BATCH_TIMES[1])


@query
def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, rows = view.telemetry(spark, sf_dir), view.silver(spark, sf_dir)
    return changes.stream_status(
        {
            "bronze_stream": changes.has_new_data(bronze, view.BATCH_TIMES[2], "loaded_at"),
            "silver_stream": changes.has_new_data(rows, view.BATCH_TIMES[1]),
        }
    )


def _log_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history, in which a site was deleted at 01:30; the last batch brings some hours back."""
    rows = view.history(spark, sf_dir)
    there = versions.at_time(rows, GOLD_KEYS, "2024-02-01 01:30:00")
    gone = there.filter("site_id = 'Railway_1' AND analysis_hour IS NOT NULL")
    dead = versions.tombstones(gone, rows, GOLD_KEYS, "2024-02-01 01:30:00", 10)
    return versions.with_deletes(rows, dead)


@query
def newest_after_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.newest(_log_with_deletes(spark, sf_dir), GOLD_KEYS).select(*GOLD.names)


@query
def net_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts, updates and deletes from the log alone; what came and went in between is none."""
    log = _log_with_deletes(spark, sf_dir)
    return changes.net_changes(log, GOLD_KEYS, METRICS, "2024-02-01 00:30:00", NOW)


@query
def gold_merge_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch merged, its rows of a closed site being deletes."""
    rows = view.history(spark, sf_dir)
    target = versions.before_batch(rows, GOLD_KEYS, 2).select(*GOLD.names)
    source = rows.filter("batch_id = 2").select(*GOLD.names)
    source = source.withColumn("closed", F.col("site_id") == rules.COLD_SITE)
    return merge(target, source, GOLD_KEYS, "closed")


@query
def as_of_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was at 01:30, from versions stored with their intervals."""
    work = work_folder(spark, "as_of_intervals")
    rows = view.history(spark, sf_dir)
    for batch, at in enumerate(view.BATCH_TIMES):
        new = rows.filter(F.col("batch_id") == batch).select(*GOLD.names)
        intervals.add_batch(spark, work, GOLD, new, GOLD_KEYS, at, batch)
    return intervals.at_time(*intervals.read_stored(spark, work, GOLD), "2024-02-01 01:30:00")


def _changed(spark: SparkSession, sf_dir: str) -> maintained.Change:
    """A stored KPI view of two silver batches after a change: the third batch comes, a device is
    removed from the first, and another reads one degree more in the second."""
    work = work_folder(spark, "signed_delta")
    rows = view.silver(spark, sf_dir).select(*SILVER.names, "batch_id")
    rows.write.parquet(f"{work}/silver")
    rows = spark.read.schema(rows.schema).parquet(f"{work}/silver")
    state = []
    for name, table in maintained.maintained(rows.filter("batch_id < 2"))._asdict().items():
        table.write.parquet(f"{work}/{name}")
        state.append(spark.read.schema(table.schema).parquet(f"{work}/{name}"))
    warmer = {c: F.col(c) + 1 for c in ("avg_temperature", "min_temperature", "max_temperature")}
    gone = (F.col("batch_id") == 0) & (F.col("device_id") == "dev-007")
    moved = (F.col("batch_id") == 1) & (F.col("device_id") == "dev-003")
    plus = rows.filter("batch_id = 2").unionByName(rows.filter(moved).withColumns(warmer))
    minus = rows.filter(gone | moved).withColumn("sign", F.lit(-1))
    delta = minus.unionByName(plus.withColumn("sign", F.lit(1)))
    after = rows.filter("batch_id < 2").filter(~gone & ~moved).unionByName(plus)
    return maintained.apply_change(maintained.Maintained(*state), delta, after)


@query
def gold_signed_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI view after a change of inserts, updates and deletes, without a recompute."""
    return maintained.kpis(_changed(spark, sf_dir).view)


@query
def delta_refresh_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many KPI rows the change added and removed, from the touched hours alone."""
    return maintained.change_stats(_changed(spark, sf_dir))


@query
def consume_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver batches 0 and 2 are committed and taken; then batch 1 comes, of an older stamp, and
    is taken by the next step. What each step made of its rows."""
    work = work_folder(spark, "consume_commits")
    rows, paths = view.silver(spark, sf_dir), (f"{work}/silver", f"{work}/sites")

    def step(number: int, batches: list[int]) -> None:
        for batch in batches:
            layers.append_silver(rows.filter(F.col("batch_id") == batch).select(*SILVER.names), paths[0], batch)

        def per_site(new: DataFrame) -> DataFrame:
            return new.groupBy("site_id").agg(
                F.lit(number).alias("step"),
                F.count("*").alias("hourly_rows"),
                F.sum("record_count").alias("records"),
                F.min("load_ts").alias("oldest"),
            )

        commits.consume(spark, *paths, "sites", SILVER, per_site)

    step(1, [0, 2])
    step(2, [1])
    step(3, [])
    schema = "site_id string, step int, hourly_rows bigint, records bigint, oldest timestamp_ntz"
    made = commits.read_committed(spark, paths[1], T.StructType.fromDDL(schema))
    status = commits.has_pending(spark, *paths, "sites")
    return made.drop("commit_id").withColumn("has_data", F.lit(status.first()["has_data"]))


# --- reports -----------------------------------------------------------------------


@query
def kpi_active_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.active_devices(_gold(spark, sf_dir), _latest_hour(spark, sf_dir))


@query
def kpi_total_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.total_alerts(_gold(spark, sf_dir), _latest_hour(spark, sf_dir))


@query
def kpi_avg_uptime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.average_uptime(_gold(spark, sf_dir), _latest_hour(spark, sf_dir))


@query
def kpi_data_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.data_usage(_gold(spark, sf_dir), _latest_hour(spark, sf_dir))


@query
def kpi_avg_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.average_temperature(_gold(spark, sf_dir), _latest_hour(spark, sf_dir))


@query
def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.kpi_cards(_gold(spark, sf_dir), _latest_hour(spark, sf_dir))


@query
def temperature_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.temperature_by_site(_gold(spark, sf_dir))


@query
def alert_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.alert_timeline(_gold(spark, sf_dir))


@query
def alert_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.alert_series(_gold(spark, sf_dir))


@query
def latest_fleet_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        "analysis_hour", "site_id", "active_devices", "avg_temperature", "max_temperature",
        "min_temperature", "avg_humidity", "avg_battery_pct", "total_alerts",
        "alert_temp_count", "alert_humidity_count", "total_records",
    ]
    return reports.latest_metrics(_gold(spark, sf_dir).select(*columns))


@query
def verify_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten newest rows of the merged table with their load times, to check a load by eye."""
    merged = versions.newest(view.history(spark, sf_dir), GOLD_KEYS)
    columns = [*GOLD_KEYS, "active_devices", "avg_temperature", "total_alerts", "loaded_at"]
    return reports.latest_metrics(merged.filter("analysis_hour IS NOT NULL").select(*columns), 10)


@query
def gold_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from partial rows of each batch, added up."""
    rows = view.silver(spark, sf_dir)
    parts = [gold.fleet_partials(rows.filter(F.col("batch_id") == b)) for b in range(3)]
    partials = gold.add_fleet_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return gold.finish_fleet(partials, NOW).drop("loaded_at")


@query
def latest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields shown are taken out of the newest rows only."""
    fields = {"device_id": "string", "site_id": "string", "temperature": "double"}
    rows = _bronze(spark, sf_dir)
    newest = reports.latest_bronze(rows, 5, "reading_id")
    return extract_readings(newest, fields).select(*fields, "loaded_at")


@query
def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.layer_row_counts(
        {
            "bronze": view.telemetry(spark, sf_dir),
            "silver": view.silver(spark, sf_dir),
            "gold": versions.newest(view.history(spark, sf_dir), GOLD_KEYS),
        }
    )


@query
def layer_sync_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view.silver(spark, sf_dir)
    return reports.layer_sync_check(rows, gold.gold_dynamic(rows))


@query
def gold_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = versions.newest(view.history(spark, sf_dir), GOLD_KEYS)
    return reports.gold_compare(gold.gold_dynamic(view.silver(spark, sf_dir)), merged)


@query
def loading_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.loading_status(view.telemetry(spark, sf_dir), view.BATCH_TIMES[1], NOW)


# --- rules -------------------------------------------------------------------------


@query
def zscore_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = anomaly.zscore_anomalies(view.silver(spark, sf_dir))
    return _rounded(scores, ["avg_temperature", "z_score"])


@query
def zscore_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch scored against all history by stored moments, after a device was taken out
    of the first batch. Earlier rows are not read again."""
    work, by = work_folder(spark, "moments"), ["site_id"]
    rows = view.silver(spark, sf_dir)
    total = None
    for batch in range(len(view.BATCH_TIMES)):
        new = moments.moments(rows.filter(F.col("batch_id") == batch), "avg_temperature", by)
        total = new if total is None else moments.added(total, new, by)
        total.write.parquet(f"{work}/after={batch}")
        total = spark.read.schema(total.schema).parquet(f"{work}/after={batch}")
    gone = rows.filter("batch_id = 0 AND device_id = 'dev-007'")
    total = moments.withdrawn(total, moments.moments(gone, "avg_temperature", by), by)
    scores = moments.scored(rows.filter("batch_id = 2"), total)
    return _rounded(scores, ["avg_temperature", "z_score"])


@query
def reconcile_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the table that merges left differs from a recompute, by trees of checksums."""
    columns = ["active_devices", "avg_temperature", "total_alerts", "total_records"]
    merged = versions.newest(view.history(spark, sf_dir).filter("analysis_hour IS NOT NULL"), GOLD_KEYS)
    whole = _gold(spark, sf_dir).filter("analysis_hour IS NOT NULL")
    leaves = [reconcile.checksums(table, columns) for table in (merged, whole)]
    return reconcile.differences(merged, whole, columns, *leaves)


@query
def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.threshold_alerts(_gold(spark, sf_dir), 3)


@query
def cold_chain_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = rules.apply_cold_chain_rule(view.telemetry(spark, sf_dir))
    return checked.select("reading_id", "site_id", "temperature", "alert_type", "alert_severity")


@query
def breach_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of too warm readings per device."""
    return episodes.breach_episodes(view.readings(spark, sf_dir), rules.COLD_LIMIT)


@query
def breach_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings of a month in three batches, the second of them twice: each episode as the
    batches carried it on, and the batch that alerted it."""
    work = work_folder(spark, "breach_alerts")
    rows = view.readings(spark, sf_dir)
    time = F.col("reading_time")
    batch = F.when(time < "2024-01-11", 0).when(time < "2024-01-21", 1).otherwise(2)
    for number in (0, 1, 1, 2):
        episodes.take_batch(spark, work, number, rows.filter(batch == number), rules.COLD_LIMIT)
    return episodes.told_episodes(spark, work)


@query
def reported_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.reported_alerts(view.telemetry(spark, sf_dir))


@query
def reported_alert_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.reported_alert_totals(view.telemetry(spark, sf_dir))


# --- layout ------------------------------------------------------------------------


@query
def silver_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_folder(spark, "silver_layout")
    layout.write_silver_layout(view.silver(spark, sf_dir), work)
    stored = tables.read_table(spark, work, SILVER_STORED)
    return _rounded(stored.select(*SILVER.names, "day"), SILVER_FLOATS)


@query
def gold_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_folder(spark, "gold_layout")
    layout.write_gold_layout(gold.gold_rows(view.silver(spark, sf_dir), NOW), work)
    return tables.read_table(spark, work, GOLD)


@query
def curve_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver stored along a curve, and filters by device, by site and by hour on it."""
    work = work_folder(spark, "curve_filters")
    curve.write_curve_layout(view.silver(spark, sf_dir).select(*SILVER.names), work, SILVER_CURVE)
    stored = tables.read_table(spark, work, SILVER)
    filters = {
        "device": F.col("device_id") == "dev-007",
        "site": F.col("site_id") == "Railway_1",
        "hour": F.col("hour_bucket").between("2024-01-10", "2024-01-11"),
    }
    found = [
        stored.filter(condition).select(F.lit(name).alias("filtered_by"), *SILVER.names)
        for name, condition in filters.items()
    ]
    rows = found[0].unionByName(found[1]).unionByName(found[2])
    return _rounded(rows, SILVER_FLOATS)


@query
def compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after its three batches, all over the same hours, were compacted."""
    work = work_folder(spark, "compacted_silver")
    rows = view.silver(spark, sf_dir)
    for batch in range(len(view.BATCH_TIMES)):
        new = rows.filter(F.col("batch_id") == batch).select(*SILVER.names)
        compaction.append(new, work, str(batch))
    compaction.compact(spark, work, SILVER, ["hour_bucket", "site_id", "device_id"], max_depth=2)
    return _rounded(compaction.read_live(spark, work, SILVER).select(*SILVER.names), SILVER_FLOATS)


@query
def layout_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as they arrive, each device's part of a batch as one file."""
    file = F.concat_ws("/", "device_id", "file_name").alias("file")
    arrived = view.readings(spark, sf_dir).select("site_id", "reading_time", file)
    return layout.layout_health(arrived, [times.day_bucket(F.col("reading_time")), "site_id"])


@query
def layout_health_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of silver stored by day, one file for each day."""
    work = work_folder(spark, "layout_health")
    rows = view.silver(spark, sf_dir).withColumn("day", F.col("hour_bucket").cast("date"))
    rows.repartition("day").write.partitionBy("day").parquet(work)
    stored = layout.with_file(tables.read_table(spark, work, SILVER_STORED))
    return layout.layout_health(stored, ["hour_bucket", "site_id"])


# --- streaming ---------------------------------------------------------------------


def _run_jobs(spark: SparkSession, sf_dir: str, purpose: str, gold_job=None) -> str:
    """Each batch dropped as files and taken through the jobs; the folder of the layers."""
    work = work_folder(spark, purpose)
    rows = view.payload_json(spark, sf_dir)
    for batch, at in enumerate(view.BATCH_TIMES):
        _write_landing(rows.filter(F.col("batch_id") == batch), f"{work}/landing")
        started = jobs.ingest_files(
            spark, f"{work}/landing", f"{work}/loads", f"{work}/ck/loads", "lines", at
        )
        started.awaitTermination()
        jobs.silver_job(
            spark, f"{work}/loads", f"{work}/silver", f"{work}/ck/silver", at
        ).awaitTermination()
        if gold_job is not None:
            gold_job(
                spark, f"{work}/silver", f"{work}/gold", f"{work}/ck/gold", at
            ).awaitTermination()
    return work


@query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _run_jobs(spark, sf_dir, "stream_silver")
    stored = layers.read_silver(spark, f"{work}/silver")
    return _rounded(stored.select(*SILVER.names), SILVER_FLOATS)


@query
def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table the merging job keeps."""
    work = _run_jobs(spark, sf_dir, "stream_gold", jobs.gold_job)
    stored = layers.read_history(spark, f"{work}/gold")
    return versions.newest(stored, GOLD_KEYS).select(*GOLD.names)


@query
def stream_gold_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table the job keeps that computes touched hours again."""
    work = _run_jobs(spark, sf_dir, "stream_gold_full", jobs.gold_refresh_job)
    stored = layers.read_history(spark, f"{work}/gold")
    return versions.newest(stored, GOLD_KEYS, null_safe=True).drop("batch_id", "loaded_at")
