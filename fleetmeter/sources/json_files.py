"""Raw JSON files to bronze rows.

A file may hold a JSON array of readings, one object, or one object per line. Files are read
whole, each as one document, or by lines, which is the layout for large input: lines of one
file are shared by many tasks.

Nothing is lost without notice. The JSON functions of Spark read one document and ignore
what follows it; here text after the document, such as a second one, makes the whole piece
bad. A bad piece goes to quarantine with its text, for example a file of lines that was
read whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.functions.times import TimeLike, as_ntz, utc_now
from fleetmeter.schemas import BRONZE, LOADS

BAD_JSON = "not valid JSON"

# Put behind a document to see that the parser got there.
_END = "~end of document~"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
FULL_PATH = "_metadata.file_path"
LAYOUTS = ("whole", "lines")


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    layout: str = "whole",
    stream: bool = False,
    only: Sequence[str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Pieces of raw text with the name of their file: ``(raw, file_name)``.

    ``whole`` reads each file as one document in one task, ``lines`` one document per line.
    Folders are read with all that is below them. A file is named by its path below the folder,
    so equal names in different subfolders are different files. ``only`` keeps the files of
    these full paths, and the others are not opened. A stream takes at most ``max_files`` new
    files into one batch; the others wait for the next.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    reader = (spark.readStream if stream else spark.read).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    text = reader.text(path, wholetext=layout == "whole")
    if only is not None:
        text = text.filter(F.col(FULL_PATH).isin(list(only)))
    pieces = text.select(F.col("value").alias("raw"), file_name(spark, path).alias("file_name"))
    return pieces.filter(F.col("raw").isNotNull() & F.col("raw").rlike(r"\S"))


def file_name(spark: SparkSession, path: str | Sequence[str], full_path: str = FULL_PATH) -> Column:
    """The path of a row's file below the folder that was read; the last part for a single
    file, the full path for a file that a pattern named."""
    own = F.regexp_replace(F.col(full_path), "^[^:/]+:(//[^/]*)?", "")
    own = F.url_decode(F.replace(own, F.lit("+"), F.lit("%2B")))
    name = own
    for given in [path] if isinstance(path, str) else path:
        folder = spark._jvm.org.apache.hadoop.fs.Path(given)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        base = files.makeQualified(folder).toUri().getPath().rstrip("/")
        below = F.substr(own, F.lit(len(base) + 2))
        name = (
            F.when(own.startswith(base + "/"), below)
            .when(own == base, F.lit(base.rsplit("/", 1)[-1]))
            .otherwise(name)
        )
    return name


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file_name, full_path)`` of all files, none of which is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = reader.load(path)
    return listed.select(file_name(spark, path).alias("file_name"), F.col(FULL_PATH).alias("full_path"))


def parse_loads(pieces: DataFrame, loaded_at: TimeLike | None = None) -> DataFrame:
    """Pieces of text to load rows: one per object, and one per piece that is not JSON.

    Arrays are opened, so that each element is a row. Bad pieces keep their text and get
    an error; the load goes on without them. ``loaded_at`` may be a column of ``pieces``.
    """
    raw = F.col("raw")
    stamp = utc_now() if loaded_at is None else as_ntz(loaded_at)
    read = pieces.withColumn("_parts", _parts(raw))
    documents = read.select(*pieces.columns, _document(F.col("_parts")).alias("_document"))
    opened = documents.select(
        *pieces.columns, F.explode(_elements(F.col("_document"))).alias("json_data")
    )
    ok = F.col("json_data").isNotNull()
    return opened.select(
        "json_data",
        F.when(~ok, raw).alias("raw"),
        F.when(~ok, F.lit(BAD_JSON)).alias("error"),
        "file_name",
        stamp.alias("loaded_at"),
        ok.alias("ok"),
        *[c for c in pieces.columns if c not in LOADS.names],
    )


def with_document(texts: DataFrame, raw: Column) -> DataFrame:
    """``texts`` with ``json_data``, the document that ``raw`` is, NULL for anything else. Arrays
    stay closed. A filter on the result parses again, unless it is stored before."""
    read = texts.withColumn("_parts", _parts(raw))
    return read.select(*texts.columns, _document(F.col("_parts")).alias("json_data"))


def _parts(raw: Column) -> Column:
    """The document and the end mark behind it, read as one array."""
    return F.from_json(F.concat(F.lit("["), raw, F.lit(f',"{_END}"]')), "array<variant>", _STRICT)


def _document(parts: Column) -> Column:
    """The document, NULL unless the end mark comes directly after it."""
    at_end = F.try_variant_get(F.get(parts, F.lit(1)), "$", "string") == _END
    return F.when((F.size(parts) == 2) & at_end, F.get(parts, F.lit(0)))


def _elements(document: Column) -> Column:
    """The elements of an array, or the document itself as the only one."""
    return F.coalesce(F.try_variant_get(document, "$", "array<variant>"), F.array(document))


def bronze_rows(loads: DataFrame) -> DataFrame:
    """The good rows of a load, with any columns passed along."""
    kept = [c for c in loads.columns if c not in ("raw", "error", "ok")]
    return loads.filter("ok").select(*kept)


def quarantine_rows(loads: DataFrame) -> DataFrame:
    """The rows set aside: text, error, file and time."""
    kept = [c for c in loads.columns if c not in ("json_data", "ok")]
    return loads.filter(~F.col("ok")).select(*kept)


def read_bronze(
    spark: SparkSession,
    path: str | Sequence[str],
    layout: str = "whole",
    loaded_at: TimeLike | None = None,
) -> DataFrame:
    """Bronze rows of JSON files, bad pieces left out."""
    loads = parse_loads(read_raw(spark, path, layout), loaded_at)
    return bronze_rows(loads).select(*BRONZE.names)


def peek(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """A few raw lines with the name of their file, to look at files before loading."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select("value", file_name(spark, path).alias("file_name")).limit(n)
