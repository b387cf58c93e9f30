"""A training corpus from ``documents``: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``;
the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.llm import chosen_path, decontamination, packing, private_data, word_language
from fleetmeter.operators.running import with_total_before
from fleetmeter.llm.stored import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# A text of which less than this share of the letter n-grams occurs in the learned languages is in
# none of them.
KNOWN_SHARE = 0.5

# The language stage learns its model, which SQL cannot express.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in a language that is none of the learned ones, go. A missing
    language is filled in with the one found. Where no document has a language there is no model
    to judge by, and all stay as they are."""
    model = word_language.train(docs)
    if model is None:
        return docs.select(*COLUMNS)
    found = word_language.identified(docs, model)
    kept = found.where(
        (F.col("lang_pred") != word_language.UNKNOWN) & (F.col("lang_known") >= KNOWN_SHARE)
    )
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def _with_row_ids(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with ``row_id``, one number per id and text, and whether an id repeats. That is
    the id itself, but for ids that have several texts: theirs are numbered after all ids."""
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("of_text"))
    counts = texts.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.min("of_text").alias("low"), F.max("of_text").alias("high")
    )
    repeated = stored(counts.where("n > 1"), "repeated-ids")
    several = repeated.where("low <> high")
    if several.isEmpty():
        return docs.withColumn("row_id", F.col("doc_id").cast("long")), not repeated.isEmpty()
    last = docs.agg(F.max("doc_id")).first()[0]
    pairs = texts.join(several.select("doc_id"), "doc_id", "left_semi").distinct()
    pairs = pairs.orderBy("doc_id", "of_text").withColumn("piece", F.spark_partition_id())
    pairs = stored(pairs.withColumn("one", F.lit(1)).withColumn("every", F.lit(0)), "texts-of-ids")
    numbers = with_total_before(pairs, "every", "piece", ["doc_id", "of_text"], "one", "number")
    numbers = numbers.select("doc_id", "of_text", (F.col("number") + last + 1).alias("_number"))
    joined = docs.select(*COLUMNS).withColumn("of_text", F.xxhash64("text"))
    joined = joined.join(numbers, ["doc_id", "of_text"], "left")
    return joined.withColumn("row_id", F.coalesce("_number", F.col("doc_id").cast("long"))), True


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: that of smallest id, those of ids with
    several texts coming last. Texts count, not ids: where an id has several texts, each that is
    no near copy of another stays. Documents without id cannot be named by a link and stay; of
    repeated rows one stays."""
    rows, repeats = _with_row_ids(docs.select(*COLUMNS))
    groups = chosen_path.jaccard_join(rows.select("row_id", "text"), id_column="row_id")
    dropped = groups.where("class_id <> row_id").select("row_id").distinct()
    kept = rows.join(dropped, "row_id", "left_anti")
    if repeats:
        named = kept.where("row_id IS NOT NULL").dropDuplicates(["row_id"])
        kept = named.union(kept.where("row_id IS NULL"))
    return kept.select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least one word in twenty lies in a benchmark window go; the others
    lose all words that do. What is left of a text may form a new window where words were cut out,
    so cut texts are read again until no window is left; each time they get shorter."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    scanned = decontamination.overlaps(docs.select(*COLUMNS), items)
    # Stored before they are cut: one Python worker a core at a time, and for the few with hits only.
    scanned = stored(scanned.where(~decontamination.contaminated()), "scanned")
    result = scanned.where("overlap_hits = 0").select(*COLUMNS)
    rows = scanned.where("overlap_hits > 0")
    while not rows.isEmpty():
        again = decontamination.overlaps(stored(_cut(rows), "cut"), items)
        rows = stored(again, "cut-scanned")
        result = result.union(rows.where("overlap_hits = 0").select(*COLUMNS))
        rows = rows.where("overlap_hits > 0")
    return result


def _cut(scanned: DataFrame) -> DataFrame:
    """The rows without their window words."""
    cut = decontamination.without_spans(scanned, min_words=1)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities are replaced by surrogates; the number of characters follows the text."""
    made = private_data.with_surrogates(docs.select(*COLUMNS))
    n_chars = F.coalesce(F.length("text").cast("long"), "n_chars")
    return made.withColumn("n_chars", n_chars).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what is left, in sequences of 1024."""
    return packing.packed(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", remove_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", replace_private_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
