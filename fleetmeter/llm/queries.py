"""The registered queries of this folder: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.llm import (
    additive_quality,
    block_rules,
    chosen_path,
    decontamination,
    filter_audit,
    multiset_hash,
    packing,
    private_data,
    role_repair,
    source_mix,
    url_filter,
    weighted_tree,
    word_language,
)
from fleetmeter.llm.stored import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the url of every page."""
    pages = url_filter.judged(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return pages.drop("url")


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards, and where it would be with one more."""
    placed = weighted_tree.sharded(_table(spark, sf_dir, "documents"), 16)
    return placed.withColumn("law", F.lit("key"))


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: five-word shingles, Jaccard 0.8 or more."""
    return chosen_path.jaccard_join(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of every text and of its edited text, and what they share."""
    made = multiset_hash.fingerprinted(_table(spark, sf_dir, "documents"))
    vector = F.col("vector")
    return made.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        multiset_hash.hex_of(vector).alias("fingerprint"),
        multiset_hash.hex_of(F.col("edited_vector")).alias("edited_fingerprint"),
        multiset_hash.likeness(vector, F.col("edited_vector")).alias("near_edited"),
        multiset_hash.likeness(vector, F.col("next_vector")).alias("near_next"),
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens of all documents in sequences of 1024."""
    return packing.packed(_table(spark, sf_dir, "documents"))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = block_rules.extracted(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return private_data.with_surrogates(documents).select(
        "doc_id",
        "text",
        F.size("pii").cast("long").alias("n_entities"),
        F.array_sort(F.array_distinct("pii.kind")).alias("kinds"),
    )


def held_out(key: str, parts: int, part: int) -> Column:
    """Rows that no model may learn from: by the checksum of their id as text."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == part, F.lit(False))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    documents = documents.withColumn("held_out", held_out("doc_id", 4, 2))
    model = word_language.train(documents.where("not held_out"))
    found = word_language.identified(documents.drop("lang"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labels of four fifths of them."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    documents = documents.withColumn("held_out", held_out("doc_id", 5, 0))
    measured = stored(additive_quality.with_statistics(documents), "statistics")
    labels = _table(spark, sf_dir, "labels")
    model = additive_quality.train(measured.where("not held_out"), labels)
    found = additive_quality.scored(measured, model)
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every document."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontamination.overlaps(documents, _table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id",
        F.col("overlap_words").alias("n_words"),
        F.col("overlap_hits").alias("n_hit"),
        F.size("overlap_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "overlap_items"), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faults of every damaged conversation and its cheapest repair."""
    return role_repair.repairs(_table(spark, sf_dir, "conversations"))


@query
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix by weighted sources takes."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mix = source_mix.taken(source_mix.mixed(documents))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query
def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every part of the documents, in all 120 orders."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audited(documents, _table(spark, sf_dir, "labels"))
