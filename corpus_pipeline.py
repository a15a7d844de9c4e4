"""Corpus pipeline over ``documents``: quality rules, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns the columns of ``documents``; the last one returns packed pieces. ``run``
writes every stage's rows to the shared folder and reads them again, so a lost
executor never reaches further back than its stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, packing, quality, simhash, suffix_array
from strata.llm.common import Scratch, table, text_keys
from strata.llm.repeats import Kind

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Shortest repeated string that goes. 200 bytes are a passage of over 50 words whose words have three letters on average.
PASSAGES = Kind(window=200, gram=80, words=False)


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of ``documents``, with n_chars of the text as it is now."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, without the lines that failed."""
    judged = quality.line_first(docs.select(*COLUMNS))
    return _documents(judged.where("kept").withColumn("text", F.col("clean_text")))


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with a key that only equal rows share: the doc_id (null told apart) and 128 bits of the text."""
    return docs.select(*COLUMNS, F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), *text_keys(F.col("text"))).alias("key"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id; of equal rows, one.

    Documents without a doc_id come last in this order, and are told apart by their text.
    """
    rows = _named(docs)
    found = simhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct()
    return rows.join(kept, "key").dropDuplicates(["key"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated strings of ``PASSAGES.window`` bytes; a document of which no word is left goes.

    A cut inside a character takes the whole character.
    """
    cut = suffix_array.deduplicate(docs.select(*COLUMNS), PASSAGES, whole_characters=True)
    return _documents(cut.withColumn("text", F.col("kept").cast("string")).where("text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    rows = _named(docs)
    leaks = decontaminate.contained(rows.select(F.col("key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(leaks.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    cut = packing.pieces(docs)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", packed),
]
# Tokenising, fingerprints and packing are beyond SQL: the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
