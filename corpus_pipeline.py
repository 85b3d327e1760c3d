"""The corpus pipeline: language ID, near-dedup, suffix-array dedup, secret scans, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. All but the last return the columns of documents, with n_chars brought up
to date where a text changes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettrine.llm import langid, minhash, packing, repeats, secrets, tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # tested against brute force instead


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without a letter, or whose margin is narrow, go. lang keeps its label."""
    return langid.identify(docs, langid.learn(docs)).where("accepted").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id; of repeated rows one.

    Rows of one doc_id with texts that aren't near each other all stay, and so do documents without doc_id.
    """
    kept = minhash.near_duplicates(docs).where("chosen and doc_id is not null").select("doc_id", "row").distinct()
    known = docs.where("doc_id is not null").select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row"))
    return known.join(kept, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"]).select(COLUMNS).union(docs.where("doc_id is null").select(COLUMNS))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that occur twice are taken out of the texts; characters cut in half go whole."""
    hit = F.size("removed") > 0
    cut = repeats.cut(docs.select(COLUMNS), whole_characters=True).withColumn("text", F.when(hit, F.col("kept").cast("string")).otherwise(F.col("text")))
    return cut.withColumn("n_chars", F.when(hit, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the documents stay. A null text has none and stays null; repeated rows are masked alike."""
    scanned = secrets.scan(docs, secrets.learn(docs))
    hit = F.size("spans") > 0
    text = F.when(hit, secrets.masked("text", "spans")).otherwise(F.col("text"))
    return scanned.withColumn("text", text).withColumn("n_chars", F.when(hit, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, with their ids, in sequences and step groups. A null text is an end alone; repeated rows are packed each."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("secret_scan", secret_scan), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus; between the stages rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tables.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
