"""Queries of the training-data operators over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balls, bpe, centroids, langid, lattice, media, minhash, packing, repeats, secrets, toxicity, vectors, warc
from .sql import ORACLE_SQL
from .tables import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", packing.ids_crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4).select("doc_id", "n_shingles", "component_id", "kept")


def op3_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("train", ~langid.held_out(F.col("doc_id"), 7, 2))
    scored = lattice.score_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return scored.withColumn("held_out", langid.held_out(F.col("doc_id"), 7, 2)).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = secrets.scan(docs, secrets.learn(docs))
    count = lambda kind: F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.listed("base_spans"), 256).alias("base_sha256"), secrets.listed("spans").alias("spans"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.read_media(media.store_texts(table(spark, sf_dir, "documents")))
    return read.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


#: In the chain's order. The labels give these two; bad writing is known first and feeds the toxic model.
TOXIC = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
#: Missing a toxic document costs more than looking at a clean one.
TOXIC_FROM = 0.3


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = toxicity.learn(docs, table(spark, sf_dir, "labels"), TOXIC)
    return toxicity.score(docs, models, TOXIC).withColumn("toxic", F.col("p_toxic") >= TOXIC_FROM)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 4, 2))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), langid.learn(docs.where("not held_out")))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = balls.coded(table(spark, sf_dir, "embeddings"))
    numbers = [str(c) for r in sorted(books.collect()) for c in r["centre"]]  # parts x entries x width, all of them parameters but the width
    digest = F.sha2(F.lit(",".join(numbers)), 256)
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return balls.label_errors(codes).select("vec_id", code.alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centres = centroids.clustered(table(spark, sf_dir, "embeddings"))
    named = centres.select("cluster", F.col("inertia").alias("cluster_inertia"), F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))
    whole = centres.agg(F.sum("inertia").alias("inertia"))
    return assigned.join(F.broadcast(named.crossJoin(whole)), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


QUERIES = {f.__name__: f for f in (op1_packing, op2_minhash, op3_lattice_likelihood, op4_byte_bpe, op5_secrets, op6_media, op7_toxicity, op8_language_id, op9_vectors, op10_repeats, op11_ball_codes, op12_warc, op13_centroids)}

__all__ = ["ORACLE_SQL", "QUERIES"]
