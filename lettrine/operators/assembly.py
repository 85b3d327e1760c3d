"""The values of a document, its nested record, and documents that failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .validation import CHANGED, RULES, _ok


def merged_date(upper: Column, lower: Column) -> Column:
    """Both valid and equal, both valid, one valid, or none."""
    row = lambda v, s, c: F.struct(v.alias("value"), F.lit(s).alias("source"), F.lit(c).alias("confidence"))
    both = _ok(upper) & _ok(lower)
    return F.when(both & (upper["value"] == lower["value"]), row(upper["normalised"], "merged", 1.0)).when(both, row(upper["normalised"], "upper", 0.6)).when(_ok(upper), row(upper["normalised"], "upper", 0.7)).when(_ok(lower), row(lower["normalised"], "lower", 0.7)).otherwise(row(F.lit(None).cast("string"), "upper", 0.0))


def city(upper: Column, lower: Column, upper_score: Column, lower_score: Column) -> Column:
    u, low = F.nullif(upper, F.lit("")), F.nullif(lower, F.lit(""))
    return F.struct(F.coalesce(u, low).alias("value"), F.when(u.isNotNull(), "upper").when(low.isNotNull(), "lower").otherwise("single").alias("source"), F.coalesce(F.when(u.isNotNull(), upper_score).otherwise(lower_score), F.lit(0)).alias("confidence"))


def name_value(name: Column, score: Column) -> Column:
    return F.when(name.isNotNull(), F.struct(F.when(_ok(name), name["value"]).alias("value"), score.alias("confidence"), (~_ok(name) | name["occluded"]).alias("needs_review")))


def rib_value(documents: DataFrame) -> Column:
    r = F.col("rib")
    return F.when(r["digits"].isNotNull(), F.struct(r["digits"].alias("full"), r["bank_code"].alias("bank_code"), r["branch_code"].alias("branch_code"), r["account"].alias("account"), r["key"].alias("key"), r["valid"].alias("key_valid"), F.col("bank_name").alias("bank_name"), F.col("s_rib").cast("double").alias("confidence"), F.col("rib_source").alias("source"), (~r["valid"]).alias("needs_review")))


def amount_value() -> Column:
    a = F.col("amount")
    return F.when(a.isNotNull(), F.struct(a["value"].alias("value"), F.coalesce("t09", F.lit("")).alias("in_words"), F.lit("DT").alias("currency"), F.col("words_match").alias("words_match"), F.col("s_amount").cast("double").alias("confidence"), (~_ok(a)).alias("needs_review")))


def assembled(documents: DataFrame, stamps: DataFrame | None = None, explanations: DataFrame | None = None, runs: DataFrame | None = None, keep: tuple = ()) -> DataFrame:
    """One nested record a document. Optional, by doc_id or as columns of the documents: stamps (n_stamps, and hints and affected_rois if known), explanations, and runs (extracted_at). ``keep``: columns of the documents that stay beside it."""
    c = F.col
    docs = documents
    for table in (stamps, explanations, runs):
        docs = docs.join(table, "doc_id", "left") if table is not None else docs
    absent = {"second_used": F.lit(False), "n_stamps": F.lit(0).cast("long"), "explanation": F.lit(None).cast("string"), "extracted_at": F.lit(None).cast("string"), "hints": F.lit(None).cast("array<string>"), "affected_rois": F.lit(None).cast("array<string>"), **{n: F.lit(0) for n in CHANGED}}
    docs = docs.select("*", *[value.alias(n) for n, value in absent.items() if n not in docs.columns])
    explained = F.when(F.size("flags") > 0, c("explanation"))
    none = F.array().cast("array<string>")
    return docs.select(
        "doc_id",
        F.nullif(c("t01"), F.lit("")).alias("payment_order"),
        "extracted_at",
        merged_date(c("due_u"), c("due_l")).alias("echeance"),
        merged_date(c("made_u"), c("made_l")).alias("creation"),
        city(c("t04"), c("t11"), c("c04"), c("c11")).alias("city"),
        rib_value(docs).alias("rib"),
        amount_value().alias("amount"),
        name_value(c("tireur"), c("c07")).alias("tireur"),
        name_value(c("beneficiary"), c("c08")).alias("beneficiary"),
        name_value(c("drawee"), c("c15")).alias("drawee"),
        F.struct(F.nullif(c("t16"), F.lit("")).alias("value"), F.coalesce(c("c16"), F.lit(0)).alias("confidence"), F.lit("single").alias("source"), (F.coalesce(c("t16"), F.lit("")) == "").alias("needs_review")).alias("domiciliation"),
        F.struct(*[c(r) for r in RULES]).alias("validation"),
        c("confidence").cast("double").alias("confidence"),
        "review",
        F.when(F.coalesce("second_used", F.lit(False)), "qwen_fallback").otherwise("tesseract_only").alias("correction_source"),
        F.struct(*[c(n).cast("int").alias(n) for n in CHANGED]).alias("corrections"),
        F.transform("flags", lambda f: F.struct(f["field"].alias("field"), f["error_type"].alias("error_type"), f["message"].alias("message"), f["hard"].alias("hard"), explained.alias("explanation"))).alias("flags"),
        F.coalesce("n_stamps", F.lit(0)).cast("long").alias("n_stamps"),
        F.struct(F.coalesce("affected_rois", none).alias("affected_rois"), F.coalesce("hints", none).alias("hints")).alias("stamp_info"),
        explained.alias("explanation"),
        *keep,
    )


def failed(errors: DataFrame, record: DataFrame) -> DataFrame:
    """Records of documents that could not be read (doc_id, error, and other columns of a record that are known): no score, review, one hard flag on the pipeline."""
    flag = F.array(F.struct(F.lit("pipeline").alias("field"), F.lit("OCR_ERROR").alias("error_type"), F.col("error").alias("message"), F.lit(True).alias("hard"), F.lit(None).cast("string").alias("explanation")))
    given = {"doc_id": F.col("doc_id"), "confidence": F.lit(0.0), "review": F.lit(True), "flags": flag, "correction_source": F.lit("tesseract_only"), "n_stamps": F.lit(0).cast("long")}
    return errors.select([given.get(f.name, F.col(f.name) if f.name in errors.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in record.schema])


def known_failures(failures: DataFrame) -> DataFrame:
    """doc_id and error, the first in order, of the documents that are named."""
    return failures.where("doc_id is not null").groupBy("doc_id").agg(F.min("error").alias("error"))


def with_failures(documents: DataFrame, failures: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Assembled documents and failed ones (doc_id, error, line): one record for a document that failed, in place of what the rest of its lines gave.

    Of several errors of a document the first in order is told. A failure that names no
    document is a record of its own, so every line that came is in some record.
    With the ``known_failures`` given, documents are those without any of them.
    """
    good = documents
    if known is None:
        known = known_failures(failures)
        good = documents.join(known, "doc_id", "left_anti")
    unknown = failures.where("doc_id is null").select("doc_id", F.concat_ws(": ", "error", F.substring("line", 1, 200)).alias("error"))
    return good.unionByName(failed(known.unionByName(unknown, allowMissingColumns=True), documents))
