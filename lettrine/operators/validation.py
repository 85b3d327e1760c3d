"""Whole documents: one row each, parsed fields, cross-field rules, flags and scores."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrine.functions import parsing as P
from lettrine.sources.catalogues import ROI_IDS

SCORE = "decimal(9,4)"
REVIEW_BELOW = "0.85"
FLAG = "struct<seq:int,field:string,error_type:string,message:string,hard:boolean>"
RULES = ["rib_key_valid", "rib_consistent", "amount_consistent", "words_match", "echeance_consistent", "creation_consistent", "due_after_creation", "bank_matches", "order_matches"]


#: Regions whose digits the second engine may change, by what an audit counts them as.
CHANGED = {"rib_changed": ("R05", "R14"), "amount_changed": ("R06", "R10"), "dates_changed": ("R02", "R03", "R12", "R13")}


def wide(resolved: DataFrame) -> DataFrame:
    """One row a document: text tNN and score cNN of every region, NULL where it is absent, second_used, whether one is the second engine's, and the digits CHANGED by it.

    Takes one reading a region, as rows or as an array ``cells``. The cells of a document are gathered once and
    looked up by region, so the region list costs no job and no second shuffle.
    """
    if "cells" in resolved.columns:
        docs = resolved.select("doc_id", F.map_from_entries(F.transform("cells", lambda x: F.struct(x["roi_id"].alias("roi_id"), F.struct(*[x[n].alias(n) for n in ("text", "score", "source", "changed")]).alias("cell")))).alias("cells"))
    else:
        given = lambda c, kind: F.col(c) if c in resolved.columns else F.lit(None).cast(kind)
        cells = F.map_from_entries(F.collect_list(F.struct("roi_id", F.struct("text", "score", given("source", "string").alias("source"), given("changed", "int").alias("changed")))))
        docs = resolved.groupBy("doc_id").agg(cells.alias("cells"))
    return _wide(docs, lambda r: F.try_element_at("cells", F.lit(r)), F.exists(F.map_values("cells"), lambda x: F.coalesce(x["source"] == "qwen", F.lit(False))))


def wide_columns(resolved: DataFrame) -> DataFrame:
    """``wide`` of ``reading.resolved_columns``: one column a region, NULL or missing where it is absent."""
    none = F.lit(None).cast("struct<text:string,score:decimal(9,4),source:string,changed:int>")
    cell = lambda r: F.col(r) if r in resolved.columns else none
    used = functools.reduce(operator.or_, [F.coalesce(F.col(r)["source"] == "qwen", F.lit(False)) for r in ROI_IDS if r in resolved.columns], F.lit(False))
    return _wide(resolved, cell, used)


def _wide(docs: DataFrame, cell, used: Column) -> DataFrame:
    changes = [sum((F.coalesce(cell(r)["changed"], F.lit(0)) for r in ids), F.lit(0)).alias(n) for n, ids in CHANGED.items()]
    kept = [c for c in docs.columns if c not in (*ROI_IDS, "cells")]
    return docs.select(*kept, *[cell(r)[k].alias(f"{n}{r[1:]}") for r in ROI_IDS for k, n in (("text", "t"), ("score", "c"))], used.alias("second_used"), *changes)


def parsed(documents: DataFrame, *rois: str) -> DataFrame:
    """Adds a struct for each parsed field; NULL means absent, valid = false means it doesn't parse.

    With a few regions named their fields are parsed step by step (``parsing.parsed``). Of all fields that makes so
    many columns that planning takes most of a minute, so the others are an expression each.
    """
    kinds = {P.RIB: {"rib_u": "t05", "rib_l": "t14"}, P.AMOUNT_STEPS: {"amt_u": "t06", "amt_l": "t10"}, P.WORDS: {"words": "t09"}, P.DATE: {"due_u": "t02", "due_l": "t13", "made_u": "t03", "made_l": "t12"}, P.NAME: {"tireur": "t07", "beneficiary": "t08", "drawee": "t15"}}
    fields = {n: (steps, c) for steps, fields in kinds.items() for n, c in fields.items()}
    here = {n: f for n, f in fields.items() if f"R{f[1][1:]}" in rois}
    docs = P.parsed(documents, here) if here else documents
    return docs.select(*documents.columns, *[F.col(n) if n in here else P.composed(F.col(c), steps).alias(n) for n, (steps, c) in fields.items()])


def _ok(x: Column) -> Column:
    return F.coalesce(x["valid"], F.lit(False))


def bank_names(banks: DataFrame) -> DataFrame:
    """The catalogue as one row with a map, ``banks``, of names by code."""
    return banks.groupBy("code").agg(F.max("bank_name").alias("bank_name")).agg(F.map_from_entries(F.collect_list(F.struct("code", "bank_name"))).alias("banks"))


def best(documents: DataFrame, banks: DataFrame | None) -> DataFrame:
    """Adds the reading to go by of doubled fields, and the bank's name. Without a catalogue documents bring ``bank_names``."""
    u, low = F.col("rib_u"), F.col("rib_l")
    readable = lambda r: r.isNotNull() & ~r["unread"]
    rib = F.when(_ok(u), u).when(_ok(low), low).when(readable(u), u).when(readable(low), low).otherwise(u)
    source = F.when(_ok(u) & _ok(low), "merged").when(_ok(u), "upper").when(_ok(low), "lower").when(readable(u), "upper").when(readable(low), "lower").otherwise("upper")
    amount = F.when(_ok(F.col("amt_u")), F.col("amt_u")).otherwise(F.col("amt_l"))
    docs = documents.select("*", rib.alias("rib"), source.alias("rib_source"), amount.alias("amount"), F.coalesce("due_u", "due_l").alias("due"), F.coalesce("made_u", "made_l").alias("made"))
    code = F.coalesce("rib", "rib_u", "rib_l")["bank_code"]
    if banks is None:
        return docs.select("*", F.try_element_at("banks", code).alias("bank_name")).drop("banks")
    return docs.join(F.broadcast(banks), code == F.col("code"), "left").drop("code")


def checked(documents: DataFrame) -> DataFrame:
    """Adds the outcome of each rule and the array of flags."""
    c = F.col
    u, low = c("rib_u"), c("rib_l")
    dates_known = _ok(c("due")) & _ok(c("made"))
    rib = F.coalesce("rib", "rib_u", "rib_l")
    bare = lambda x: F.regexp_replace(x, "^0+", "")
    # Rules and flags both name these: as columns each is worked out once.
    shared = {
        "both_clean_": F.coalesce(u["digits"].isNotNull() & low["digits"].isNotNull() & ~u["unread"] & ~low["unread"], F.lit(False)),
        "same_rib_": F.coalesce(u["digits"] == low["digits"], F.lit(False)),
        "amt_ok_": _ok(c("amt_u")) & _ok(c("amt_l")),
        "amt_same_": P.amounts_equal(c("amt_u"), c("amt_l")),
        "words_known_": _ok(c("amount")) & _ok(c("words")),
        "words_same_": P.amounts_equal(c("amount"), c("words")),
        "due_same_": P.dates_equal(c("due_u"), c("due_l")),
        "made_same_": P.dates_equal(c("made_u"), c("made_l")),
        "in_order_": P.date_on_or_after(c("due"), c("made")),
        "bank_known_": F.coalesce(rib["bank_code"].isNotNull() & ~rib["unread"] & (c("t16") != ""), F.lit(False)),
        "bank_same_": F.coalesce(F.contains(F.lower("t16"), F.lower("bank_name")), F.lit(False)),
        **{n: F.regexp_replace(c(t), f"{P.SPACE}", "") for n, t in (("po_", "t01"), ("bc_", "t17"))},
    }
    docs = documents.select("*", *[value.alias(n) for n, value in shared.items()])
    docs = docs.select("*", F.coalesce((c("po_") == c("bc_")) | (bare(c("po_")) == bare(c("bc_"))), F.lit(False)).alias("order_same_"))
    both_clean, same_rib, amt_ok, amt_same, words_known, words_same, due_same, made_same, in_order, bank_known, bank_same, po, bc = (c(n) for n in shared)
    order_same = c("order_same_")
    any_rib = u.isNotNull() | low.isNotNull()
    key = _ok(u) | _ok(low)
    both_rib, both_amt = u.isNotNull() & low.isNotNull(), c("amt_u").isNotNull() & c("amt_l").isNotNull()
    orders_known = F.coalesce((c("t01") != "") & (c("t17") != ""), F.lit(False))
    unread = F.coalesce(u["unread"] | low["unread"], F.lit(False))
    outcomes = [key, F.when(both_clean, same_rib).otherwise(both_rib & key), amt_ok & amt_same, words_known & words_same, due_same, made_same, dates_known & in_order, bank_known & bank_same, orders_known & order_same]

    def flag(seq: int, when: Column, field: str, kind: str, message: Column | str, hard: bool) -> Column:
        text = F.lit(message) if isinstance(message, str) else message
        return F.when(when, F.array(F.struct(F.lit(seq).alias("seq"), F.lit(field).alias("field"), F.lit(kind).alias("error_type"), text.alias("message"), F.lit(hard).alias("hard")))).otherwise(F.array().cast(f"array<{FLAG}>"))

    differ = lambda what, a, b: F.concat(F.lit(f"Upper {what} '"), a, F.lit("' differs from lower '"), b, F.lit("'"))
    flags = F.concat(
        flag(1, any_rib & ~key, "rib", "VALIDATION_ERROR", "check key failed on both readings", True),
        flag(2, both_clean & ~same_rib, "rib", "INCONSISTENCY", differ("rib", u["digits"], low["digits"]), True),
        flag(3, both_rib & ~both_clean & unread, "rib", "STAMP_OCCLUSION", "unreadable positions, comparison skipped", False),
        flag(4, both_amt & amt_ok & ~amt_same, "amount", "INCONSISTENCY", differ("amount", c("amt_u")["normalised"], c("amt_l")["normalised"]), True),
        flag(5, both_amt & ~_ok(c("amt_u")), "amount_upper", "FORMAT_ERROR", F.concat(F.lit("upper amount: "), c("amt_u")["error"]), False),
        flag(6, both_amt & ~_ok(c("amt_l")), "amount_lower", "FORMAT_ERROR", F.concat(F.lit("lower amount: "), c("amt_l")["error"]), False),
        flag(7, words_known & ~words_same, "amount", "INCONSISTENCY", "amount in figures differs from words", False),
        flag(8, _ok(c("due_u")) & _ok(c("due_l")) & ~due_same, "echeance", "INCONSISTENCY", differ("due date", c("due_u")["normalised"], c("due_l")["normalised"]), True),
        flag(9, _ok(c("made_u")) & _ok(c("made_l")) & ~made_same, "creation_date", "INCONSISTENCY", differ("creation date", c("made_u")["normalised"], c("made_l")["normalised"]), True),
        flag(10, dates_known & ~in_order, "echeance", "VALIDATION_ERROR", "due before creation", False),
        flag(11, bank_known & ~bank_same, "rib", "VALIDATION_ERROR", "bank not in domiciliation", False),
        flag(12, orders_known & ~order_same, "payment_order", "INCONSISTENCY", F.concat(F.lit("payment order '"), po, F.lit("' differs from barcode '"), bc, F.lit("'")), True),
    )
    return docs.select(*documents.columns, *[o.alias(n) for n, o in zip(RULES, outcomes)], flags.alias("flags"))


def scored(documents: DataFrame) -> DataFrame:
    """Adds field scores, the document's and whether it needs review, all in exact decimals."""
    d = lambda x: F.lit(x).cast(SCORE)
    engine = lambda name: F.coalesce(F.col(name), d("0.5"))

    def score(sure: Column, redundant: Column, good: Column, engine_score: Column) -> Column:
        agree = F.when(sure, d("0.4")).otherwise(d("0.12"))
        return (agree + redundant + F.when(good, d("0.2")).otherwise(d("0")) + (engine_score * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(9,5)")).cast("decimal(9,5)")

    redundancy = lambda same: F.when(F.col(same), d("0.3")).otherwise(d("0.15"))
    good = lambda name: _ok(F.col(name))
    any_rib = F.col("rib_u").isNotNull() | F.col("rib_l").isNotNull()
    docs = documents.select(
        "*",
        score(F.col("rib_key_valid"), F.when(F.col("rib_consistent"), d("0.3")).when(any_rib, d("0.15")).otherwise(d("0")), _ok(F.coalesce("rib", "rib_u", "rib_l")), engine("c05")).alias("s_rib"),
        score(good("amount"), redundancy("amount_consistent"), good("amount"), engine("c06")).alias("s_amount"),
        score(good("due"), redundancy("echeance_consistent"), good("due"), engine("c02")).alias("s_due"),
        score(good("made"), redundancy("creation_consistent"), good("made"), engine("c03")).alias("s_made"),
        F.size(F.filter("flags", lambda f: f["hard"])).alias("n_hard"),
        F.size(F.filter("flags", lambda f: ~f["hard"])).alias("n_soft"),
    )
    docs = docs.withColumn("confidence", F.least("s_rib", "s_amount", "s_due", "s_made"))
    return docs.withColumn("review", (F.col("n_hard") > 0) | (F.col("confidence") < F.lit(REVIEW_BELOW).cast("decimal(9,5)")))


def validated(resolved: DataFrame, banks: DataFrame) -> DataFrame:
    return scored(checked(best(parsed(wide(resolved)), banks)))


def validated_columns(resolved: DataFrame) -> DataFrame:
    """``validated`` of ``reading.resolved_columns``, which bring ``bank_names``: projections alone, and other columns stay."""
    return scored(checked(best(parsed(wide_columns(resolved), *ROI_IDS), None)))


def chosen(rows: DataFrame, holds) -> DataFrame:
    """The rows whose columns, as a struct, ``holds`` is true of: by a generator, as under a filter the planner infers more of them and writes out all that the columns are made of."""
    return rows.select(F.inline(F.filter(F.array(F.struct(*rows.columns)), holds)))


def flag_rows(documents: DataFrame) -> DataFrame:
    """One row a flag. Of a bare column the generator would infer a filter, into which the planner writes all that flags are made of."""
    return documents.select("doc_id", F.explode(F.array_compact("flags")).alias("f")).select("doc_id", "f.seq", "f.field", "f.error_type", "f.message", "f.hard")
