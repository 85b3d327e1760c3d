"""Queries over whole documents: rules, flags, scores and assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettrine.operators import assembly as A
from lettrine.operators import audit as U
from lettrine.operators import geometry as G
from lettrine.operators import reading as R
from lettrine.operators import validation as V
from lettrine.sources import catalogues, fixtures, ingest, shared

from . import duck


def merged_readings(spark, sf_dir, *rois):
    """One reading a region, of all or of those named: both engines' and the decoder's, merged; an array a document."""
    return R.resolved_documents(fixtures.reading_sets(spark, sf_dir, *rois), catalogues.regions(spark, *rois), whole=True)


def merged_columns(spark, sf_dir, *rois, beside=()):
    """The same as a column a region; and the columns of the tables ``beside``, by doc_id."""
    return R.resolved_columns(fixtures.reading_columns(spark, sf_dir, *rois, beside=beside), catalogues.ROUTES)


#: Regions that a rule or value looks at, where that isn't all of them.
RIB, AMOUNT, DUE, MADE = ("R05", "R14"), ("R06", "R10"), ("R02", "R13"), ("R03", "R12")


def documents(spark, sf_dir, *rois, beside=()):
    """Validated documents; with regions named only what these make is right. Columns of the tables ``beside`` (by doc_id) are theirs too."""
    return V.validated_columns(merged_columns(spark, sf_dir, *rois, beside=(*beside, V.bank_names(catalogues.banks(spark)))))


def documents_of_arrays(spark, sf_dir):
    """The same by arrays, for queries that join or filter what is made of it: there the planner infers filters from all columns."""
    return V.validated(merged_readings(spark, sf_dir), catalogues.banks(spark))


def _beside(spark, sf_dir, *columns):
    """Stamps, explanations and runs by document, and of runs also the named columns."""
    stamps = G.stamp_info(G.score_stamps(fixtures.stamps(spark, sf_dir)), G.boxes(fixtures.pages(spark, sf_dir), catalogues.regions(spark), padded=False))
    return stamps, fixtures.explanations(spark, sf_dir), fixtures.runs(spark, sf_dir).select("doc_id", "extracted_at", *columns)


def assembled(spark, sf_dir, beside=(), keep=(), runs=()):
    """Assembled documents. ``keep`` is kept of the tables ``beside``, and so are the columns ``runs`` of the runs."""
    return A.assembled(documents(spark, sf_dir, beside=(*_beside(spark, sf_dir, *runs), *beside)), keep=(*keep, *runs))


def arrived(spark, sf_dir):
    """(documents with their readings, failures) of the lines as they arrive, parsed once and kept in the shared folder."""
    return ingest.split_documents(shared.stored(ingest.without_good_text(ingest.line_outcomes(fixtures.arrived_lines(spark, sf_dir))), "outcomes"))


def batch(spark, sf_dir, lines=None, beside=None):
    """Assembled documents, and records of those with lines that could not be read, of ``lines`` that have arrived; the columns of ``beside`` (by doc_id) are both kinds'."""
    good, failures = lines or arrived(spark, sf_dir)
    known = A.known_failures(failures)
    tables = [beside] if beside is not None else []
    columns = R.set_columns(good.join(known, "doc_id", "left_anti"), catalogues.ROUTES, fixtures.parts(spark, sf_dir), (*_beside(spark, sf_dir), *tables, V.bank_names(catalogues.banks(spark))))
    documents_ = A.assembled(V.validated_columns(R.resolved_columns(columns, catalogues.ROUTES, sure=True)), keep=tuple(c for t in tables for c in t.columns if c != "doc_id"))
    for table in tables:
        known = known.join(table, "doc_id", "left")
    return A.with_failures(documents_, failures, known)


def review_by_bank(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.groupBy("bank_name").agg(F.count("*").alias("bills"), F.count_if(~F.col("rib_key_valid")).alias("bad_keys"), F.count_if("review").alias("to_review"))


def e1_wide(spark, sf_dir):
    w = V.wide_columns(merged_columns(spark, sf_dir))
    return w.select("doc_id", *[f"t{r[1:]}" for r in catalogues.ROI_IDS], *[F.col(f"c{r[1:]}").cast("double").alias(f"c{r[1:]}") for r in catalogues.ROI_IDS])


def e2_best_rib(spark, sf_dir):
    return documents(spark, sf_dir, *RIB).select("doc_id", F.col("rib.digits").alias("rib"), F.col("rib_source").alias("source"))


_RULE_REGIONS = {"rib_key_valid": RIB, "rib_consistent": RIB, "amount_consistent": AMOUNT, "words_match": (*AMOUNT, "R09"), "echeance_consistent": DUE, "creation_consistent": MADE, "due_after_creation": (*DUE, *MADE), "bank_matches": (*RIB, "R16"), "order_matches": ("R01", "R17")}


def _rule(name, *rules):
    def query(spark, sf_dir):
        return documents(spark, sf_dir, *sorted({roi for r in rules for roi in _RULE_REGIONS[r]})).select("doc_id", *rules)

    query.__name__ = name
    return query, V_ + f"SELECT doc_id, {', '.join(rules)} FROM k"


def e12_flags(spark, sf_dir):
    return V.flag_rows(documents(spark, sf_dir))


def e13_field_scores(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", *[F.col(c).cast("double").alias(c) for c in ("s_rib", "s_amount", "s_due", "s_made")])


def e14_document_score(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.col("confidence").cast("double").alias("confidence"))


def e15_review(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", "n_hard", "n_soft", "review")


def e16_merged_dates(spark, sf_dir):
    d = documents(spark, sf_dir, *DUE, *MADE).select("doc_id", A.merged_date(F.col("due_u"), F.col("due_l")).alias("d"), A.merged_date(F.col("made_u"), F.col("made_l")).alias("m"))
    return d.select("doc_id", F.col("d.value").alias("due"), F.col("d.source").alias("due_source"), F.col("d.confidence").alias("due_score"), F.col("m.value").alias("made"), F.col("m.source").alias("made_source"), F.col("m.confidence").alias("made_score"))


def e17_amount_value(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", A.amount_value().alias("a")).select("doc_id", F.col("a.value").cast("double").alias("value"), F.col("a.in_words").alias("in_words"), F.col("a.currency").alias("currency"), F.col("a.words_match").alias("words_match"), F.col("a.needs_review").alias("needs_review"))


def e18_rib_value(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", A.rib_value(d).alias("r")).select("doc_id", "r.full", "r.bank_code", "r.key_valid", "r.bank_name", "r.confidence", "r.source", "r.needs_review")


def e19_city(spark, sf_dir):
    c = A.city(F.col("t04"), F.col("t11"), F.col("c04"), F.col("c11"))
    return V.wide_columns(merged_columns(spark, sf_dir, "R04", "R11")).select("doc_id", c.alias("c")).select("doc_id", "c.value", "c.source", F.col("c.confidence").cast("double").alias("confidence"))


def e20_names(spark, sf_dir):
    d = V.parsed(V.wide_columns(merged_columns(spark, sf_dir, "R07", "R08", "R15")))
    rows = F.array(*[F.struct(F.lit(n).alias("who"), A.name_value(F.col(n), F.col(c)).alias("v")) for n, c in (("tireur", "c07"), ("beneficiary", "c08"), ("drawee", "c15"))])
    return d.select("doc_id", F.inline(rows)).select("doc_id", "who", "v.value", F.col("v.confidence").cast("double").alias("confidence"), "v.needs_review")


def e21_texts(spark, sf_dir):
    d = assembled(spark, sf_dir)
    return d.select("doc_id", "payment_order", F.col("domiciliation.value").alias("domiciliation"), F.col("domiciliation.confidence").cast("double").alias("confidence"), F.col("domiciliation.source").alias("source"), F.col("domiciliation.needs_review").alias("needs_review"))


def e22_validation(spark, sf_dir):
    return assembled(spark, sf_dir).select("doc_id", "validation.*")


def e23_correction_source(spark, sf_dir):
    return assembled(spark, sf_dir).select("doc_id", "correction_source")


def e24_flagged_fields(spark, sf_dir):
    return assembled(spark, sf_dir).select("doc_id", F.size("flags").alias("n"), F.array_join(F.transform("flags", lambda f: F.concat_ws(":", f["field"], f["error_type"])), ",").alias("flagged"))


def e25_explained(spark, sf_dir):
    d = assembled(spark, sf_dir).select("doc_id", "explanation", F.size(F.filter("flags", lambda f: f["explanation"].isNotNull())).alias("explained"), F.size("flags").alias("n"))
    flagged = F.filter(F.array(F.struct(*d.columns)), lambda r: r["n"] > 0)  # a generator, as the planner infers filters from all columns under a filter
    return d.select(F.inline(flagged)).drop("n")


def e26_document(spark, sf_dir):
    return assembled(spark, sf_dir).select("doc_id", "payment_order", F.col("echeance.value").alias("due"), F.col("creation.value").alias("made"), F.col("city.value").alias("city"), F.col("rib.full").alias("rib"), F.col("amount.value").cast("double").alias("amount"), F.col("drawee.value").alias("drawee"), "confidence", "review", "n_stamps", F.size("flags").alias("n_flags"), "extracted_at", F.array_join("stamp_info.affected_rois", ",").alias("affected_rois"), F.array_join("stamp_info.hints", "; ").alias("hints"), "corrections.*")


def a10_document_json(spark, sf_dir):
    """Whole nested documents as JSON, an amount as text; what is returned was read back from that."""
    d = assembled(spark, sf_dir)
    parts = "amount struct<value:string,currency:string>, rib struct<full:string,bank_name:string>, echeance struct<value:string>, creation struct<source:string>, city struct<value:string>, drawee struct<value:string>, domiciliation struct<needs_review:boolean>"
    rules = ",".join(f"{r}:string" for r in V.RULES)
    schema = f"doc_id long, payment_order string, {parts}, validation struct<{rules}>, confidence double, review boolean, correction_source string, n_stamps long, flags array<struct<field:string,explanation:string>>"
    r = d.select(F.from_json(U.document_json(d), schema).alias("r")).select("r.*")  # read once, not once for each value
    first = F.get("flags", F.lit(0))
    return r.select(
        "doc_id", "payment_order", F.col("amount.value").alias("amount"), "amount.currency", F.col("rib.full").alias("rib"), F.col("rib.bank_name").alias("bank"), F.col("echeance.value").alias("due"), F.col("creation.source").alias("made_source"),
        F.col("city.value").alias("city"), F.col("drawee.value").alias("drawee"), F.col("domiciliation.needs_review").alias("no_bank"), F.concat_ws(",", *[F.col(f"validation.{n}") for n in V.RULES]).alias("rules"), "confidence", "review", "correction_source", "n_stamps", first["field"].alias("first_field"), first["explanation"].alias("first_explanation"),
    )


def a14_failed_documents(spark, sf_dir):
    return batch(spark, sf_dir).select("doc_id", "confidence", "review", F.size("flags").alias("n_flags"), F.get("flags", F.lit(0))["field"].alias("first_field"), F.when(F.get("flags", F.lit(0))["field"] == "pipeline", F.get("flags", F.lit(0))["message"]).alias("error"))


def a14_line_outcomes(spark, sf_dir):
    """What has come of every line: lines, documents and regions by error."""
    outcomes = ingest.line_outcomes(fixtures.arrived_lines(spark, sf_dir))
    return outcomes.groupBy("error").agg(F.count("*").alias("lines"), F.count("doc_id").alias("named"), F.coalesce(F.sum(F.when(F.col("error").isNull(), F.size("fields"))), F.lit(0)).alias("regions"))


_FAILS = f"doc_id % 50 IN ({fixtures.CUT}, {fixtures.WORD}, {fixtures.BARE})"
_ERROR = f"CASE WHEN doc_id % 50 = {fixtures.BARE} THEN 'no regions' ELSE 'not a record of readings' END"
#: What is left of the readings after the lines of the second engine that are no JSON.
ARRIVED = duck.readings(f"NOT (engine = 'qwen' AND doc_id % 50 = {fixtures.GARBLED})")
V_ = duck.READINGS + duck.MERGED + duck.parsed("rs") + duck.CHECKED
ASM = V_ + duck.GEOMETRY + """
, src AS (SELECT doc_id, bool_or(source = 'qwen') AS second FROM rs GROUP BY doc_id)
, stc AS (SELECT doc_id, count(*) AS n_stamps, list(concat(upper(substr(colour, 1, 1)), substr(colour, 2), ' stamp centred at (', cx, ', ', cy, '), radius ~', rx, ' px') ORDER BY seq) AS hints FROM ss GROUP BY doc_id)
, hit AS (SELECT doc_id, list(DISTINCT roi_id ORDER BY roi_id) AS affected_rois FROM ov GROUP BY doc_id)
, chg AS (SELECT doc_id, CAST(sum(CASE WHEN rule >= 2 AND roi_id IN ('R05', 'R14') THEN changed ELSE 0 END) AS INT) AS rib_changed, CAST(sum(CASE WHEN rule >= 2 AND roi_id IN ('R06', 'R10') THEN changed ELSE 0 END) AS INT) AS amount_changed FROM mg GROUP BY doc_id)
, asm AS (SELECT v.*, coalesce(second, false) AS second, coalesce(n_stamps, 0) AS n_stamps, coalesce(hints, []) AS hints, coalesce(affected_rois, []) AS affected_rois, coalesce(rib_changed, 0) AS rib_changed, coalesce(amount_changed, 0) AS amount_changed, CASE WHEN n_hard + n_soft > 0 THEN explanation END AS explanation,
  image_path, operator_id, extracted_at, logged_at, log_date, seconds
  FROM v LEFT JOIN src USING (doc_id) LEFT JOIN stc USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN chg USING (doc_id) LEFT JOIN explanations_m USING (doc_id) LEFT JOIN runs_m USING (doc_id))
"""


def _merged(u, low):
    return f"CASE WHEN {u} IS NOT NULL THEN {duck.date_text(u)} ELSE {duck.date_text(low)} END", f"CASE WHEN {u} IS NOT NULL AND {u} = {low} THEN 'merged' WHEN {u} IS NOT NULL THEN 'upper' WHEN {low} IS NOT NULL THEN 'lower' ELSE 'upper' END", f"CAST(CASE WHEN {u} IS NOT NULL AND {low} IS NOT NULL AND {u} = {low} THEN 1.0 WHEN {u} IS NOT NULL AND {low} IS NOT NULL THEN 0.6 WHEN {u} IS NOT NULL OR {low} IS NOT NULL THEN 0.7 ELSE 0.0 END AS DOUBLE)"


_DUE, _MADE = _merged("due_u", "due_l"), _merged("made_u", "made_l")
_NAMES = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS who, nullif({duck.name_value('t' + c)}, '') AS value, CAST(c{c} AS DOUBLE) AS confidence, {duck.name_value('t' + c)} = '' OR regexp_matches(t{c}, '(?i)\\[STAMP\\]') AS needs_review FROM w" for n, c in (("tireur", "07"), ("beneficiary", "08"), ("drawee", "15")))
PAIRS = {
    review_by_bank: V_ + "SELECT bank_name, count(*) AS bills, count(*) FILTER (WHERE NOT rib_key_valid) AS bad_keys, count(*) FILTER (WHERE review) AS to_review FROM v GROUP BY bank_name",
    e1_wide: duck.READINGS + duck.MERGED + f", w AS ({duck.wide('rs')}) SELECT doc_id, {', '.join('t' + r[1:] for r in catalogues.ROI_IDS)}, {', '.join(f'CAST(c{r[1:]} AS DOUBLE) AS c{r[1:]}' for r in catalogues.ROI_IDS)} FROM w",
    e2_best_rib: V_ + "SELECT doc_id, rib, rib_source AS source FROM v",
    **dict(
        _rule(n, *r)
        for n, r in {
            "e3_rib_key_rule": ["rib_key_valid"], "e4_rib_consistency": ["rib_consistent"], "e5_amount_consistency": ["amount_consistent"], "e6_words_rule": ["words_match"], "e7_due_date_rule": ["echeance_consistent"],
            "e8_creation_date_rule": ["creation_consistent"], "e9_due_after_creation": ["due_after_creation"], "e10_bank_rule": ["bank_matches"], "e11_payment_order_rule": ["order_matches"],
        }.items()
    ),
    e12_flags: V_ + "SELECT * FROM fl",
    e13_field_scores: V_ + "SELECT doc_id, CAST(s_rib AS DOUBLE) AS s_rib, CAST(s_amount AS DOUBLE) AS s_amount, CAST(s_due AS DOUBLE) AS s_due, CAST(s_made AS DOUBLE) AS s_made FROM v",
    e14_document_score: V_ + "SELECT doc_id, CAST(confidence AS DOUBLE) AS confidence FROM v",
    e15_review: V_ + "SELECT doc_id, n_hard, n_soft, review FROM v",
    e16_merged_dates: V_ + f"SELECT doc_id, {_DUE[0]} AS due, {_DUE[1]} AS due_source, {_DUE[2]} AS due_score, {_MADE[0]} AS made, {_MADE[1]} AS made_source, {_MADE[2]} AS made_score FROM v",
    e17_amount_value: V_ + "SELECT doc_id, CAST(v AS DOUBLE) AS value, t09 AS in_words, 'DT' AS currency, words_match, v IS NULL AS needs_review FROM v",
    e18_rib_value: V_ + 'SELECT doc_id, rib AS "full", CASE WHEN rib IS NOT NULL THEN bank_code END AS bank_code, CASE WHEN rib IS NOT NULL THEN rib_ok END AS key_valid, CASE WHEN rib IS NOT NULL THEN bank_name END AS bank_name, CASE WHEN rib IS NOT NULL THEN CAST(s_rib AS DOUBLE) END AS confidence, CASE WHEN rib IS NOT NULL THEN rib_source END AS source, CASE WHEN rib IS NOT NULL THEN NOT rib_ok END AS needs_review FROM v',
    e19_city: duck.READINGS + duck.MERGED + f", w AS ({duck.wide('rs')}) SELECT doc_id, coalesce(nullif(t04, ''), nullif(t11, '')) AS value, CASE WHEN nullif(t04, '') IS NOT NULL THEN 'upper' WHEN nullif(t11, '') IS NOT NULL THEN 'lower' ELSE 'single' END AS source, CAST(coalesce(CASE WHEN nullif(t04, '') IS NOT NULL THEN c04 ELSE c11 END, 0) AS DOUBLE) AS confidence FROM w",
    e20_names: duck.READINGS + duck.MERGED + f", w AS ({duck.wide('rs')}) " + _NAMES,
    e21_texts: V_ + "SELECT doc_id, nullif(t01, '') AS payment_order, nullif(t16, '') AS domiciliation, CAST(coalesce(c16, 0) AS DOUBLE) AS confidence, 'single' AS source, coalesce(t16, '') = '' AS needs_review FROM v",
    e22_validation: V_ + f"SELECT doc_id, {', '.join(V.RULES)} FROM v",
    e23_correction_source: ASM + "SELECT doc_id, CASE WHEN second THEN 'qwen_fallback' ELSE 'tesseract_only' END AS correction_source FROM asm",
    e24_flagged_fields: V_ + "SELECT v.doc_id, n_hard + n_soft AS n, coalesce(flagged, '') AS flagged FROM v LEFT JOIN (SELECT doc_id, string_agg(concat(field, ':', error_type), ',' ORDER BY seq) AS flagged FROM fl GROUP BY doc_id) USING (doc_id)",
    e25_explained: ASM + "SELECT doc_id, explanation, CASE WHEN explanation IS NULL THEN 0 ELSE n_hard + n_soft END AS explained FROM asm WHERE n_hard + n_soft > 0",
    e26_document: ASM + f"SELECT doc_id, nullif(t01, '') AS payment_order, {_DUE[0]} AS due, {_MADE[0]} AS made, coalesce(nullif(t04, ''), nullif(t11, '')) AS city, rib, CAST(v AS DOUBLE) AS amount, nullif({duck.name_value('t15')}, '') AS drawee, CAST(confidence AS DOUBLE) AS confidence, review, n_stamps, n_hard + n_soft AS n_flags, extracted_at, array_to_string(affected_rois, ',') AS affected_rois, array_to_string(hints, '; ') AS hints, rib_changed, amount_changed, 0 AS dates_changed FROM asm",
    a10_document_json: ASM + f"""SELECT asm.doc_id, nullif(t01, '') AS payment_order, CAST(v AS VARCHAR) AS amount, CASE WHEN t06 IS NOT NULL OR t10 IS NOT NULL THEN 'DT' END AS currency, rib, CASE WHEN rib IS NOT NULL THEN bank_name END AS bank, {_DUE[0]} AS due, {_MADE[1]} AS made_source, coalesce(nullif(t04, ''), nullif(t11, '')) AS city, nullif({duck.name_value('t15')}, '') AS drawee, coalesce(t16, '') = '' AS no_bank, concat_ws(',', {", ".join(f"CAST({r} AS VARCHAR)" for r in V.RULES)}) AS rules, CAST(confidence AS DOUBLE) AS confidence, review, CASE WHEN second THEN 'qwen_fallback' ELSE 'tesseract_only' END AS correction_source, n_stamps, field AS first_field, explanation AS first_explanation FROM asm LEFT JOIN (SELECT doc_id, arg_min(field, seq) AS field FROM fl GROUP BY doc_id) AS ff ON ff.doc_id = asm.doc_id""",
    a14_failed_documents: ARRIVED + duck.MERGED + duck.parsed("rs") + duck.CHECKED + f"""SELECT v.doc_id, CAST(confidence AS DOUBLE) AS confidence, review, n_hard + n_soft AS n_flags, field AS first_field, NULL AS error FROM v LEFT JOIN (SELECT doc_id, arg_min(field, seq) AS field FROM fl GROUP BY doc_id) USING (doc_id) WHERE NOT {_FAILS}
UNION ALL SELECT doc_id, 0.0, true, 1, 'pipeline', {_ERROR} FROM pages_m WHERE {_FAILS} UNION ALL SELECT NULL, 0.0, true, 1, 'pipeline', concat('not a record of readings: engine stopped at ', CAST(doc_id AS VARCHAR)) FROM pages_m WHERE doc_id % 50 = {fixtures.GARBLED}""",
    a14_line_outcomes: duck.READINGS + f""", ln AS (SELECT doc_id, engine, count(*) AS n FROM readings GROUP BY doc_id, engine), oc AS (SELECT n, CASE WHEN engine = 'tesseract' AND {_FAILS} THEN {_ERROR} WHEN engine = 'qwen' AND doc_id % 50 = {fixtures.GARBLED} THEN 'not a record of readings' END AS error, NOT (engine = 'qwen' AND doc_id % 50 = {fixtures.GARBLED}) AS named FROM ln)
SELECT error, count(*) AS lines, count(*) FILTER (WHERE named) AS named, CAST(coalesce(sum(CASE WHEN error IS NULL THEN n END), 0) AS BIGINT) AS regions FROM oc GROUP BY error""",
}
