"""Queries of the measures over documents with known values."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lettrine.operators import geometry as G
from lettrine.operators import measures as M
from lettrine.operators import validation as V
from lettrine.sources import catalogues, fixtures

from . import checks, duck


def _pairs(spark, sf_dir, beside=(), **options):
    return M.pairs(checks.documents(spark, sf_dir, beside=(M.known_values(fixtures.truth(spark, sf_dir)), *beside)), **options)


def _pairs_of_arrays(spark, sf_dir):
    return M.pairs(checks.documents_of_arrays(spark, sf_dir), fixtures.truth(spark, sf_dir))


def h1_match_rate(spark, sf_dir):
    return M.match_rate(_pairs(spark, sf_dir))


def h2_character_errors(spark, sf_dir):
    return M.character_errors(_pairs(spark, sf_dir))


def h3_document_accuracy(spark, sf_dir):
    return M.documents_right(_pairs(spark, sf_dir)).agg(F.count("*").alias("n"), F.round(F.avg(F.col("right").cast("int")), 6).alias("accuracy"))


def h4_rejection_rate(spark, sf_dir):
    return checks.documents(spark, sf_dir).agg(F.round(F.avg(F.col("review").cast("int")), 6).alias("rate"))


def h5_false_acceptance(spark, sf_dir):
    return M.documents_right(_pairs(spark, sf_dir)).agg(F.count_if(~F.col("review") & ~F.col("right")).alias("n"), F.count_if(~F.col("review")).alias("accepted"))


def h6_calls_per_document(spark, sf_dir):
    calls = fixtures.readings(spark, sf_dir).groupBy("doc_id").agg(F.count_if((F.col("engine") == "qwen") & F.col("available")).alias("calls"))
    return calls.agg(F.round(F.avg("calls"), 6).alias("mean"), F.round(F.percentile("calls", 0.95), 6).alias("p95"))


def h6_calls_sketch(spark, sf_dir):
    """The same from sketches of each year's runs, and whether the quantile's rank is within the sketch's stated error."""
    calls = fixtures.readings(spark, sf_dir).groupBy("doc_id").agg(F.count_if((F.col("engine") == "qwen") & F.col("available")).alias("calls"))
    calls = calls.join(fixtures.runs(spark, sf_dir).select("doc_id", "log_date"), "doc_id")
    found = M.calls_of_sketches(M.call_sketches(calls, "log_date"))
    ranks = calls.crossJoin(F.broadcast(found)).agg(F.avg((F.col("calls") <= F.col("quantile")).cast("int")).alias("upto"), F.avg((F.col("calls") < F.col("quantile")).cast("int")).alias("below"))
    return found.crossJoin(ranks).select("n", "mean", ((F.col("upto") >= 0.95 - M.SKETCH_ERROR) & (F.col("below") <= 0.95 + M.SKETCH_ERROR)).alias("within"))


def h7_accuracy_by_stratum(spark, sf_dir):
    overlaps = G.overlaps(G.score_stamps(fixtures.stamps(spark, sf_dir)), G.boxes(fixtures.pages(spark, sf_dir), catalogues.regions(spark), padded=False))
    stamped = M.affected_fields(overlaps).groupBy("doc_id").agg(F.collect_set("field").alias("stamped"))
    return M.by_stratum(_pairs(spark, sf_dir, beside=(M.known_values(stamped),)))


def h8_words_mismatches(spark, sf_dir):
    d = checks.documents(spark, sf_dir, *checks.AMOUNT, "R09")
    rows = d.select("doc_id", F.col("amount")["value"].cast("double").alias("figures"), F.col("words")["value"].cast("double").alias("in_words"), (F.col("amount")["valid"] & F.col("words")["valid"] & ~F.col("words_match")).alias("differ"))
    return V.chosen(rows, lambda r: r["differ"]).drop("differ")


def h9_city_rule(spark, sf_dir):
    w = V.wide_columns(checks.merged_columns(spark, sf_dir, "R04", "R11"))
    return w.select("doc_id", F.coalesce((F.col("t04") != "") & (F.upper(F.trim("t04")) == F.upper(F.trim("t11"))), F.lit(False)).alias("same"))


def h10_late_due_dates(spark, sf_dir):
    return checks.documents(spark, sf_dir, *checks.DUE, *checks.MADE).select("doc_id", M.more_than_a_year(F.col("due")["value"], F.col("made")["value"]).alias("late"))


def h11_missing_fields(spark, sf_dir):
    """Each document is read and merged once, and tells its own missing and weak regions."""
    wanted = catalogues.regions(spark).agg(F.collect_list("roi_id").alias("wanted"))
    error = lambda roi, kind: F.struct(roi.alias("roi_id"), F.lit(kind).alias("error_type"))
    missing = F.transform(F.array_except("wanted", F.transform("cells", lambda c: c["roi_id"])), lambda roi: error(roi, "MISSING_FIELD"))
    weak = F.transform(F.filter("cells", lambda c: c["score"] < 0.55), lambda c: error(c["roi_id"], "OCR_ERROR"))
    return checks.merged_readings(spark, sf_dir).crossJoin(F.broadcast(wanted)).select("doc_id", F.inline(F.concat(missing, weak)))


def h12_error_shares(spark, sf_dir):
    by = V.flag_rows(checks.documents(spark, sf_dir)).groupBy("error_type").agg(F.count("*").alias("n"))
    return by.select("error_type", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6).alias("share"))


def h13_calibration(spark, sf_dir):
    return M.calibration(M.documents_right(_pairs(spark, sf_dir)))


def h14_corrections(spark, sf_dir):
    p = _pairs_of_arrays(spark, sf_dir)
    corrections = p.where("not correct and doc_id % 3 = 0").select("doc_id", "field", F.col("wanted").alias("correction"))  # what reviewers have put right
    done = p.join(corrections, ["doc_id", "field"], "left").withColumn("final", F.coalesce("correction", "found"))
    return done.groupBy("field").agg(F.count("correction").alias("corrected"), F.count_if(F.col("final").eqNullSafe(F.col("wanted"))).alias("right"), F.count("*").alias("n"))


def h14_patterns(spark, sf_dir):
    """What reviewers put right, character by character."""
    return M.correction_patterns(_pairs(spark, sf_dir, wrong=True).select("field", "found", F.col("wanted").alias("correction")))


_TRUTH = f", tr AS ({fixtures.TRUTH})"
_AMOUNT = "CASE WHEN vu IS NOT NULL THEN CAST(vu AS VARCHAR) WHEN t10 IS NOT NULL THEN CASE WHEN contains(t10, '?') THEN nl ELSE CAST(vl AS VARCHAR) END END"
_P = checks.V_ + _TRUTH + f""", pq AS (SELECT v.doc_id, review, CAST(confidence AS DOUBLE) AS confidence, tr.printed, v.rib AS rib_f, {_AMOUNT} AS amount_f, {duck.date_text("due")} AS due_f, {duck.date_text("made")} AS made_f, tr.rib AS rib_w, tr.amount AS amount_w, tr.echeance AS et, tr.creation AS ct FROM v JOIN tr ON v.doc_id = tr.doc_id)
, pp AS ({" UNION ALL ".join(f"SELECT doc_id, review, confidence, printed, '{f}' AS field, {a} AS found, {b} AS wanted, {a} IS NOT DISTINCT FROM {b} AS correct FROM pq" for f, a, b in (("rib", "rib_f", "rib_w"), ("amount", "amount_f", "amount_w"), ("echeance", "due_f", "et"), ("creation", "made_f", "ct")))})
, rt AS (SELECT doc_id, bool_and(correct) AS "right", any_value(review) AS review, any_value(confidence) AS confidence FROM pp GROUP BY doc_id)
"""
_FIELD_OF = "CASE " + " ".join(f"WHEN roi_id IN {ids} THEN '{f}'" for f, ids in M.FIELD_REGIONS.items()) + " END"
_ALIKE = "len(list_filter(range(1, least(length({x}), length({y})) + 1), lambda i: {x}[1:i] = {y}[1:i]))"
_PAIR = "concat({x}, chr(31), {y}, chr(30))"
_CHANGE, _UP, _LEFT = "(rw[len(cu)].cost + CASE WHEN x[i] = y[len(cu)] THEN 0 ELSE 1 END)", "(rw[len(cu) + 1].cost + 1)", "(cu[len(cu)].cost + 1)"
_CELL = f"""CASE WHEN len(cu) = 0 THEN {{'cost': rw[1].cost + 1, 'path': concat(rw[1].path, {_PAIR.format(x="x[i]", y="''")})}}
 WHEN {_CHANGE} <= {_UP} AND {_CHANGE} <= {_LEFT} THEN {{'cost': {_CHANGE}, 'path': concat(rw[len(cu)].path, CASE WHEN x[i] = y[len(cu)] THEN '' ELSE {_PAIR.format(x="x[i]", y="y[len(cu)]")} END)}}
 WHEN {_UP} <= {_LEFT} THEN {{'cost': {_UP}, 'path': concat(rw[len(cu) + 1].path, {_PAIR.format(x="x[i]", y="''")})}}
 ELSE {{'cost': {_LEFT}, 'path': concat(cu[len(cu)].path, {_PAIR.format(x="''", y="y[len(cu)]")})}} END"""
# A cell of the table of costs at a time, over the middles of the distinct corrections.
_PATTERNS = _P.replace("WITH", "WITH RECURSIVE", 1) + f"""
, k0 AS MATERIALIZED (SELECT field, coalesce(found, '') AS a, wanted AS b, count(*) AS n FROM pp WHERE NOT correct GROUP BY ALL)
, k1 AS (SELECT field, n, reverse(substr(a, {_ALIKE.format(x="a", y="b")} + 1)) AS a, reverse(substr(b, {_ALIKE.format(x="a", y="b")} + 1)) AS b FROM k0)
, k2 AS (SELECT field, n, reverse(substr(a, {_ALIKE.format(x="a", y="b")} + 1)) AS x, reverse(substr(b, {_ALIKE.format(x="a", y="b")} + 1)) AS y FROM k1)
, k3 AS MATERIALIZED (SELECT row_number() OVER () AS id, field, n, x, y FROM (SELECT field, x, y, sum(n) AS n FROM k2 GROUP BY ALL))
, rc AS (SELECT id, x, y, CAST(1 AS BIGINT) AS i, list_transform(range(0, length(y) + 1), lambda j: {{'cost': CAST(j AS BIGINT), 'path': array_to_string(list_transform(range(1, j + 1), lambda q: {_PAIR.format(x="''", y="y[q]")}), '')}}) AS rw, CAST([] AS STRUCT(cost BIGINT, path VARCHAR)[]) AS cu FROM k3
  UNION ALL SELECT id, x, y, CASE WHEN len(cu) = length(y) THEN i + 1 ELSE i END, CASE WHEN len(cu) = length(y) THEN list_append(cu, cl) ELSE rw END, CASE WHEN len(cu) = length(y) THEN [] ELSE list_append(cu, cl) END
  FROM (SELECT *, {_CELL} AS cl FROM rc WHERE i <= length(x)) AS s)
, pt AS (SELECT field, n, unnest(list_filter(string_split(rw[length(k3.y) + 1].path, chr(30)), lambda p: p <> '')) AS p FROM rc JOIN k3 USING (id) WHERE i = length(k3.x) + 1)
SELECT field, split_part(p, chr(31), 1) AS wrong, split_part(p, chr(31), 2) AS "right", CAST(sum(n) AS BIGINT) AS n FROM pt GROUP BY 1, 2, 3"""
PAIRS = {
    h14_patterns: _PATTERNS,
    h1_match_rate: _P + "SELECT field, round(avg(CAST(correct AS INT)), 6) AS rate FROM pp GROUP BY field",
    h2_character_errors: _P + "SELECT field, round(CAST(sum(levenshtein(coalesce(found, ''), wanted)) AS DOUBLE) / sum(length(wanted)), 6) AS rate FROM pp GROUP BY field",
    h3_document_accuracy: _P + 'SELECT count(*) AS n, round(avg(CAST("right" AS INT)), 6) AS accuracy FROM rt',
    h4_rejection_rate: checks.V_ + "SELECT round(avg(CAST(review AS INT)), 6) AS rate FROM v",
    h5_false_acceptance: _P + 'SELECT count(*) FILTER (WHERE NOT review AND NOT "right") AS n, count(*) FILTER (WHERE NOT review) AS accepted FROM rt',
    h6_calls_per_document: duck.READINGS + ", c AS (SELECT doc_id, count(*) FILTER (WHERE engine = 'qwen' AND available) AS calls FROM readings GROUP BY doc_id) SELECT round(avg(calls), 6) AS mean, round(quantile_cont(calls, 0.95), 6) AS p95 FROM c",
    h6_calls_sketch: duck.READINGS + ", c AS (SELECT doc_id, count(*) FILTER (WHERE engine = 'qwen' AND available) AS calls FROM readings GROUP BY doc_id) SELECT count(*) AS n, round(avg(calls), 6) AS mean, true AS within FROM c",
    h7_accuracy_by_stratum: _P + duck.GEOMETRY + f", af AS (SELECT DISTINCT doc_id, {_FIELD_OF} AS field FROM ov WHERE {_FIELD_OF} IS NOT NULL) SELECT printed, af.doc_id IS NOT NULL AS stamped, pp.field, count(*) AS n, round(avg(CAST(correct AS INT)), 6) AS rate FROM pp LEFT JOIN af ON af.doc_id = pp.doc_id AND af.field = pp.field GROUP BY CUBE (printed, stamped, pp.field)",
    h8_words_mismatches: checks.V_ + "SELECT doc_id, CAST(v AS DOUBLE) AS figures, CAST(vw AS DOUBLE) AS in_words FROM v WHERE v IS NOT NULL AND vw IS NOT NULL AND NOT words_match",
    h9_city_rule: duck.READINGS + duck.MERGED + f", w AS ({duck.wide('rs')}) SELECT doc_id, coalesce(t04 <> '' AND upper(trim(t04)) = upper(trim(t11)), false) AS same FROM w",
    h10_late_due_dates: checks.V_ + "SELECT doc_id, coalesce(due > made + INTERVAL 12 MONTH, false) AS late FROM v",
    h11_missing_fields: duck.READINGS + duck.MERGED + "SELECT d.doc_id, region.roi_id, 'MISSING_FIELD' AS error_type FROM (SELECT DISTINCT doc_id FROM rs) AS d CROSS JOIN region WHERE NOT EXISTS (SELECT 1 FROM rs AS f WHERE f.doc_id = d.doc_id AND f.roi_id = region.roi_id) UNION ALL SELECT doc_id, roi_id, 'OCR_ERROR' FROM rs WHERE score < 0.55",
    h12_error_shares: checks.V_ + "SELECT error_type, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM fl GROUP BY error_type",
    h13_calibration: _P + ', cb AS (SELECT CAST(least(floor(round(confidence * 10, 6)), 9) AS INT) AS bucket, count(*) AS n, round(avg(CAST("right" AS INT)), 6) AS accuracy FROM rt GROUP BY 1) SELECT bucket, n, accuracy, coalesce(accuracy >= lag(accuracy) OVER (ORDER BY bucket), true) AS monotonic FROM cb',
    h14_corrections: _P + """SELECT field, count(*) FILTER (WHERE NOT correct AND doc_id % 3 = 0) AS corrected, count(*) FILTER (WHERE correct OR doc_id % 3 = 0) AS "right", count(*) AS n FROM pp GROUP BY field""",
}
