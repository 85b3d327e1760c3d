"""Queries over parsed fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettrine.functions import parsing as P
from lettrine.operators import matching
from lettrine.operators import reading as R
from lettrine.operators import validation as V
from lettrine.sources import catalogues, fixtures

from . import duck


def _texts(spark, sf_dir, *rois):
    """Merged readings of the regions; the others are left out before the engines are merged."""
    return R.resolved(fixtures.reading_sets(spark, sf_dir, *rois), catalogues.regions(spark, *rois), whole=True).select("doc_id", "roi_id", "text")


def _wide(spark, sf_dir, *rois):
    """Parsed documents; with regions named the others are left out before the engines are merged."""
    return V.parsed(V.wide_columns(R.resolved_columns(fixtures.reading_columns(spark, sf_dir, *rois), catalogues.ROUTES)), *rois)


def d1_rib(spark, sf_dir):
    r = _texts(spark, sf_dir, "R05", "R14").withColumn("r", P.rib(F.col("text")))
    return r.select("doc_id", "roi_id", "r.digits", "r.bank_code", "r.branch_code", "r.account", "r.key", "r.unread", "r.valid", "r.error")


def d2_rib_key(spark, sf_dir):
    digits = P.rib(F.col("text"))["digits"]
    return _texts(spark, sf_dir, "R05", "R14").select("doc_id", "roi_id", P.rib_key(F.substring(digits, 1, 18)).alias("computed"), F.substring(digits, 19, 2).try_cast("int").alias("given"))


def d3_bank_names(spark, sf_dir):
    r = _texts(spark, sf_dir, "R05", "R14").select("doc_id", "roi_id", P.rib(F.col("text"))["bank_code"].alias("code"))
    return r.join(F.broadcast(catalogues.banks(spark)), "code", "left").select("doc_id", "roi_id", "code", "bank_name")


def d4_dates(spark, sf_dir):
    r = _texts(spark, sf_dir, "R02", "R03", "R12", "R13").withColumn("r", P.date(F.col("text")))
    return r.select("doc_id", "roi_id", "r.value", "r.normalised", "r.valid")


def d5_date_order(spark, sf_dir):
    c = F.col
    return _wide(spark, sf_dir, "R02", "R03", "R12", "R13").select("doc_id", P.dates_equal(c("due_u"), c("due_l")).alias("equal"), P.date_after(c("due_u"), c("made_u")).alias("after"), P.date_on_or_after(c("due_u"), c("made_u")).alias("on_or_after"))


def d6_clean_amount(spark, sf_dir):
    return _texts(spark, sf_dir, "R06", "R10").select("doc_id", "roi_id", P.clean_amount(F.col("text")).alias("cleaned"))


def d7_separators(spark, sf_dir):
    return _texts(spark, sf_dir, "R06", "R10").select("doc_id", "roi_id", P.resolve_separators(P.clean_amount(F.col("text"))).alias("normal"))


def d8_amounts(spark, sf_dir):
    r = _texts(spark, sf_dir, "R06", "R10").withColumn("r", P.amount(F.col("text")))
    return r.select("doc_id", "roi_id", F.col("r.value").cast("double").alias("value"), "r.unread", "r.valid")


def d9_amounts_equal(spark, sf_dir):
    return _wide(spark, sf_dir, "R06", "R10").select("doc_id", P.amounts_equal(F.col("amt_u"), F.col("amt_l")).alias("equal"))


def d10_tokens(spark, sf_dir):
    return _texts(spark, sf_dir, "R09").select("doc_id", F.array_join(P.tokens(F.col("text")), "|").alias("tokens"))


def d11_number_words(spark, sf_dir):
    words = F.filter(P.tokens(F.col("text")), lambda t: ~t.isin(*P.DINARS, *P.MILLIMES))
    return _texts(spark, sf_dir, "R09").select("doc_id", P.words_to_int(words).alias("number"))


def d12_amount_words(spark, sf_dir):
    r = _texts(spark, sf_dir, "R09").withColumn("r", P.amount_words(F.col("text")))
    return r.select("doc_id", F.col("r.value").cast("double").alias("value"), "r.valid")


def _names(spark, sf_dir):
    return _texts(spark, sf_dir, "R07", "R08", "R15").withColumn("r", P.name(F.col("text")))


def d13_names(spark, sf_dir):
    return _names(spark, sf_dir).select("doc_id", "roi_id", "r.value", "r.valid")


def d14_companies(spark, sf_dir):
    return _names(spark, sf_dir).select("doc_id", "roi_id", "r.company")


def d15_occluded(spark, sf_dir):
    return _names(spark, sf_dir).select("doc_id", "roi_id", "r.occluded")


def d16_name_match(spark, sf_dir):
    return _wide(spark, sf_dir, "R07", "R08", "R15").select("doc_id", P.names_match(F.col("tireur")["value"], F.col("drawee")["value"]).alias("payer"), P.names_match(F.col("beneficiary")["value"], F.col("drawee")["value"]).alias("payee"))


def d16_name_join(spark, sf_dir):
    """Customers beside the names on bills, of any of the three name regions, that share 0.8 of their words."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", P.name(F.col("c_name"))["value"].alias("left_name"))
    names = _names(spark, sf_dir).select(F.col("r.value").alias("right_name"))
    return matching.similar_names(customers, names).select("c_custkey", F.col("left_name").alias("customer"), F.col("right_name").alias("name"), F.col("times"))


_D = duck.READINGS + duck.MERGED
_X = lambda rois: _D + f", x AS (SELECT doc_id, roi_id, text, {duck.rib_digits('text')} AS x FROM rs WHERE roi_id IN ({rois}))"
_N = _D + f", n AS (SELECT doc_id, roi_id, text, {duck.name_value('text')} AS value FROM rs WHERE roi_id IN ('R07', 'R08', 'R15'))"
_WORDS = lambda c: f"list_distinct(regexp_extract_all({c}, '[\\w]+'))"
_MATCH = lambda a, b: f"coalesce(len(list_intersect({_WORDS(a)}, {_WORDS(b)})) >= 0.8 * len(list_distinct(list_concat({_WORDS(a)}, {_WORDS(b)}))), false)"
_AMOUNTS = _D + f", a AS (SELECT doc_id, roi_id, text, {duck.amount_normal('text')} AS normal FROM rs WHERE roi_id IN ('R06', 'R10'))"
PAIRS = {
    d1_rib: _X("'R05', 'R14'") + f"SELECT doc_id, roi_id, CASE WHEN length(x) = 20 THEN x END AS digits, CASE WHEN length(x) = 20 THEN substr(x, 1, 2) END AS bank_code, CASE WHEN length(x) = 20 THEN substr(x, 3, 3) END AS branch_code, CASE WHEN length(x) = 20 THEN substr(x, 6, 13) END AS account, CASE WHEN length(x) = 20 THEN substr(x, 19, 2) END AS key, contains(x, '?') AS unread, {duck.rib_valid('x')} AS valid, CASE WHEN length(x) <> 20 THEN 'length' WHEN contains(x, '?') THEN 'unreadable' WHEN NOT {duck.rib_valid('x')} THEN 'key' END AS error FROM x",
    d2_rib_key: _X("'R05', 'R14'") + "SELECT doc_id, roi_id, CASE WHEN length(x) = 20 THEN (97 - (TRY_CAST(substr(x, 1, 18) AS BIGINT) % 97 * 100) % 97) % 97 END AS computed, CASE WHEN length(x) = 20 THEN TRY_CAST(substr(x, 19, 2) AS INT) END AS given FROM x",
    d3_bank_names: _X("'R05', 'R14'") + "SELECT doc_id, roi_id, CASE WHEN length(x) = 20 THEN substr(x, 1, 2) END AS code, bank_name FROM x LEFT JOIN bank ON length(x) = 20 AND substr(x, 1, 2) = bank.code",
    d4_dates: _D + f", d AS (SELECT doc_id, roi_id, {duck.date_parts('text')} AS p FROM rs WHERE roi_id IN ('R02', 'R03', 'R12', 'R13')), e AS (SELECT doc_id, roi_id, {duck.date_value('p')} AS value FROM d) SELECT doc_id, roi_id, value, {duck.date_text('value')} AS normalised, value IS NOT NULL AS valid FROM e",
    d5_date_order: _D + duck.parsed("rs") + "SELECT doc_id, coalesce(due_u = due_l, false) AS equal, coalesce(due_u > made_u, false) AS after, coalesce(due_u >= made_u, false) AS on_or_after FROM p",
    d6_clean_amount: _D + f"SELECT doc_id, roi_id, {duck.cleaned('text')} AS cleaned FROM rs WHERE roi_id IN ('R06', 'R10')",
    d7_separators: _AMOUNTS + "SELECT doc_id, roi_id, normal FROM a",
    d8_amounts: _AMOUNTS + f"SELECT doc_id, roi_id, CAST({duck.amount_value('text', 'normal')} AS DOUBLE) AS value, contains(text, '?') AS unread, {duck.amount_value('text', 'normal')} IS NOT NULL AS valid FROM a",
    d9_amounts_equal: _D + duck.parsed("rs") + "SELECT doc_id, coalesce(abs(vu - vl) <= 0.001, false) AS equal FROM p",
    d10_tokens: _D + f"SELECT doc_id, coalesce(array_to_string({duck.tokens('text')}, '|'), '') AS tokens FROM rs WHERE roi_id = 'R09'",
    d11_number_words: _D + f", k AS (SELECT doc_id, list_filter({duck.tokens('text')}, lambda t: NOT list_contains({duck.UNITS_OF_CURRENCY}, t)) AS t FROM rs WHERE roi_id = 'R09') SELECT doc_id, {duck.words_to_int('t')} AS number FROM k",
    d12_amount_words: _D + duck.parsed("rs") + "SELECT doc_id, CAST(vw AS DOUBLE) AS value, vw IS NOT NULL AS valid FROM p",
    d13_names: _N + "SELECT doc_id, roi_id, nullif(value, '') AS value, value <> '' AS valid FROM n",
    d14_companies: _N + f"SELECT doc_id, roi_id, regexp_matches(value, '\\b({'|'.join(P.LEGAL_FORMS)})\\b') AS company FROM n",
    d15_occluded: _N + "SELECT doc_id, roi_id, regexp_matches(text, '(?i)\\[STAMP\\]') AS occluded FROM n",
    d16_name_match: _N + f", m AS (SELECT doc_id, max(CASE WHEN roi_id = 'R07' THEN value END) AS t, max(CASE WHEN roi_id = 'R08' THEN value END) AS b, max(CASE WHEN roi_id = 'R15' THEN value END) AS d FROM n GROUP BY doc_id) SELECT doc_id, {_MATCH('t', 'd')} AS payer, {_MATCH('b', 'd')} AS payee FROM m",
    # Sets of one word match equal ones; others share a word besides their most frequent one.
    d16_name_join: _N + f""", cn AS (SELECT c_custkey, {duck.name_value("c_name")} AS customer FROM customer), bn AS (SELECT value AS name, count(*) AS times FROM n WHERE value <> '' GROUP BY value),
cw AS (SELECT c_custkey, customer, list_sort({_WORDS("customer")}) AS w FROM cn), bw AS (SELECT name, times, list_sort({_WORDS("name")}) AS w FROM bn),
fq AS (SELECT word, count(*) AS c FROM (SELECT unnest(w) AS word FROM cw UNION ALL SELECT unnest(w) FROM bw) GROUP BY word),
ce AS (SELECT c_custkey, word FROM (SELECT c_custkey, len(w) AS k, unnest(w) AS word FROM cw) JOIN fq USING (word) QUALIFY k = 1 OR row_number() OVER (PARTITION BY c_custkey ORDER BY c DESC, word) > 1),
be AS (SELECT name, word FROM (SELECT name, len(w) AS k, unnest(w) AS word FROM bw) JOIN fq USING (word) QUALIFY k = 1 OR row_number() OVER (PARTITION BY name ORDER BY c DESC, word) > 1),
cd AS (SELECT DISTINCT c_custkey, name FROM ce JOIN be USING (word))
SELECT c_custkey, customer, name, times FROM cd JOIN cw USING (c_custkey) JOIN bw USING (name) WHERE len(list_intersect(cw.w, bw.w)) >= 0.8 * len(list_distinct(list_concat(cw.w, bw.w)))""",
}
