"""Queries over pages, regions and stamps."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettrine.operators import geometry as G
from lettrine.sources import catalogues, fixtures

from . import duck


def _regions(spark):
    return catalogues.regions(spark)


def _overlaps(spark, sf_dir):
    return G.overlaps(G.score_stamps(fixtures.stamps(spark, sf_dir)), G.boxes(fixtures.pages(spark, sf_dir), _regions(spark), padded=False))


def b1_region_boxes(spark, sf_dir):
    return G.boxes(fixtures.pages(spark, sf_dir), _regions(spark)).drop("warning")


def b2_tier_filter(spark, sf_dir):
    return G.boxes(fixtures.pages(spark, sf_dir), _regions(spark).where("tier = 1")).groupBy("roi_id").agg(F.count("*").alias("pages"), F.sum("w").alias("width"))


def b3_page_scale(spark, sf_dir):
    return G.scale(fixtures.pages(spark, sf_dir)).withColumn("scale", F.round("scale", 6))


def b4_page_skew(spark, sf_dir):
    return G.skew(fixtures.pages(spark, sf_dir), fixtures.angles(spark, sf_dir)).withColumn("skew", F.round("skew", 6))


def b5_alignment(spark, sf_dir):
    return G.alignment(fixtures.pages(spark, sf_dir))


def b6_border(spark, sf_dir):
    return G.border_candidates(fixtures.contours(spark, sf_dir), fixtures.pages(spark, sf_dir))


def b7_stamp_scores(spark, sf_dir):
    return G.score_stamps(fixtures.stamps(spark, sf_dir))


def b8_distinct_stamps(spark, sf_dir):
    return G.distinct_stamps(G.score_stamps(fixtures.stamps(spark, sf_dir)))


def b9_stamp_boxes(spark, sf_dir):
    return G.stamp_boxes(G.score_stamps(fixtures.stamps(spark, sf_dir))).select("doc_id", "seq", "x1", "y1", "x2", "y2")


def b10_stamp_overlaps(spark, sf_dir):
    return _overlaps(spark, sf_dir).withColumn("share", F.round("share", 6))


def b11_affected_regions(spark, sf_dir):
    return G.affected(_overlaps(spark, sf_dir))


def b12_variant_plan(spark, sf_dir):
    return G.variant_plan(_overlaps(spark, sf_dir))


def b13_stamp_hints(spark, sf_dir):
    return G.hints(G.score_stamps(fixtures.stamps(spark, sf_dir)))


def b14_page_warnings(spark, sf_dir):
    pages = fixtures.pages(spark, sf_dir)
    return G.page_warnings(pages, G.skew(pages, fixtures.angles(spark, sf_dir)), G.alignment(pages))


_G = duck.READINGS + duck.GEOMETRY
_RATIO = "((3508.0 / greatest(h, 1) + 2480.0 / greatest(w, 1)) / 2)"
_LOW = "conf < 0.7"
#: Surest first: a stamp falls if a kept one before it is near. Four candidates a page at most, so three steps settle all.
_DISTINCT = """, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY -confidence, seq) AS rn FROM ss)
, nr AS (SELECT a.doc_id, a.rn AS early, b.rn AS late FROM o AS a JOIN o AS b ON a.doc_id = b.doc_id AND a.rn < b.rn AND (a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy) < pow((a.rx + b.rx) * 0.6, 2))
, k1 AS (SELECT doc_id, rn FROM o WHERE rn = 1)
, k2 AS (SELECT * FROM k1 UNION ALL SELECT doc_id, rn FROM o WHERE rn = 2 AND NOT EXISTS (SELECT 1 FROM nr JOIN k1 ON k1.doc_id = nr.doc_id AND k1.rn = nr.early WHERE nr.doc_id = o.doc_id AND nr.late = o.rn))
, k3 AS (SELECT * FROM k2 UNION ALL SELECT doc_id, rn FROM o WHERE rn = 3 AND NOT EXISTS (SELECT 1 FROM nr JOIN k2 ON k2.doc_id = nr.doc_id AND k2.rn = nr.early WHERE nr.doc_id = o.doc_id AND nr.late = o.rn))
, k4 AS (SELECT * FROM k3 UNION ALL SELECT doc_id, rn FROM o WHERE rn = 4 AND NOT EXISTS (SELECT 1 FROM nr JOIN k3 ON k3.doc_id = nr.doc_id AND k3.rn = nr.early WHERE nr.doc_id = o.doc_id AND nr.late = o.rn))
SELECT doc_id, seq, method, colour, cx, cy, rx, ry, confidence FROM o JOIN k4 USING (doc_id, rn)"""
PAIRS = {
    b1_region_boxes: _G + "SELECT doc_id, roi_id, tier, x, y, w, h FROM bx1",
    b2_tier_filter: _G + "SELECT roi_id, count(*) AS pages, CAST(sum(w) AS BIGINT) AS width FROM bx1 WHERE tier = 1 GROUP BY roi_id",
    b3_page_scale: _G + f"SELECT doc_id, round({_RATIO}, 6) AS scale, abs({_RATIO} - 1) >= 0.02 AS resized, CASE WHEN abs({_RATIO} - 1) >= 0.02 THEN CAST(round_even(w * {_RATIO}, 0) AS INT) ELSE w END AS new_w, CASE WHEN abs({_RATIO} - 1) >= 0.02 THEN CAST(round_even(h * {_RATIO}, 0) AS INT) ELSE h END AS new_h FROM pages_m",
    b4_page_skew: _G + "SELECT doc_id, round(skew, 6) AS skew, abs(skew) >= 0.3 AS rotate, abs(skew) > 5 AS steep FROM sk",
    b5_alignment: _G + f"SELECT doc_id, CASE WHEN snd AND anchored THEN 'header_barcode' WHEN NOT snd AND border_w IS NOT NULL THEN 'border' ELSE 'identity' END AS method, round(conf, 6) AS confidence, {_LOW} AS low FROM al",
    b6_border: _G + ", c AS (SELECT s.doc_id, seq, cw, ch, area, w, h FROM contours_m AS s JOIN pages_m USING (doc_id)), g AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY area DESC, seq) AS rn FROM c WHERE area * 10 >= w * h * 3 AND cw * 10 > w * 7 AND ch * 10 > h * 7) SELECT doc_id, cw AS border_w, ch AS border_h FROM g WHERE rn = 1",
    b7_stamp_scores: _G + "SELECT * FROM ss",
    b8_distinct_stamps: _G + _DISTINCT,
    b9_stamp_boxes: _G + "SELECT doc_id, seq, x1, y1, x2, y2 FROM sb",
    b10_stamp_overlaps: _G + "SELECT doc_id, seq, roi_id, round(share, 6) AS share FROM ov",
    b11_affected_regions: _G + "SELECT doc_id, string_agg(DISTINCT roi_id, ',' ORDER BY roi_id) AS regions FROM ov GROUP BY doc_id",
    b12_variant_plan: _G + "SELECT doc_id, roi_id, variant FROM (SELECT DISTINCT doc_id, roi_id FROM ov) AS o CROSS JOIN (VALUES ('original'), ('high_contrast'), ('stamp_suppressed')) AS v(variant)",
    b13_stamp_hints: _G + "SELECT doc_id, count(*) AS n_stamps, string_agg(concat(upper(substr(colour, 1, 1)), substr(colour, 2), ' stamp centred at (', CAST(cx AS VARCHAR), ', ', CAST(cy AS VARCHAR), '), radius ~', CAST(rx AS VARCHAR), ' px'), '; ' ORDER BY seq) AS hints FROM ss GROUP BY doc_id",
    b14_page_warnings: _G + f"SELECT al.doc_id, concat_ws('; ', CASE WHEN border_w IS NULL THEN 'perspective skipped' END, CASE WHEN abs(skew) > 5 THEN 'large skew' END, CASE WHEN {_LOW} THEN 'low alignment confidence' END) AS warnings FROM al JOIN sk USING (doc_id)",
}
