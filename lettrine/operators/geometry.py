"""Pages, regions and stamps, from measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_WIDTH, PAGE_HEIGHT = 2480, 3508
ALIGNED_WIDTH, ALIGNED_HEIGHT = 2150, 1512
OVERLAP = 0.10
APART = 0.6
EXACT = "decimal(18,6)"


def boxes(pages: DataFrame, regions: DataFrame, padded: bool = True) -> DataFrame:
    """The pixel box of each region on each page; regions are 17 rows, so their product with the pages moves nothing."""
    d = lambda c: F.col(c).cast("decimal(9,4)")
    pad = d("padding") if padded else F.lit(0).cast("decimal(9,4)")
    whole = lambda c: c.cast("int")
    x0, w0 = d("fx") * F.col("w"), d("fw") * F.col("w")
    y0, h0 = d("fy") * F.col("h"), d("fh") * F.col("h")
    x, y = F.greatest(F.lit(0), whole(x0 - w0 * pad)), F.greatest(F.lit(0), whole(y0 - h0 * pad))
    r = F.broadcast(regions.select("roi_id", "tier", F.col("x").alias("fx"), F.col("y").alias("fy"), F.col("w").alias("fw"), F.col("h").alias("fh"), "padding"))
    bw, bh = F.least(F.col("w") - F.col("bx"), F.col("bw0")), F.least(F.col("h") - F.col("by"), F.col("bh0"))
    return (
        pages.select("doc_id", "w", "h")
        .crossJoin(r)
        .select("doc_id", "roi_id", "tier", "w", "h", x.alias("bx"), y.alias("by"), whole(w0 + w0 * pad * 2).alias("bw0"), whole(h0 + h0 * pad * 2).alias("bh0"))
        .select("doc_id", "roi_id", "tier", F.col("bx").alias("x"), F.col("by").alias("y"), bw.alias("w"), bh.alias("h"))
        .withColumn("warning", F.when((F.col("w") <= 0) | (F.col("h") <= 0), "empty region"))
    )


def scale(pages: DataFrame) -> DataFrame:
    """Mean of the ratios to the target size; within two percent of it the page stays as it is."""
    ratio = (F.lit(PAGE_HEIGHT) / F.greatest("h", F.lit(1)) + F.lit(PAGE_WIDTH) / F.greatest("w", F.lit(1))) / 2
    resize = F.abs(ratio - 1) >= 0.02
    size = lambda c: F.when(resize, F.bround(F.col(c) * ratio).cast("int")).otherwise(F.col(c))
    return pages.select("doc_id", ratio.alias("scale"), resize.alias("resized"), size("w").alias("new_w"), size("h").alias("new_h"))


def skew(pages: DataFrame, angles: DataFrame) -> DataFrame:
    """Median of the lines' angles from the horizontal, of those within 20 degrees; 0 without lines."""
    angle = F.col("theta_deg") - 90
    found = angles.where(F.abs(angle) <= 20).groupBy("doc_id").agg(F.median(angle).alias("median"))
    value = F.coalesce("median", F.lit(0.0))
    return pages.select("doc_id").join(found, "doc_id", "left").select("doc_id", value.alias("skew"), (F.abs(value) >= 0.3).alias("rotate"), (F.abs(value) > 5).alias("steep"))


def alignment(pages: DataFrame) -> DataFrame:
    """The border if it covers enough of the page, else header and barcode if they are better."""
    cover = F.least(F.lit(1.0), F.col("border_w") * F.col("border_h") / (F.col("w") * F.col("h")) * 1.2)
    border = F.coalesce(cover, F.lit(0.3))
    bottom = F.coalesce("barcode_bottom", F.col("h") - 1)
    anchored = (F.col("header_top").isNotNull() | F.col("barcode_bottom").isNotNull()) & (bottom > F.coalesce("header_top", F.lit(0)))
    score = F.when(anchored, (F.lit(5) + 2 * F.col("header_top").isNotNull().cast("int") + 2 * F.col("barcode_bottom").isNotNull().cast("int")) / 10).otherwise(0.2)
    second = (border < 0.7) & (score > border)
    confidence = F.when(second, score).otherwise(border)
    method = F.when(second & anchored, "header_barcode").when(~second & F.col("border_w").isNotNull(), "border").otherwise("identity")
    return pages.select("doc_id", method.alias("method"), F.round(confidence, 6).alias("confidence"), (confidence < 0.7).alias("low"))


def border_candidates(contours: DataFrame, pages: DataFrame) -> DataFrame:
    """The largest contour (doc_id, seq, area and its box's cw, ch) of at least 30 percent of the page that is over 70 percent wide and high."""
    c = contours.join(pages.select("doc_id", "w", "h"), "doc_id")
    good = c.where((F.col("area") * 10 >= F.col("w") * F.col("h") * 3) & (F.col("cw") * 10 > F.col("w") * 7) & (F.col("ch") * 10 > F.col("h") * 7))
    return good.groupBy("doc_id").agg(F.max(F.struct("area", (-F.col("seq")).alias("s"), "cw", "ch")).alias("b")).select("doc_id", F.col("b.cw").alias("border_w"), F.col("b.ch").alias("border_h"))


def score_stamps(candidates: DataFrame) -> DataFrame:
    """Circles by their density, contours by how much of their ellipse they fill."""
    circle = candidates.where("method = 'hough' and density >= 0.08").withColumn("confidence", F.round(F.least(F.lit(1.0), F.col("density") + 0.5), 3))
    fill = F.col("area") * 0.8 / (F.greatest(F.col("rx") * F.col("ry"), F.lit(1)) * 3.141592653589793)
    shape = candidates.where("method = 'contour' and area >= 2000").withColumn("confidence", F.when(F.col("n_points") < 5, F.lit(0.5)).otherwise(F.round(F.least(F.lit(1.0), fill), 3)))
    radius = F.greatest("rx", "ry")
    return circle.unionByName(shape).select("doc_id", "seq", "method", "colour", "cx", "cy", radius.alias("rx"), radius.alias("ry"), "confidence")


def distinct_stamps(stamps: DataFrame) -> DataFrame:
    """Surest first, without those whose centre is near a kept one's. A page has few candidates, so they fold as one array."""
    near = lambda a, b: (a["cx"] - b["cx"]) * (a["cx"] - b["cx"]) + (a["cy"] - b["cy"]) * (a["cy"] - b["cy"]) < F.pow((a["rx"] + b["rx"]) * F.lit(APART), F.lit(2))
    sorted_ = F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("order"), "seq", "method", "colour", "cx", "cy", "rx", "ry", "confidence")))
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda acc, c: F.when(F.exists(acc, lambda k: near(k, c)), acc).otherwise(F.concat(acc, F.array(c))))
    return stamps.groupBy("doc_id").agg(sorted_.alias("all")).select("doc_id", F.explode(kept).alias("s")).select("doc_id", "s.seq", "s.method", "s.colour", "s.cx", "s.cy", "s.rx", "s.ry", "s.confidence")


def stamp_boxes(stamps: DataFrame, margin: int = 10) -> DataFrame:
    low = lambda c, r: F.greatest(F.lit(0), F.col(c) - F.col(r) - margin)
    return stamps.select("*", low("cx", "rx").alias("x1"), low("cy", "ry").alias("y1"), (F.col("cx") + F.col("rx") + margin).alias("x2"), (F.col("cy") + F.col("ry") + margin).alias("y2"))


def overlaps(stamps: DataFrame, boxes_: DataFrame, least: float = OVERLAP) -> DataFrame:
    """Stamps over regions: joined by document, then the boxes' intersection as a share of the region."""
    s = stamp_boxes(stamps).select("doc_id", "seq", "x1", "y1", "x2", "y2")
    wide = F.least("x2", F.col("x") + F.col("w")) - F.greatest("x1", "x")
    high = F.least("y2", F.col("y") + F.col("h")) - F.greatest("y1", "y")
    share = wide * high / F.greatest(F.lit(1), F.col("w") * F.col("h"))
    return s.join(boxes_.select("doc_id", "roi_id", "x", "y", "w", "h"), "doc_id").where((wide > 0) & (high > 0)).select("doc_id", "seq", "roi_id", share.alias("share")).where(F.col("share") >= least)


def affected(overlaps_: DataFrame) -> DataFrame:
    return overlaps_.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("roi_id")), ",").alias("regions"))


def variant_plan(overlaps_: DataFrame) -> DataFrame:
    return overlaps_.select("doc_id", "roi_id").distinct().select("doc_id", "roi_id", F.explode(F.array(*[F.lit(v) for v in ("original", "high_contrast", "stamp_suppressed")])).alias("variant"))


def hints(stamps: DataFrame) -> DataFrame:
    text = F.concat(F.initcap("colour"), F.lit(" stamp centred at ("), F.col("cx"), F.lit(", "), F.col("cy"), F.lit("), radius ~"), F.col("rx"), F.lit(" px"))
    return stamps.groupBy("doc_id").agg(F.count("*").alias("n_stamps"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", text.alias("t")))), lambda x: x["t"]), "; ").alias("hints"))


def stamp_info(stamps: DataFrame, boxes_: DataFrame) -> DataFrame:
    """Of each document with stamps: their number, the regions that they affect, and hints, in order."""
    text = F.concat(F.initcap("colour"), F.lit(" stamp centred at ("), F.col("cx"), F.lit(", "), F.col("cy"), F.lit("), radius ~"), F.col("rx"), F.lit(" px"))
    told = stamps.groupBy("doc_id").agg(F.count("*").alias("n_stamps"), F.transform(F.array_sort(F.collect_list(F.struct("seq", text.alias("t")))), lambda x: x["t"]).alias("hints"))
    hit = overlaps(stamps, boxes_).groupBy("doc_id").agg(F.array_sort(F.collect_set("roi_id")).alias("affected_rois"))
    return told.join(hit, "doc_id", "left").withColumn("affected_rois", F.coalesce("affected_rois", F.array().cast("array<string>")))


def page_warning_lists(pages: DataFrame, skews: DataFrame, aligned: DataFrame) -> DataFrame:
    when: list[Column] = [F.when(F.col("border_w").isNull(), F.lit("perspective skipped")), F.when(F.col("steep"), F.lit("large skew")), F.when(F.col("low"), F.lit("low alignment confidence"))]
    return pages.join(skews, "doc_id").join(aligned.select("doc_id", "low"), "doc_id").select("doc_id", F.array_compact(F.array(*when)).alias("warnings"))


def page_warnings(pages: DataFrame, skews: DataFrame, aligned: DataFrame) -> DataFrame:
    return page_warning_lists(pages, skews, aligned).withColumn("warnings", F.array_join("warnings", "; "))
