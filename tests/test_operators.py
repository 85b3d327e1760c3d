"""Literal cases of operators, and the parts that SQL doesn't reach: files, logs and streams."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from lettrine.operators import audit, geometry, reading, validation
from lettrine.sources import catalogues, ingest
from lettrine.streaming import audit_stream

READING = "doc_id long, roi_id string, engine string, text string, confidence double, available boolean"


def merge(spark, first, second, c1=0.5, available=True):
    rows = spark.createDataFrame([(1, "R05", first, c1, second, available)], "doc_id long, roi_id string, first string, c1 double, second string, available boolean")
    return reading.merged(rows).first()


def test_merge_rules_in_order(spark):
    r = merge(spark, "08006", None, available=None)
    assert (r["text"], r["source"], r["flags"]) == ("08006", "tesseract", ["qwen_unavailable"])
    r = merge(spark, "08006", "0?006")
    assert (r["text"], r["source"], r["score"], r["flags"]) == ("08006", "merged", Decimal("0.7000"), [])
    r = merge(spark, "", "0???6")
    assert (r["text"], r["score"], r["flags"]) == ("0???6", Decimal("0.5500"), ["partial_unreadable_3_chars"])
    r = merge(spark, "11111", "11444")
    assert (r["text"], r["flags"], r["score"]) == ("11111", ["qwen_rejected_divergence"], Decimal("0.4250"))
    r = merge(spark, "15 06", "1506")
    assert (r["source"], r["score"]) == ("tesseract", Decimal("0.8500"))
    r = merge(spark, "15062025", "15/06/2025")
    assert (r["text"], r["source"], r["score"]) == ("15/06/2025", "qwen", Decimal("0.4200"))
    assert merge(spark, "1", "2", c1=0.8)["text"] == "1"


def test_variants(spark):
    rows = [(1, "R06", 0, "3000"), (1, "R06", 1, "300000"), (2, "R06", 0, "3000"), (2, "R06", 1, "3001"), (3, "R06", 0, ""), (3, "R06", 1, ""), (4, "R06", 0, "3?00"), (4, "R06", 1, "30"), (5, "R16", 0, "BIAT AGENCE"), (5, "R16", 1, "B1AT 2 AG")]
    best = {r["doc_id"]: (r["text"], r["variant"]) for r in reading.best_variant(spark.createDataFrame(rows, "doc_id long, roi_id string, variant int, text string"), catalogues.regions(spark)).collect()}
    assert best == {1: ("300000", 1), 2: ("3000", 0), 3: ("", 0), 4: ("30", 1), 5: ("BIAT AGENCE", 0)}


def test_stamps(spark):
    stamps = spark.createDataFrame([(1, 1, "hough", "blue", 100, 100, 50, 50, 0.9), (1, 2, "hough", "blue", 120, 100, 50, 50, 0.8), (1, 3, "contour", "blue", 900, 900, 50, 50, 0.5), (2, 1, "hough", "blue", 20, 30, 50, 50, 0.9)], "doc_id long, seq int, method string, colour string, cx int, cy int, rx int, ry int, confidence double")
    boxes = {(r["doc_id"], r["seq"]): (r["x1"], r["y1"], r["x2"], r["y2"]) for r in geometry.stamp_boxes(stamps).collect()}
    assert boxes[1, 1] == (40, 40, 160, 160) and boxes[2, 1] == (0, 0, 80, 90)
    assert {(r["doc_id"], r["seq"]) for r in geometry.distinct_stamps(stamps).collect()} == {(1, 1), (1, 3), (2, 1)}
    regions = spark.createDataFrame([(1, "A", 100, 100, 100, 100), (1, "B", 155, 155, 100, 100), (3, "A", 0, 0, 10, 10)], "doc_id long, roi_id string, x int, y int, w int, h int")
    assert {(r["seq"], r["roi_id"]) for r in geometry.overlaps(stamps, regions).collect()} == {(1, "A"), (2, "A")}


def bill(**changes):
    texts = {"R01": "00000001234", "R02": "15/09/2025", "R13": "15/09/2025", "R03": "15/06/2025", "R12": "15/06/2025", "R04": "TUNIS", "R11": "TUNIS", "R05": "08 006 0110510000870 41", "R14": "08 006 0110510000870 41", "R06": "3000,000", "R10": "3000,000", "R09": "trois mille dinars", "R07": "STE A SARL", "R08": "B", "R15": "C", "R16": "BIAT AGENCE TUNIS", "R17": "1234"}
    texts |= changes
    return [(k, v) for k, v in texts.items() if v is not None]


def validate(spark, *bills):
    rows = [(i, r, t, Decimal("0.9")) for i, b in enumerate(bills) for r, t in b]
    table = spark.createDataFrame(rows, "doc_id long, roi_id string, text string, score decimal(9,4)")
    return {r["doc_id"]: r for r in validation.validated(table, catalogues.banks(spark)).collect()}


def test_rules(spark):
    wrong = "08 006 0110510000870 42"
    docs = validate(spark, bill(), bill(R05=wrong, R14=wrong), bill(R05=wrong), bill(R05="08 006 011051?000870 41"), bill(R06="3000,002"), bill(R09="cinq cents dinars"), bill(R13="16/09/2025"), bill(R02="01/06/2025", R13="01/06/2025"), bill(R16="STB"), bill(R17="99"), [("R04", "TUNIS")], bill(R14=None, R05=None))
    flags = {i: [(f["field"], f["error_type"], f["hard"]) for f in d["flags"]] for i, d in docs.items()}
    assert flags[0] == [] and not docs[0]["review"] and docs[0]["confidence"] == Decimal("0.99000") and all(docs[0][r] for r in validation.RULES)
    assert flags[1] == [("rib", "VALIDATION_ERROR", True)]
    assert flags[2] == [("rib", "INCONSISTENCY", True)] and docs[2]["rib_source"] == "lower"
    assert flags[3] == [("rib", "STAMP_OCCLUSION", False)] and docs[3]["rib_consistent"]
    assert flags[4] == [("amount", "INCONSISTENCY", True), ("amount", "INCONSISTENCY", False)]  # the words differ too
    assert flags[5] == [("amount", "INCONSISTENCY", False)]
    assert flags[6] == [("echeance", "INCONSISTENCY", True)]
    assert flags[7] == [("echeance", "VALIDATION_ERROR", False)]
    assert flags[8] == [("rib", "VALIDATION_ERROR", False)]
    assert flags[9] == [("payment_order", "INCONSISTENCY", True)]
    assert flags[10] == [] and docs[10]["review"]
    assert flags[11] == [] and not docs[11]["rib_key_valid"]


def test_published_score_of_an_unreadable_bill(spark):
    row = validate(spark, [("R05", "x"), ("R14", "x"), ("R06", ""), ("R02", ""), ("R03", "")])[0]
    assert row["s_rib"] == Decimal("0.36000")  # 0.12 + 0.15 + 0 and a tenth of the engine's 0.9: 0.27 without it


def test_json_sources(spark, tmp_path):
    (tmp_path / "roi.json").write_text(json.dumps({"rois": {"R01": {"name": "a", "tier": 1, "x": 0.1, "y": 0.2, "w": 0.3, "h": 0.4, "tesseract_config": "--psm 7 -c tessedit_char_whitelist=0123456789,."}, "R02": {"name": "b", "tier": 2, "x": 0, "y": 0, "w": 1, "h": 1, "padding": 0.15, "ocr_engine": "qwen"}}}))
    rows = {r["roi_id"]: r for r in catalogues.read_regions(spark, str(tmp_path / "roi.json")).collect()}
    assert (rows["R01"]["padding"], rows["R01"]["allowed"], rows["R01"]["route"]) == (0.05, "amount", "tesseract") and rows["R02"]["route"] == "qwen"
    (tmp_path / "bank.json").write_text(json.dumps({"bank_codes": {"08": "BIAT"}}))
    assert [tuple(r) for r in catalogues.read_banks(spark, str(tmp_path / "bank.json")).collect()] == [("08", "BIAT")]
    assert catalogues.read_banks(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "r.json").write_text(json.dumps({"doc_id": 1, "fields": {"R01": {"text": "1", "confidence": 0.5, "engine": "tesseract", "available": True}}}))
    assert tuple(ingest.read_readings(spark, str(tmp_path / "r.json"))[0].first()) == (1, "R01", "tesseract", "1", 0.5, True, None)


def test_scans(spark, tmp_path):
    for name in ("b_1_page-0002.jpg", "x-0001.jpg", "a.png"):
        (tmp_path / name).write_bytes(b"x")
    scans = ingest.list_scans(spark, str(tmp_path))
    assert [r[0] for r in scans.select(ingest.doc_id(F.col("path"))).collect()] == ["1_0002", "ptj_0001"]
    assert ingest.list_scans(spark, str(tmp_path), 1).count() == 1 and "content" not in scans.columns


def test_stream(spark, tmp_path):
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    write = lambda *ids: spark.createDataFrame([(i, [(r, t, Decimal("0.9")) for r, t in bill()]) for i in ids], audit_stream.SCHEMA).write.mode("append").parquet(source)

    def transform(arrived):
        wide = audit_stream.wide_rows(arrived, catalogues.ROI_IDS)
        return validation.scored(validation.checked(validation.best(validation.parsed(wide), catalogues.banks(spark)))).select("doc_id", "review", F.col("confidence").cast("double").alias("confidence"))

    seen = []
    listener = audit_stream.Progress(lambda batch, n: seen.append(n))
    spark.streams.addListener(listener)
    for ids in ((1, 2), (3,)):
        write(*ids)
        audit_stream.run(spark, source, log, checkpoint, transform, "2024-01-01").awaitTermination(120)
    found = spark.read.schema("doc_id long, review boolean, confidence double, log_date string").json(log).collect()
    spark.streams.removeListener(listener)
    assert sorted((r["doc_id"], r["review"], r["confidence"]) for r in found) == [(i, False, 0.99) for i in (1, 2, 3)]


def test_barcodes(spark):
    rows = [(1, "R17", "tesseract", "12-34", 0.6, True), (1, "R17", "pyzbar", "001234", 1.0, True), (2, "R17", "tesseract", "12-34", 0.6, True), (3, "R17", "tesseract", "x", 0.6, True), (4, "R17", "pyzbar", "9", 1.0, True), (5, "R17", "tesseract", "7", 0.5, True), (5, "R17", "pyzbar", "", 1.0, True)]
    found = {r["doc_id"]: (r["text"], float(r["score"]), r["source"], r["flags"]) for r in reading.barcodes(spark.createDataFrame(rows, READING), catalogues.regions(spark)).collect()}
    assert found == {1: ("001234", 1.0, "barcode_pyzbar", []), 2: ("1234", 0.6, "barcode_tesseract_ocrb", []), 3: ("", 0.0, "barcode_none", ["barcode_unreadable"]), 4: ("9", 1.0, "barcode_pyzbar", []), 5: ("7", 0.5, "barcode_tesseract_ocrb", [])}


def test_readings_are_dealt_once(spark):
    """From readings to reviewed documents: one scan, one exchange by document, broadcasts beside it."""
    readings = spark.range(1000).selectExpr("id as doc_id", "explode(array('R05', 'R06', 'R17')) as roi_id").selectExpr("*", "'tesseract' as engine", "'1' as text", "0.9D as confidence", "true as available")
    plan = validation.validated(reading.resolved(readings, catalogues.regions(spark)), catalogues.banks(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_routes_are_chosen_before_readings_are_dealt(spark):
    """Regions of other routes reach no exchange and no aggregate."""
    readings = spark.range(1000).selectExpr("id as doc_id", "explode(array('R05', 'R06', 'R17')) as roi_id").selectExpr("*", "'tesseract' as engine", "'1' as text", "0.9D as confidence", "true as available")
    for table in (reading.pairs, reading.singles, reading.barcodes, reading.worklist):
        plan = table(readings, catalogues.regions(spark))._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        exchange, join = plan.index("Exchange hashpartitioning(doc_id"), plan.index("BroadcastHashJoin")
        assert plan.count("Exchange hashpartitioning") == 1 and exchange < join  # the plan's lower lines come first
        assert plan.count("BroadcastHashJoin") == 1 and "route" in plan[exchange:]
    # The catalogue's filter stands at its own scan, under the broadcast.
    dealt = reading.sides(readings, catalogues.regions(spark), "barcode_decoder")
    assert {r["roi_id"] for r in dealt.collect()} == {"R17"}
