"""Plans that stay as small as what is asked for."""

import re

import duckdb
from pyspark.sql import functions as F

from lettrine.functions import parsing as P
from lettrine.operators import validation as V
from lettrine.plans import checks, measures, reports

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def by_columns(df):
    """No document is merged reading by reading, and nothing is joined to what is made of it."""
    plan = optimized(df)
    return "transform(sides" not in plan and "Join" not in plan[: plan.index("qwen_rejected_divergence")]


def test_flag_rows_infer_no_filter(spark):
    """A filter on the flags would be pushed down, with all that they are made of written into it; documents without flags give no rows all the same."""
    rows = [(1, [(2, "rib", "INCONSISTENCY", "a", True), (7, "amount", "INCONSISTENCY", "b", False)]), (2, []), (3, None)]
    found = V.flag_rows(spark.createDataFrame(rows, f"doc_id long, flags array<{V.FLAG}>"))
    assert "Filter" not in optimized(found)
    assert sorted(map(tuple, found.collect())) == [(1, 2, "rib", "INCONSISTENCY", "a", True), (1, 7, "amount", "INCONSISTENCY", "b", False)]


def test_patterns_take_every_correction(spark, monkeypatch):
    """Of all bills, as many as the SQL's pairs that aren't right."""
    db = duckdb.connect()
    for name in ("orders", "customer", "nation"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    wanted = db.sql(measures._P + "SELECT count(*) FROM pp WHERE NOT correct").fetchall()[0][0]
    monkeypatch.setattr(measures.M, "correction_patterns", lambda corrections: corrections)
    assert measures.h14_patterns(spark, SF).count() == wanted > 0
    assert "% 3 = 0" not in measures._PATTERNS[measures._PATTERNS.index("k0 AS") :]


def test_review_queue_is_of_columns(spark, monkeypatch):
    monkeypatch.setattr(reports.U, "_written", lambda rows, path, **totals: rows.withColumn("waiting", reports.F.lit(0)))
    assert by_columns(reports.f12_review_queue(spark, SF))


def test_mismatches_are_of_columns(spark):
    """The choice of rows is no filter, and regions that have no part in it aren't made."""
    found = measures.h8_words_mismatches(spark, SF)
    assert by_columns(found) and "R05" not in optimized(found)


def test_strata_are_of_columns(spark):
    """Stamped fields come beside the bill, and a pair is counted once before every choice of strata is."""
    plan = optimized(measures.h7_accuracy_by_stratum(spark, SF))
    assert "transform(sides" not in plan and plan.index("Expand") < plan.index("Generate inline")
    assert plan[: plan.index("Generate inline")].count("Aggregate") == 2 and "Join" not in plan[: plan.index("qwen_rejected_divergence")]


class Stored(Exception):
    pass


def stored(monkeypatch, query, spark):
    """What the query stores first."""

    def stop(df, name):
        raise Stored(df)

    monkeypatch.setattr(reports.shared, "stored", stop)
    try:
        query(spark, SF)
    except Stored as found:
        return found.args[0]


def test_logged_records_are_of_columns(spark, monkeypatch):
    assert by_columns(stored(monkeypatch, reports.a11_audit_log, spark))


def test_states_are_made_of_columns(spark, monkeypatch):
    """Of the lines as they arrive; these are stored too, so what stands for that comes first."""
    lines = reports.checks.arrived(spark, SF)
    monkeypatch.setattr(reports.checks, "arrived", lambda *_: lines)
    assert "transform(sides" not in optimized(stored(monkeypatch, reports.f2_summary_by_day, spark))


def test_streamed_documents_are_of_columns(spark, monkeypatch):
    """What is made of the stream's log: its arrays are read into columns once."""
    log = spark.createDataFrame([(1, [("R05", "tesseract", "08 006", 0.5, True, None)])], reports.reading_stream.DOCUMENT.replace("complete boolean, ", ""))
    monkeypatch.setattr(reports.fixtures, "write_arrivals", lambda *_: 1)
    monkeypatch.setattr(reports.reading_stream, "run", lambda *_, **__: type("Query", (), {"awaitTermination": lambda self: None})())
    monkeypatch.setattr(reports.U, "read_log", lambda *_: log)
    found = reports.g1_readings_stream(spark, SF)
    assert by_columns(found) and found.count() == 1


def test_no_pattern_is_compiled_for_a_row(spark):
    """Java splits at a single plain character without a pattern; and white space is found the same way whatever character stands there."""
    kinds = {n: getattr(P, n)(F.col("t")).alias(n) for n in ("date", "amount_words")}
    texts = [f"{c}1{c}2{c}2024{c}" for c in P.SPACES + "/.-"] + ["1a2a2024", "vingt cinq  mille,dinars"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", P.stripped(F.col("t")).alias("bare"), *kinds.values())
    splits = re.findall(r"split\(.*?, (.{1,3}?), -1\)", optimized(df))
    assert splits and set(splits) <= {"/", " "}
    rows = {r["t"]: r for r in df.collect()}
    assert all(rows[t]["date"]["normalised"] == "01/02/2024" for t in texts[:-2]) and not rows["1a2a2024"]["date"]["valid"]
    assert all(rows[t]["bare"] == t[1:-1] for t in texts[: len(P.SPACES)]) and rows[texts[-1]]["amount_words"]["value"] == 25000


def test_documents_are_read_back_once(spark):
    """The JSON is parsed once for a document, and not once for each value."""
    plan = optimized(checks.a10_document_json(spark, SF))
    assert "get_json_object" not in plan and plan.count("from_json") == 1
