"""What keeps work in proportion to the input: even tasks, arrays of a document's readings, nothing worked out twice."""

import re

from pyspark.sql import functions as F

from lettrine.operators import reading
from lettrine.plans import checks
from lettrine.sources import catalogues, fixtures, ingest

SF = "/root/testdata/sf0.001"
READING = "doc_id long, roi_id string, engine string, text string, confidence double, available boolean, error string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_orders_of_one_part_are_dealt_in_shares(spark, monkeypatch):
    """Tasks of equal size however the file is cut; 1,500 orders in shares of 100."""
    monkeypatch.setattr(fixtures, "SHARE", 100)
    parts = fixtures._tables(spark, SF, "orders")["orders"].rdd.glom().map(len).collect()
    assert len(parts) == 15 and max(parts) <= 2 * min(parts)


def test_readings_are_those_of_the_sql(spark):
    """Bill by bill in one row each, and as the statement that DuckDB runs too gives them."""
    wanted = spark.sql(fixtures.BILLS + fixtures.READINGS, **fixtures._tables(spark, SF, "orders", "customer", "nation"))
    found = fixtures.readings(spark, SF)
    assert found.columns == wanted.columns and found.count() == wanted.count() == 42686
    assert found.exceptAll(wanted).count() == 0
    some = fixtures.readings(spark, SF, "R04", "R14", "R17")
    assert some.exceptAll(wanted).count() == 0 and some.count() == wanted.where("roi_id in ('R04', 'R14', 'R17')").count()


def test_arrays_resolve_as_rows_do(spark):
    """A document's readings in several arrays, some of them repeated, of unknown regions or engines."""
    rows = [(1, "R05", "tesseract", "08?06", 0.5, True, None), (1, "R05", "qwen", "0?006", 0.7, True, None), (1, "R05", "qwen", "08006", 0.7, True, None), (1, "R02", "tesseract", None, 0.5, True, None), (1, "R02", "tesseract", "1/2/2024", 0.5, False, None),
            (1, "R99", "tesseract", "x", 0.5, True, None), (1, "R17", "pyzbar", "77", 1.0, True, None), (2, "R04", "qwen", "TUNIS", 0.7, None, None), (3, "R99", "qwen", "x", 0.7, True, None), (4, "R06", "other", "1", 0.5, True, None), (5, "R10", "qwen", "1", 0.5, True, None), (6, None, "qwen", "1", 0.5, True, None)]
    flat = spark.createDataFrame(rows, READING)
    sets = flat.selectExpr("doc_id", f"array(cast(struct(roi_id, engine, text, confidence, available, error) as {fixtures.READING})) as readings")
    regions = catalogues.regions(spark)
    as_rows = lambda df: sorted(map(repr, df.collect()))
    assert as_rows(reading.resolved(sets, regions)) == as_rows(reading.resolved(flat, regions)) and reading.resolved(sets, regions).count() == 4
    assert as_rows(reading.pairs(sets, regions)) == as_rows(reading.pairs(flat, regions))
    assert {r["doc_id"] for r in reading.resolved_documents(sets, regions).collect()} == {1, 2}


def test_engines_are_merged_once(spark):
    """No filter repeats the merge, and bills reach their exchange as one row each."""
    found = plan(checks.merged_readings(spark, SF).selectExpr("doc_id", "inline(array_compact(cells))"))
    assert found.count("qwen_rejected_divergence") == 1 and found.count("Exchange hashpartitioning") == 1
    assert "Filter (size" not in plan(reading.sides(fixtures.reading_sets(spark, SF), catalogues.regions(spark)))


def test_lines_are_parsed_once(spark):
    """A filter on what has come of a line doesn't parse it again, and good ones keep their readings together."""
    good, failures = ingest.split_lines(fixtures.arrived_lines(spark, SF))
    for df in (good, failures):
        assert plan(df).count("from_json") == 1
    documents, also = ingest.split_documents(ingest.line_outcomes(fixtures.arrived_lines(spark, SF)))
    assert also.exceptAll(failures).count() == failures.exceptAll(also).count() == 0
    rows = documents.selectExpr("doc_id", "inline(array_compact(readings))").select(good.columns)
    assert rows.exceptAll(good).count() == good.exceptAll(rows).count() == 0


def test_documents_are_dealt_while_they_are_orders(spark):
    """Whole documents, stamps, pages and runs meet by document without a further exchange of what was made of the orders."""
    found = plan(checks.assembled(spark, SF))
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", found)) == {"o_orderkey", "k"}


def test_arrivals_are_written_by_many_tasks(spark, monkeypatch, tmp_path):
    """Files of a step grow in number with the orders, and not in size."""
    monkeypatch.setattr(fixtures, "SHARE", 100)
    files = fixtures.write_arrivals(spark, SF, str(tmp_path / "in"))
    rows = [r["n"] for r in spark.read.parquet(str(tmp_path / "in")).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert files == 5 and len(rows) == 16 and sum(rows) == 42687 and max(rows) < 42687 / 10
