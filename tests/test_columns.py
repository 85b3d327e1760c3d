"""Readings as columns: the same results as arrays and rows, by projections instead of folds."""

from pyspark.sql import functions as F

from lettrine.functions import parsing as P
from lettrine.operators import reading as R
from lettrine.plans import QUERIES, checks
from lettrine.sources import fixtures, ingest

SF = "/root/testdata/sf0.001"


def test_columns_resolve_as_arrays_do(spark):
    """Every region of every bill."""
    names = ["text", "score", "source", "flags", "changed"]
    cells = checks.merged_readings(spark, SF).selectExpr("doc_id", "inline(array_compact(cells))")
    columns = checks.merged_columns(spark, SF)
    rows = columns.select("doc_id", F.inline(F.array_compact(F.array(*[F.when(F.col(r).isNotNull(), F.struct(F.lit(r).alias("roi_id"), *[F.col(r)[n].alias(n) for n in names])) for r in columns.columns[1:]]))))
    assert rows.exceptAll(cells).count() == cells.exceptAll(rows).count() == 0 < rows.count()


def test_digits_differ_at_any_length(spark):
    pairs = [("", ""), ("1", ""), ("123", "123"), ("123", "129"), ("1" * 15, "2" * 15), ("1" * 16, "1" * 15 + "9"), ("90" * 20, "09" * 20), ("12" * 40, "13" * 41), ("0" * 46, "0" * 45 + "1"), ("12345678901234567890", "22345678901234567891")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", R.digits_changed(F.col("a"), F.col("b")).alias("n")).collect()
    assert all(r["n"] == sum(x != y for x, y in zip(r["a"], r["b"])) + abs(len(r["a"]) - len(r["b"])) for r in rows)


def test_question_marks_are_filled(spark):
    pairs = [("123", "1?3"), ("1x3", "1?3"), ("12", "12?"), ("", "?"), ("1234", "??34"), ("é2é", "é?é"), ("1", "1")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", R.fill_unread(F.col("a"), F.col("b")).alias("f")).collect()
    digit = lambda a, i: a[i : i + 1] if a[i : i + 1] and a[i] in "0123456789" else "?"
    assert all(r["f"] == "".join(digit(r["a"], i) if c == "?" else c for i, c in enumerate(r["b"])) for r in rows)


def test_steps_give_what_expressions_give(spark):
    texts = [None, "", "1/2/2024", "2024-02-01", "//1/2/24//", "1//2..2024", "O1/lO/2O24", "31/02/2024", "a/b/c", "1/2", "1/2/3/4", "#1.234,500#", "12,345 DT", "?1,234", "-1,234", "Ste A [STAMP] sarl", " | ", "08 006 0000000000001 55", "0?006"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    kinds = {"rib": P.RIB, "date": P.DATE, "amount": P.AMOUNT_STEPS, "name": P.NAME, "amount_words": P.WORDS}
    staged = P.parsed(df, {n: (steps, "t") for n, steps in kinds.items()})
    assert sorted(map(repr, staged.collect())) == sorted(map(repr, df.select("i", "t", *[getattr(P, n)(F.col("t")).alias(n) for n in kinds]).collect()))


def test_no_reading_goes_through_a_fold_of_arrays(spark):
    """Merges and parsers of a few regions are columns: no array of a bill's readings is gathered, none looked up."""
    for name in ("h9_city_rule", "e19_city", "d5_date_order", "c14_merge", "c15_digits_changed", "c19_reading_summary"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and "map_from_entries" not in plan


def test_validated_documents_are_columns(spark):
    """Nor is any whole document merged reading by reading, and tables that meet it are joined before it is."""
    for name in ("e2_best_rib", "f8_last_flags", "e25_explained", "h14_patterns", "f2_audit_summary", "f1_audit_records"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "transform(sides" not in plan and "Join" not in plan[: plan.index("qwen_rejected_divergence")], name


def test_arrived_documents_are_columns(spark):
    """The same of documents that arrive as lines; and good lines aren't kept beside their fields."""
    lines = checks.arrived(spark, SF)
    assert "transform(sides" not in checks.batch(spark, SF, lines)._jdf.queryExecution().optimizedPlan().toString()
    outcomes = ingest.without_good_text(ingest.line_outcomes(fixtures.arrived_lines(spark, SF)))
    assert outcomes.where("error is null and value is not null").count() == 0 < outcomes.where("error is not null and value is not null").count()
