"""Queries against their SQL on the smallest tables."""

import datetime
import decimal
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from lettrine import plans

ROOT = Path(__file__).parents[1]
SF = "/root/testdata/sf0.001"
#: One or two of each kind; the others share their steps.
CHOSEN = ["a2_bank_catalogue", "a4_doc_id", "a7_word_boxes", "a8_model_responses", "a11_audit_log", "a14_failed_documents", "a14_line_outcomes", "b1_region_boxes", "b5_alignment", "b8_distinct_stamps", "b11_affected_regions", "c4_whitelist", "c8_worklist", "c14_merge", "c16_best_variant", "c19_reading_summary", "d1_rib", "d4_dates", "d12_amount_words", "d16_name_match", "d16_name_join", "e12_flags", "e15_review", "e26_document", "f1_audit_records", "f2_summary_by_day", "f3_run_totals", "f6_batch_index", "f9_field_rows", "f11_overview", "f12_review_queue", "g1_readings_stream", "h6_calls_sketch", "h7_accuracy_by_stratum", "h13_calibration", "h14_patterns"]


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return round(float(value), 6)
    return str(value)[:10] if isinstance(value, datetime.date) else value


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("the synthetic tables are not here")
    db = duckdb.connect()
    for name in ("orders", "customer", "nation"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, duck, name):
    found = plans.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    wanted = duck.sql(plans.ORACLE_SQL[name])
    assert sorted(wanted.columns) == columns
    at = [wanted.columns.index(c) for c in columns]
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in found.collect()), key=repr)
    assert mine == sorted((tuple(plain(r[i]) for i in at) for r in wanted.fetchall()), key=repr)


def test_word_boxes_hold_every_word(spark, duck):
    """Against the readings' own words, worked out here."""
    wanted, longest = {}, 0
    for r in plans.QUERIES["a6_readings"](spark, SF).where("engine = 'tesseract'").collect():
        words = list(enumerate(r["text"].split(" "), 1))
        boxes = [(w, (r["doc_id"] * 3 + i * 17) % 101) for i, w in words if w and (r["doc_id"] + i) % 13]
        wanted[r["doc_id"], r["roi_id"]] = (" ".join(w for w, _ in boxes), round(sum(c for _, c in boxes) / max(1, len(boxes)) / 100, 6))
        longest = max(longest, len(words))
    assert longest == 9
    assert {(r["doc_id"], r["roi_id"]): (r["text"], round(r["confidence"], 6)) for r in plans.QUERIES["a7_word_boxes"](spark, SF).collect()} == wanted


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE_SQL) and len(plans.QUERIES) > 100


def test_entry_works_without_the_training_data_package(tmp_path):
    """As if its folder and corpus_pipeline.py had been deleted."""
    code = "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['lettrine.llm'] = None; import __spark_entry__ as e; names = e.queries(); assert 'e12_flags' in names and not [n for n in names if n.startswith('op')]; assert set(e.oracle_sql()) == set(names)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=60)


def test_nothing_else_imports_it():
    for path in (ROOT / "lettrine").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()
