"""The literal cases of every field standardiser, as rows."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lettrine.functions import parsing as P


def apply(spark, function, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", function(F.col("t")).alias("r"))
    return [r["r"] for r in sorted(rows.collect(), key=lambda r: r["i"])]


def test_rib(spark):
    good = "08 006 0110510000870 41"
    spaced, compact, dashed, wrong, unread, short, empty, null = apply(spark, P.rib, good, good.replace(" ", ""), good.replace(" ", "-"), good[:-2] + "00", "08 006 011051?000870 41", "08006011051", "", None)
    assert all(r["valid"] and r["bank_code"] == "08" and r["error"] is None for r in (spaced, compact, dashed))
    assert not wrong["valid"] and wrong["error"] == "key"
    assert not unread["valid"] and unread["unread"] and unread["account"] == "011051?000870"
    assert short["error"] == empty["error"] == "length" and short["digits"] is None
    assert null is None


def test_rib_key_of_a_multiple(spark):
    number = str(97 * 10**15 // 97 * 97).zfill(18)[-18:]
    assert apply(spark, lambda t: P.rib_key(t), number)[0] == (97 - int(number) * 100 % 97) % 97


@pytest.mark.parametrize(
    "text,value",
    [("3000,000", "3000.000"), ("#5.000.000#", "5000.000"), ("2,893,192", "2893.192"), ("25 000,000 DT", "25000.000"), ("# 3 000.000#", "3000.000"), ("750.500 TND", "750.500"), ("3000", "3000"), ("1.000.000,000", "1000000.000"), ("0,000", "0.000"), ("500,00", "50000")],
)
def test_amount(spark, text, value):
    (r,) = apply(spark, P.amount, text)
    assert r["valid"] and r["value"] == Decimal(value)


def test_amounts_refused(spark):
    errors = [r["error"] for r in apply(spark, P.amount, "3?00,000", "", "-100,000", "##", "12x")]
    assert errors == ["unreadable", "empty", "negative", "empty", "number"]


@pytest.mark.parametrize(
    "text,value",
    [
        ("trois mille dinars", "3000"),
        ("vingt-cinq mille dinars", "25000"),
        ("deux mille huit cent quatre-vingt-treize dinars cent quatre-vingt-douze millimes", "2893.192"),
        ("cinq cents dinars", "500"),
        ("un dinar", "1"),
        ("mille dinars", "1000"),
        ("zéro dinars", "0"),
        ("soixante dix sept dinars", "77"),
        ("quatre vingt dix sept dinars", "97"),
        ("un million deux mille dinars", "1002000"),
        ("quatre-vingts dinars", None),
        ("", None),
        ("blah blah", None),
    ],
)
def test_words(spark, text, value):
    (r,) = apply(spark, P.amount_words, text)
    assert r["value"] == (value and Decimal(value))


def test_dates(spark):
    want = date(2025, 6, 15)
    for r in apply(spark, P.date, "15/06/2025", "15-06-2025", "15.06.2025", "15 06 2025", "2025/06/15", "15/06/25", "15/O6/2025", "l5/06/2025"):
        assert r["valid"] and r["value"] == want and r["normalised"] == "15/06/2025"
    assert apply(spark, P.date, "1/6/2025")[0]["value"] == date(2025, 6, 1)
    errors = [r["error"] for r in apply(spark, P.date, "15/13/2025", "32/06/2025", "30/02/2025", "15/06/1990", "15/06/2040", "15/06", "1/2/3/4", "XX/06/2025", "")]
    assert errors == ["month", "day", "calendar", "year", "year", "parts", "parts", "digits", "parts"]


def test_names(spark):
    a, b, c, d = apply(spark, P.name, "ste  abc\n[STAMP] sarl", "x|y\\z", " | ", "groupe été")
    assert (a["value"], a["company"], a["occluded"]) == ("STE ABC SARL", True, True)
    assert b["value"] == "X Y Z" and not b["company"]
    assert not c["valid"] and c["value"] is None
    assert d["value"] == "GROUPE ÉTÉ" and d["company"]


def test_names_match(spark):
    rows = spark.createDataFrame([("A B C D", "D C B A"), ("A B C D", "A B C"), ("A", None), ("-", "."), ("-", "A")], "a string, b string")
    assert [r[0] for r in rows.select(P.names_match(F.col("a"), F.col("b"))).collect()] == [True, False, False, True, False]


def test_confusions(spark):
    assert apply(spark, P.digit_confusion, "OolI|SsBGZ") == ["0011155862"]
    assert apply(spark, P.date_confusion, "OolI/S") == ["0011/S"]
    assert apply(spark, P.collapse_spaces, "  a \n\t b ") == ["a b"]


def test_white_space_of_unicode_and_legal_forms(spark):
    row = spark.createDataFrame([("1\u00a0234,500", "1\t234,500", "\u202f25\u00a0000,000\u00a0DT ", "01\u00a005\u20092024", "vingt\u00a0cinq\u3000mille\u202fdinars", " ste\u00a0\u2003x ", "ABC CO.LTD", "ABC CO. LTD")], list("abcdefgh")).select(
        *[P.amount(F.col(c))["value"].cast("string").alias(c) for c in "abc"], P.date(F.col("d"))["normalised"].alias("d"), P.amount_words(F.col("e"))["value"].cast("string").alias("e"), P.name(F.col("f"))["value"].alias("f"), *[P.name(F.col(c))["company"].alias(c) for c in "gh"]
    ).first()
    assert tuple(row) == ("1234.500", "1234.500", "25000.000", "01/05/2024", "25000.000", "STE X", True, False)
