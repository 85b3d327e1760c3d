"""The set-similarity join of names against all pairs."""

import random
from fractions import Fraction

import pytest

from lettrine.operators import matching


def brute(left, right, t=Fraction(4, 5)):
    return {(a, b) for a in left for b in right if a and b and len(a & b) >= t * len(a | b)}


def sets(spark, rows):
    return spark.createDataFrame([(sorted(r),) for r in rows], "words array<string>")


def joined(spark, left, right, t="0.8"):
    return {(frozenset(r[0]), frozenset(r[1])) for r in matching.similar_sets(sets(spark, left), sets(spark, right), t).collect()}


@pytest.mark.parametrize("threshold", ["0.8", "0.5", "1"])
def test_against_all_pairs(spark, threshold):
    pick = random.Random(5)
    vocabulary = [f"w{i}" for i in range(14)]
    left = [frozenset(pick.sample(vocabulary, pick.randint(1, 12))) for _ in range(120)]
    right = [frozenset(pick.choice(left) ^ frozenset(pick.sample(vocabulary, pick.randint(0, 2)))) for _ in range(120)]
    left += left[:5] + [frozenset()]
    assert joined(spark, left, right, threshold) == brute(left, right, Fraction(threshold))


def test_nothing(spark):
    assert joined(spark, [], []) == set() and joined(spark, [frozenset("a")], []) == set() and joined(spark, [frozenset()], [frozenset()]) == set()


def test_words_that_all_names_have_give_no_pairs_of_all(spark, monkeypatch):
    """Names of four common words and one of their own, and some with another common word: candidates stay as few as names."""
    common = [f"common{i}" for i in range(4)]
    left = [frozenset([*common, f"l{i}" if i % 2 else f"b{i}"]) for i in range(400)]
    right = [frozenset([*common, f"r{i}" if i % 2 else f"b{i}"]) for i in range(400)]
    seen = []
    plans, t = matching._plans(5, Fraction(4, 5)), Fraction(4, 5)
    ranked = matching._ranked(sets(spark, set(left) | set(right)))
    one, two = (matching._keys(sets(spark, set(s)).join(ranked, "words"), plans, side) for s, side in ((left, True), (right, False)))
    seen = one.withColumnRenamed("words", "other").join(two, "key").count()
    assert seen <= 2 * 400
    assert joined(spark, left, right) == brute(left, right, t) and len(brute(left, right, t)) == 200


def test_long_sets_take_no_more_entries(spark):
    plans = matching._plans(60, Fraction(4, 5))
    assert all(k == 1 or max(m, n) <= 14 or o >= k for m, n, o, k in plans)
    words = [f"w{i}" for i in range(60)]
    left, right = [frozenset(words), frozenset(words[:30])], [frozenset(words[:50]), frozenset(words[4:]), frozenset(words[:24]), frozenset(words[:23])]
    assert joined(spark, left, right) == brute(left, right)


def test_names(spark):
    left = spark.createDataFrame([(1, "STE A B"), (1, "STE A B"), (2, None), (3, "|"), (4, "ÉTÉ CO")], "k int, left_name string")
    right = spark.createDataFrame([("B, A STE",), ("B, A STE",), ("STE A",), (None,), ("",), ("CO ÉTÉ",)], "right_name string")
    found = sorted(tuple(r) for r in matching.similar_names(left, right).select("k", "left_name", "right_name", "times").collect())
    assert found == [(1, "STE A B", "B, A STE", 2), (1, "STE A B", "B, A STE", 2), (4, "ÉTÉ CO", "CO ÉTÉ", 1)]
