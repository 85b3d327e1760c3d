"""Set-similarity join of names on an inverted index of their rarest words.

Two names match if they share at least ``threshold`` of all their words (Jaccard). Each
side's distinct word sets are joined, not its rows: equal sets are one, however often
they stand. Words are ordered by how often they occur, rarest first. Sets x and y of m
and n words match only with o = ceil(t (m + n) / (1 + t)) words in common, so

* n lies between t m and m / t (length filter);
* of the common words, the rarest ones lie among the first m - o + k of x and n - o + k
  of y, where k is the number of words looked up at once, at most o (prefix filter).

The index therefore holds, for each set and each feasible length of a partner, the
combinations of k words from that prefix, and its keys name both lengths. A frequent word
is looked up alone only where a set has no other, and then o is 1 and both sets are that
word; otherwise it stands beside the set's k - 1 rarest. Candidates are then compared
as a whole.

Word counts meet the words of sets by a join; words with more than 1/256 of all
occurrences, fewer than 256, are looked up in one small row instead, so no task gets a
frequent word's sets. Names that are null or have no word match nothing.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations
from math import ceil, comb, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrine.sources.shared import stored

#: Words looked up at once.
TOGETHER = 3
#: Entries of a set for partners of one length, at most, unless one word is looked up at once.
ENTRIES = 64
HOT = 256


def words(name: Column) -> Column:
    """The distinct words of a name, in order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(name, F.lit(r"(?U)\w+"), 0)))


def _ranked(sets: DataFrame) -> DataFrame:
    """Adds ``ranked``, the words of each set (words) by rarity."""
    each = sets.select("words", F.explode("words").alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    hot = counts.crossJoin(F.broadcast(total)).where(F.col("n") * HOT > F.col("total"))
    hot = hot.agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("hot"))  # one row of fewer than HOT words
    known = F.broadcast(hot)
    rare = each.crossJoin(known).where(~F.map_contains_key("hot", F.col("word"))).drop("hot")
    counted = rare.join(counts, "word").groupBy("words").agg(F.collect_list(F.struct("n", "word")).alias("rare"))
    frequent = F.transform(F.filter("words", lambda w: F.map_contains_key("hot", w)), lambda w: F.struct(F.element_at("hot", w).alias("n"), w.alias("word")))
    whole = sets.crossJoin(known).join(counted, "words", "left").select("words", F.array_sort(F.concat(F.coalesce("rare", F.array().cast("array<struct<n:bigint,word:string>>")), frequent)).alias("r"))
    return whole.select("words", F.transform("r", lambda s: s["word"]).alias("ranked"))


def _plans(longest: int, threshold: Fraction) -> list[tuple[int, int, int, int]]:
    """(m, n, o, k) of all lengths that can match."""
    out = []
    for m in range(1, longest + 1):
        for n in range(ceil(threshold * m), min(longest, floor(m / threshold)) + 1):
            common = ceil(threshold * (m + n) / (1 + threshold))
            spare = max(m, n) - common
            out.append((m, n, common, max(k for k in range(1, min(TOGETHER, common) + 1) if k == 1 or comb(spare + k, k) <= ENTRIES)))
    return out


def _keys(sets: DataFrame, plans: list, left: bool) -> DataFrame:
    """words and key: an entry of the index for each combination and feasible length of a partner."""
    rows = [(m if left else n, m, n, list(c)) for m, n, common, k in plans for c in combinations(range((m if left else n) - common + k), k)]
    places = sets.sparkSession.createDataFrame(rows, "own int, m int, n int, places array<int>")  # its size is that of the longest set, not of the tables
    key = F.struct("m", "n", F.transform("places", lambda i: F.get("ranked", i)).alias("chosen"))
    return sets.join(F.broadcast(places), F.size("ranked") == F.col("own")).select("words", key.alias("key"))


def similar_sets(left: DataFrame, right: DataFrame, threshold: str = "0.8", longest: int | None = None) -> DataFrame:
    """(left_words, right_words) of the distinct word sets (column words) that match.

    ``longest`` is the number of words of the longest set; without it a pass finds it.
    """
    t = Fraction(threshold)
    one, two = (stored(side.select("words").where(F.size("words") > 0).distinct(), "word_sets") for side in (left, right))
    if longest is None:
        longest = one.union(two).agg(F.max(F.size("words"))).first()[0] or 0
    if not longest:
        return one.select(F.col("words").alias("left_words"), F.col("words").alias("right_words"))
    plans = _plans(longest, t)
    ranked = stored(_ranked(one.union(two).distinct()), "ranked")
    a = _keys(one.join(ranked, "words"), plans, True).withColumnRenamed("words", "left_words")
    b = _keys(two.join(ranked, "words"), plans, False).withColumnRenamed("words", "right_words")
    both = F.size(F.array_intersect("left_words", "right_words"))
    enough = both * t.denominator >= t.numerator * (F.size("left_words") + F.size("right_words") - both)
    return a.join(b, "key").select("left_words", "right_words").distinct().where(enough)


def similar_names(left: DataFrame, right: DataFrame, threshold: str = "0.8") -> DataFrame:
    """Rows of ``left`` (with column left_name) beside the distinct names of ``right`` (right_name) that match, and ``times``, how often those stand there.

    Repeated names of the right side aren't written out; a left row is, with each of its partners.
    """
    one = left.withColumn("left_words", words(F.col("left_name")))
    two = stored(right.groupBy("right_name").agg(F.count("*").alias("times")), "names").withColumn("right_words", words(F.col("right_name")))
    pairs = similar_sets(one.select(F.col("left_words").alias("words")), two.select(F.col("right_words").alias("words")), threshold)
    return one.join(pairs, "left_words").join(two, "right_words").drop("left_words", "right_words")
