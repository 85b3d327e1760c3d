"""Connected components of an edge table, without gathering edges anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import settled


#: A node's edges are dealt to so many tasks: the centre of a star may have a third of all edges.
SALTS = 16


def _beside(edges: DataFrame, end: str, other: str, how: str) -> DataFrame:
    """The edges with ``low``, the lowest smaller neighbour of their ``end``.

    Minima are aggregated before they are dealt. Edges are dealt by their end and a
    salt that their other end gives, the minima once for each salt. No side is
    broadcast, as its size isn't known.
    """
    lowest = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low"))
    spread = lowest.select("u", "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    salt = F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")
    dealt = edges.withColumn("salt", salt)
    return dealt.join(spread.hint("merge"), (dealt[end] == spread["u"]) & (dealt["salt"] == spread["s"]), how).select("a", "b", "low")


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), in any order and repeated at will -> (node, component), the smallest node of each component of two or more.

    Alternating large-star and small-star steps: every node's larger neighbours,
    then its smaller ones, are hung on the smallest it knows. Edges point from the
    larger end a to the smaller b, so a node's minimum is that of the edges that
    leave it. Only minima are aggregated, so a node of many edges costs partial
    sums and no list. Ends when a round changes nothing, after about as many
    rounds as the logarithm of the longest path. Edges with a null end or from a
    node to itself count for nothing.
    """
    a, b = F.col("a"), F.col("b")
    now = settled(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).alias("mark")
    last = now.agg(mark).first()
    while True:
        large = _beside(now, "b", "a", "left").select("a", F.coalesce("low", "b").alias("b"))
        small = _beside(large, "a", "b", "inner").select(F.inline(F.array(F.struct(b.alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))))
        now = settled(small.where(a != b).distinct())
        found = now.agg(mark).first()
        if found == last:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        last = found
