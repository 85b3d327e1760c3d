"""Centroid clustering by equal-average equal-variance search, exact in whole numbers.

Centroids are sorted by the sum of their components. A vector starts at its own sum
and takes the nearer centroid of both sides in turn. Two inequalities bound a squared
distance from below: (difference of sums)^2 / d, which ends the scan once it exceeds
the best distance, as all centroids further out differ by more; and that plus the
squared difference of the deviations (roots of the summed squares about the mean),
which skips a single centroid. Only what both let pass is compared, in integers;
bounds are taken with a margin for rounding, so they never drop a nearest centroid.
At equal distances the smaller number wins.

Every round is one scan: tasks send the sums of each centroid, k rows of d numbers
(both are parameters), and the driver gets k x d sums. Assignments need none from the
round before, so nothing but the last one is stored.

Rows with a null vector, with null or non-finite components or with another number of
components are left out. Rows without vec_id are clustered; they start a centroid
only when ids run out. Repeated rows count each. With fewer vectors than centroids
there are as many centroids as vectors; an empty table gives no rows. Columns besides
vec_id and embedding are ignored. Sums beyond 64 bits are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid
from .tables import lean, stored


@dataclass
class Sorted:
    """Centroids in the order of their sums."""

    number: np.ndarray
    rows: np.ndarray
    sums: np.ndarray
    deviation: np.ndarray
    length: np.ndarray


def _spread(x: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Deviation about the mean and Euclidean length of each row."""
    squares = (x * x).sum(1).astype(np.float64)
    return np.sqrt(np.maximum(0, squares - sums.astype(np.float64) ** 2 / x.shape[1])), np.sqrt(squares)


def arranged(centroids: np.ndarray) -> Sorted:
    sums = centroids.sum(1)
    order = np.lexsort((np.arange(len(sums)), sums))
    rows, sums = centroids[order], sums[order]
    return Sorted(order, rows, sums, *_spread(rows, sums))


def nearest(x: np.ndarray, c: Sorted) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to each row's nearest centroid, and how many distances that took."""
    n, d = x.shape
    k, far = len(c.sums), np.iinfo(np.int64).max
    sums = x.sum(1)
    deviation, length = _spread(x, sums)
    right = np.searchsorted(c.sums, sums)
    left = right - 1
    best, who = np.full(n, far), np.full(n, k)
    active, compared = np.arange(n), 0
    while len(active):
        low, high = left[active], right[active]
        below = np.where(low >= 0, sums[active] - c.sums[np.maximum(low, 0)], far)
        above = np.where(high < k, c.sums[np.minimum(high, k - 1)] - sums[active], far)
        up = above < below
        gap = np.where(up, above, below)
        reach = np.sqrt(best[active].astype(np.float64) * d) * (1 + 1e-9) + 1
        open_ = (gap < far) & (gap <= reach)
        active, up, gap = active[open_], up[open_], gap[open_]
        at = np.where(up, right[active], left[active])
        right[active] += up
        left[active] -= ~up
        apart = np.maximum(0, np.abs(deviation[active] - c.deviation[at]) - 1e-7 * (length[active] + c.length[at]) - 1e-6)
        least = gap.astype(np.float64) ** 2 / d * (1 - 1e-9) + apart**2 * (1 - 1e-9) - 1
        close = least <= best[active]
        rows, at = active[close], at[close]
        step = x[rows] - c.rows[at]
        distance = (step * step).sum(1)
        compared += len(rows)
        better = (distance < best[rows]) | ((distance == best[rows]) & (c.number[at] < who[rows]))
        rows, at = rows[better], at[better]
        best[rows], who[rows] = distance[better], c.number[at]
    return who, best, compared


def clustered(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dim: int = 64, seed: str = "1") -> tuple[DataFrame, DataFrame]:
    """(vec_id, cluster, distance) of each vector, and (cluster, centroid, size, inertia) of each centroid.

    Centroids start as the k vectors whose ``seed:vec_id`` has the smallest SHA-256.
    """
    rows = grid.kept(vectors).where(F.size("embedding") == dim)
    first = rows.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    spark, kind = vectors.sparkSession, vectors.schema["vec_id"].dataType.simpleString()
    centroids = grid.whole(pa.array([r[0] for r in first], pa.list_(pa.float64())), dim, scale)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(len(now.number), np.int64), np.zeros((len(now.number), dim), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = grid.whole(batch.column("embedding"), dim, scale)
                who, _, _ = nearest(x, now)
                order = np.argsort(who, kind="stable")
                there, starts = np.unique(who[order], return_index=True)
                sums[there] += np.add.reduceat(x[order], starts)
                count += np.bincount(who, minlength=len(count))
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), grid.lists(sums[some], pa.int64())], ["cluster", "n", "sums"])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                who, distance, _ = nearest(grid.whole(batch.column("embedding"), dim, scale), now)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(who, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    for _ in range(rounds if len(first) else 0):
        now = arranged(centroids)
        parts = rows.mapInArrow(lean(summed), "cluster int, n long, sums array<long>")
        found = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
        centroids = centroids.copy()
        for r in found:
            centroids[r["cluster"], r["at"]] = r["s"] // r["n"]
    now = arranged(centroids)
    result = rows.mapInArrow(lean(assigned), f"vec_id {kind}, cluster int, distance long") if len(first) else rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    result = stored(result, "centroids")
    sizes = {r["cluster"]: (r["n"], r["s"]) for r in result.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).try_cast("long").alias("s")).collect()}
    table = spark.createDataFrame([(i, c.tolist(), *sizes.get(i, (0, 0))) for i, c in enumerate(centroids)], "cluster int, centroid array<long>, size long, inertia long")
    return result, table
