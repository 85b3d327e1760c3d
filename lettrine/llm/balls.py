"""Codes of vectors by parts, with codebooks from ball k-means, exact in whole numbers.

A vector is cut into equal consecutive parts; each part position has a codebook of its
own. Entry i with the parts assigned to it is a ball. Entry j can be nearer than i only
to parts x with |c_i - c_j| <= 2 |x - c_i|, so once centres have moved

* the neighbours of ball i are the entries within twice its radius. The radius about the
  moved centre is at most that about the former one and the way moved, so no scan is
  spent on it;
* a ball that stayed, and that no moved entry neighbours, is skipped;
* the parts of its stable core, within half the way to the nearest neighbour, keep their
  entry;
* the others lie in annular rings: between half the way to the q-th and to the next
  neighbour, only the q nearest neighbours are compared.

Distances are squared whole numbers, so the rings are exact; radii are rounded up. Only
the first round compares all entries. At equal distances the lower index wins.

A round writes the rows with their codes to the shared folder, where the next finds its
balls; tasks send (part, entry) sums and radii, and the driver gets parts x entries of
them, which are parameters.

Rows with a null vector, or with null or non-finite components, are left out; so are
those whose length isn't that of the smallest vec_id's vector, or no multiple of the
number of parts. Rows without vec_id are coded, and start an entry only when ids run
out. Repeated rows count each. With fewer vectors than entries there are as many entries
as vectors. An empty table gives no rows and no entries. Columns besides vec_id, label
and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid
from .tables import lean, stored, with_totals

#: Rows whose parts are worked on at once.
ROWS = 1 << 14
FAR = 1 << 62


@dataclass
class Balls:
    """Of each part position and entry: its centre, and its neighbours by distance."""

    centre: np.ndarray  # parts x entries x width
    order: np.ndarray  # parts x entries x others
    apart: np.ndarray  # squared distances, in this order
    near: np.ndarray  # parts x entries: how many others are neighbours
    still: np.ndarray  # parts x entries: nothing changed here


def square(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(-1)


def balls(centre: np.ndarray, radius: np.ndarray, former: np.ndarray) -> Balls:
    """Of the centres, the squared radii about the former ones, and these."""
    parts, entries, _ = centre.shape
    gaps = square(centre[:, :, None] - centre[:, None])
    own = np.arange(entries)
    gaps[:, own, own] = -1
    order = gaps.argsort(2, kind="stable")[:, :, 1:]
    apart = np.take_along_axis(gaps, order, 2)
    moved = square(centre - former)
    reach = np.array([[min(FAR, (2 * (isqrt(int(r)) + 1 + isqrt(int(m)) + 1)) ** 2) for r, m in zip(*p)] for p in zip(radius, moved)], np.int64).reshape(parts, entries)
    near = (apart <= reach[:, :, None]).sum(2)
    threat = (np.take_along_axis(np.broadcast_to(moved[:, None, :], gaps.shape), order, 2) > 0) & (apart <= 4 * radius[:, :, None])
    return Balls(centre, order, apart, near, (moved == 0) & ~threat.any(2))


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The nearest of all entries for each part: rows x parts."""
    return np.stack([square(x[:, p, None] - centre[p]).argmin(1) for p in range(len(centre))], 1)


def reassigned(x: np.ndarray, codes: np.ndarray, b: Balls) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes and squared distances (rows x parts) after the centres moved, and how many distances to other entries that took."""
    codes, distances, compared = codes.copy(), np.empty(codes.shape, np.int64), 0
    entries = b.centre.shape[1]
    for p in range(codes.shape[1]):
        part, centre, own = x[:, p], b.centre[p], codes[:, p].copy()
        distance = square(part - centre[own])
        best, who, reach = distance.copy(), codes[:, p], 4 * distance
        outer = np.flatnonzero(~b.still[p, own])
        for q in range(entries - 1):
            i = own[outer]
            outer = outer[(q < b.near[p, i]) & (b.apart[p, i, q] <= reach[outer])]  # those in rings beyond the q-th neighbour
            if not len(outer):
                break
            j = b.order[p, own[outer], q]
            d = square(part[outer] - centre[j])
            compared += len(outer)
            better = (d < best[outer]) | ((d == best[outer]) & (j < who[outer]))
            at = outer[better]
            best[at], who[at] = d[better], j[better]
        distances[:, p] = best
    return codes, distances, compared


def coded(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, DataFrame]:
    """(vec_id, label, codes, error) of each vector, and (part, entry, centre) of each codebook entry.

    Codebooks start as the parts of the ``entries`` smallest vec_ids.
    """
    rows = grid.kept(vectors, "label").where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    smallest = lambda df: [r[0] for r in df.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()]
    first = smallest(rows)
    dim = len(first[0]) if first else parts
    rows = rows.where(F.size("embedding") == dim)
    if any(len(r) != dim for r in first):
        first = smallest(rows)
    centre = grid.whole(pa.array(first, pa.list_(pa.float64())), dim, scale).reshape(len(first), parts, dim // parts).swapaxes(0, 1)
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, embedding array<double>, codes array<int>"

    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            yield some, grid.whole(some.column("embedding"), dim, scale).reshape(some.num_rows, parts, -1)

    def step(now: np.ndarray | Balls, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for some, x in (b for batch in batches for b in blocks(batch)):
                if isinstance(now, Balls):
                    codes, distances, _ = reassigned(x, some.column("codes").flatten().to_numpy().reshape(-1, parts).astype(np.int64), now)
                else:
                    codes = nearest(x, now)
                    distances = square(x - now[np.arange(parts), codes])
                names = ["vec_id", "label"] if last else ["vec_id", "label", "embedding"]
                error = [pa.array(distances.sum(1))] if last else []
                yield pa.RecordBatch.from_arrays([*(some.column(n) for n in names), grid.lists(codes, pa.int32()), *error], [*names, "codes", *(["error"] if last else [])])

        return lean(run)

    def summed(now: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            size = now.shape[0] * now.shape[1]
            flat = now.reshape(size, -1)
            count, sums, radius = np.zeros(size, np.int64), np.zeros_like(flat), np.zeros(size, np.int64)
            for some, x in (b for batch in batches for b in blocks(batch)):
                slot = (some.column("codes").flatten().to_numpy().reshape(-1, parts) + np.arange(parts) * now.shape[1]).ravel()
                x = x.reshape(len(slot), -1)
                order = slot.argsort(kind="stable")
                there, starts = np.unique(slot[order], return_index=True)
                sums[there] += np.add.reduceat(x[order], starts)
                radius[there] = np.maximum(radius[there], np.maximum.reduceat(square(x - flat[slot])[order], starts))
                count += np.bincount(slot, minlength=size)
            used = np.flatnonzero(count)
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), pa.array(radius[used]), grid.lists(sums[used], pa.int64())], ["slot", "n", "radius", "sums"])

        return lean(run)

    now: np.ndarray | Balls = centre
    for _ in range(rounds if first else 0):
        rows = stored(rows.mapInArrow(step(now, False), schema), "balls")
        sums = rows.mapInArrow(summed(centre), "slot int, n long, radius long, sums array<long>")
        found = sums.select("slot", "n", "radius", F.posexplode("sums").alias("at", "s")).groupBy("slot", "at").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("s").alias("s")).collect()
        former, centre, radius = centre, centre.copy(), np.zeros(centre.shape[:2], np.int64)
        for r in found:
            part, entry = divmod(r["slot"], centre.shape[1])
            centre[part, entry, r["at"]], radius[part, entry] = r["s"] // r["n"], r["radius"]
        now = balls(centre, radius, former)
    result = rows.mapInArrow(step(now, True), f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes array<int>, error long") if first else rows.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
    books = vectors.sparkSession.createDataFrame([(p, e, c.tolist()) for p, book in enumerate(centre) for e, c in enumerate(book)], "part int, entry int, centre array<long>")
    return stored(result, "balls"), books


def label_errors(codes: DataFrame) -> DataFrame:
    """Adds label_error, the error summed over equal labels, nulls together; NULL where 64 bits don't hold it. A label may have any share of the rows."""
    totals = codes.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return with_totals(codes, totals, "label", "vec_id")
