"""MinHash near-duplicates with tensored banding, candidates verified on full sets.

Two small collections of half keys, each of ``WIDTH`` minimum hashes, are
computed for a set; every pair of one from either collection keys a table. So
2 x HALVES x WIDTH minimum hashes serve HALVES x HALVES tables: at similarity
0.8 a pair of sets shares none of them with a probability of 0.00007.

Equal sets are one node from the start. Each bucket links its members to two
leaders, never to each other; the links are verified exactly. Where a
bucket still holds several components, its nodes pass through an exact filter:
of sets ordered by rarity, two that are similar enough share one of their first
few shingles, and only pairs of different components are verified.
What is shuffled is keys and links; full sets move for candidates alone.

Shingles, sets and nodes are told apart by 64-bit hashes that mix every 8 bytes
of a word, and word after word. Null texts and texts without words have empty
sets, linked with nothing; documents without doc_id stay alone, with a null
component; repeated rows are linked with each other and keep one result each, as
do rows of one doc_id with different texts; the smallest doc_id wins all ties;
an empty table gives no rows; extra columns stay out. Very long texts are sets
like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import bitmap, lean, set_bits, settled, slices, slot_of
from .words import hashes, mixed, sorted_set, words

HALVES = 10
WIDTH = 2
_U = np.uint64
#: Sizes of the two tables of numbers that reach the driver and all tasks, whatever the input's size.
FILTER_SLOTS = 1 << 26
RARITY_SLOTS = 1 << 20


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of ``size`` words; with fewer words the whole sequence is one."""
    data, starts, ends, first = words(texts)
    own = hashes(data, starts, ends)
    n = len(own)
    with np.errstate(over="ignore"):
        chained = mixed(np.full(n, size, np.uint64))
        for k in range(min(size, n)):
            chained[: n - k] = mixed(chained[: n - k] * _U(0xD6E8FEB86659FD93) + own[k:], k + 1)
        out = []
        for a, b in zip(first.tolist(), first[1:].tolist()):
            if b - a >= size:
                out.append(sorted_set(chained[a : b - size + 1]))
            elif b > a:  # the number of words tells such sequences from shingles
                h = np.array([1000 + b - a], np.uint64)
                for k in range(a, b):
                    h = mixed(h * _U(0xD6E8FEB86659FD93) + own[k], 100 + k - a)
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def half_keys(sets: list[np.ndarray]) -> np.ndarray:
    """2 x HALVES keys for each set, none of which is empty; a key is made of WIDTH minimum hashes."""
    flat = np.concatenate(sets)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.zeros((len(sets), 2 * HALVES), np.uint64)
    factors = mixed(np.arange(1, out.shape[1] * WIDTH + 1, dtype=np.uint64), 77) | _U(1)
    with np.errstate(over="ignore"):
        for k in range(out.shape[1]):
            for w in range(WIDTH):
                out[:, k] = mixed(out[:, k] + np.minimum.reduceat(flat * factors[k * WIDTH + w], at), w + 1)
    return out


def node_of(items: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mixed(np.add.reduce(mixed(items, 5), keepdims=True) + _U(len(items)), 6).view(np.int64)[0])


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, row (hash of doc_id and text), n (size of the set), node (hash of the set, null for empty) and halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows, texts in slices(batches, ["doc_id", "row", "text"]):
            sets = shingle_sets(texts, size)
            full = [s for s in sets if len(s)]
            keys = iter(half_keys(full).view(np.int64).tolist() if full else [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "row", "n", "node", "halves"],
            )

    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text").mapInArrow(lean(run), "doc_id long, row long, n long, node long, halves array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, items (sorted hashes) and n of the wanted (node, rep), rep being a document that has the set.

    A bit for each hash of a wanted document goes to all tasks, so that other
    texts are passed over where they are read; the join is exact.
    """
    bits = bitmap(wanted, "rep", FILTER_SLOTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(set_bits(bits, batch.column("slot").to_numpy())))
            for (texts,) in slices([batch], ["text"]):
                sets = [s for s in shingle_sets(texts, size) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), _lists(sets)], ["node", "items"])

    found = docs.where("doc_id is not null and text is not null").select(slot_of(F.col("doc_id"), FILTER_SLOTS).alias("slot"), "text").mapInArrow(lean(run), "node long, items array<long>")
    return found.join(wanted.select("node").distinct(), "node").groupBy("node").agg(F.first("items").alias("items")).withColumn("n", F.size("items"))


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def verified(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose intersection is at least the share ``least`` (as a fraction) of the union. Sizes are looked at first."""
    above, below = least
    side = lambda name, items, n: sets.select(F.col("node").alias(name), F.col("items").alias(items), F.col("n").alias(n))
    sized = pairs.join(side("b", "two", "nb"), "b").join(side("a", "one", "na"), "a").where(F.least("na", "nb") * below >= F.greatest("na", "nb") * above)
    common = F.size(F.array_intersect("one", "two"))
    return sized.where(common * (above + below) >= (F.col("na") + F.col("nb")) * above).select("a", "b")


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("items").flatten().to_numpy().view(np.uint64)


def _slots(items: np.ndarray) -> np.ndarray:
    return (items & _U(RARITY_SLOTS - 1)).astype(np.int64)


def rest_pairs(sets: DataFrame, roots: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs of nodes in different components that may be similar enough, by their rarest shingles.

    ``roots``: node, root. Of sets ordered by rarity, the first shingle that two
    have in common bounds what they can share: what follows it in either. So it
    stands near enough to the start of both for their sizes, and in the smaller
    one nearer still. Rarity is counted in RARITY_SLOTS slots by hash; any order
    that all sets share keeps this exact.
    """
    above, below = least

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(RARITY_SLOTS, np.int64)
        for batch in batches:
            sums += np.bincount(_slots(_flat(batch)), minlength=RARITY_SLOTS)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[used], pa.int64())], ["slot", "n"])

    rows = sets.select("items").mapInArrow(lean(count), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    rarity = np.zeros(RARITY_SLOTS, np.int64)
    rarity[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    ranks = np.argsort(np.argsort(rarity, kind="stable")).astype(np.uint32).tobytes()

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(ranks, np.uint32)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                flat, sizes = _flat(batch), batch.column("items").value_lengths().to_numpy()
                of = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((flat, rank[_slots(flat)], of))
                place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first = place < sizes[of] - -(-sizes[of] * above // below) + 1
                of, place, item = of[first], place[first], flat[order[first]].view(np.int64)
                node, root = (batch.column(c).to_numpy()[of] for c in ("node", "root"))
                yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(node), pa.array(root), pa.array(sizes[of].astype(np.int64)), pa.array(place)], ["item", "node", "root", "n", "i"])

    listed = settled(sets.select("node", "items").join(roots, "node").mapInArrow(lean(prefixes), "item long, node long, root long, n long, i long"))
    mixed_lists = listed.groupBy("item").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("item")
    rest = listed.join(mixed_lists, "item")
    smaller, other = rest.where(F.col("i") * (above + below) <= F.col("n") * (below - above)).alias("a"), rest.alias("b")
    left = F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))
    near = (F.col("a.n") <= F.col("b.n")) & (F.col("b.n") * above <= F.col("a.n") * below) & (left * (above + below) >= (F.col("a.n") + F.col("b.n")) * above)
    found = smaller.join(other, (F.col("a.item") == F.col("b.item")) & (F.col("a.root") != F.col("b.root")) & near)
    return found.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links), kept (it is the document's own), row and chosen.

    ``row`` is a hash of doc_id and text; ``chosen`` tells the rows to keep of a
    table that may hold a doc_id more than once: of a component one set of
    shingles, that of the smallest doc_id, and all rows linked with nothing.
    """
    signed = settled(signatures(docs, size))
    nodes = signed.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("halves").alias("halves"))
    left, right = F.slice("halves", 1, HALVES), F.slice("halves", HALVES + 1, HALVES)
    keys = F.flatten(F.transform(left, lambda x, i: F.transform(right, lambda y, j: F.xxhash64(i, j, x, y))))
    tables = nodes.select("node", F.explode(keys).alias("key")).repartition("key")  # one shuffle for both uses below
    shared = tables.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    buckets = settled(tables.join(shared, "key"))
    reps = nodes.select("node", "rep")

    # A family's first document and the one that shares most tables are near most of the others.
    known = settled(buckets.groupBy("node").agg(F.count("*").alias("tables")).join(reps, "node"))
    leaders = buckets.join(known, "node").groupBy("key").agg(F.min(F.struct("rep", "node")).alias("first"), F.min(F.struct(-F.col("tables"), "rep", "node")).alias("central"))
    stars = buckets.join(leaders, "key").select("node", F.explode(F.array("first.node", "central.node")).alias("leader")).where("node != leader")
    pairs = settled(stars.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct())
    sets = settled(sets_of(docs, known, size))
    links = settled(verified(pairs, sets, least))
    found = components(links)

    rooted = buckets.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("root"))
    unsettled = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    open_nodes = settled(rooted.join(unsettled, "key").select("node", "root").distinct())
    rest = rest_pairs(sets, open_nodes, least).join(pairs, ["a", "b"], "left_anti")
    more = settled(verified(rest, sets, least))
    found = components(links.union(more)) if more.limit(1).count() else found

    rooted = reps.join(found, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min(F.struct("rep", "node")).alias("first"))
    label = rooted.join(smallest, "root").select("node", F.col("first.rep").alias("smallest"), (F.col("node") == F.col("first.node")).alias("best"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == own, F.lit(True))
    return signed.join(label, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), kept.alias("kept"), "row", (kept & F.coalesce("best", F.lit(True))).alias("chosen"))
