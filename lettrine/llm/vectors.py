"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards.

Equal vectors of one label are one node with a multiplicity. Pivots, one for
about SHARD nodes of a label and taken from the nodes by hash, so that a dense
region gets many, make the clusters; a node lies in the shards of its OVERLAP
nearest pivots, the nearest being its home. Every shard builds a graph: candidates
are the nearest and some random nodes, robust pruning keeps those that no kept
one is nearer to. Adjacency lists of a node from all its shards are united. A
second pass over the shards searches the united graph for all nodes at once,
best first from the medoid (and, as every query is a node too, from its own
place) along edges and then expanding everything in range, with cosines in
double precision.

What the search reaches decides what is compared. A node for which it finds no
partner goes no further. The others are packed into blocks of about BLOCK; two
blocks meet where the search found a link between homes of theirs, and from there
the range is widened block by block, along such links, as long as the angle
between two blocks' centres doesn't exceed both radii and the angle of the least
cosine. Blocks that meet are compared exactly, which verifies the links and
counts those between nodes that share no shard. Every pair of nodes meets in one
task at most; tasks give counts and spanning links, so no pairs are written.

What can be missed is a node none of whose partners shares a shard with it, and
blocks in range that no chain of found links joins; ``audit`` measures it.
Labels of up to MOST nodes are one shard. In a region where everything links,
work grows with the square of its distinct vectors.

Two vectors link if their labels are equal and their cosine reaches the least.
Vectors that are null, zero or hold null or non-finite numbers, and rows without
a label, link with nothing; vectors of different lengths don't link. Rows
without vec_id count for nothing and get a null component. Repeated rows are
linked copies; an empty table gives no rows; extra columns are ignored.

Pivots are sent to all tasks, about MOST_PIVOTS of them at most: the index is
fitted on that bounded sample. Cells of more than MOST nodes become several shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import lean, settled

SHARD = 100
#: Nodes of a shard at most, on average, after large ones are dealt.
MOST = 1600
#: Cosines worked out at once.
PAIRS = 1 << 15
BLOCK = 4096
ROWS = 256
SLACK = 1e-6
OVERLAP = 4
MOST_PIVOTS = 1 << 16
DEGREE = 24
NEAREST, RANDOM = 40, 16
BEAM = 24
ALPHA = 1.2


def unit(rows: list) -> np.ndarray:
    x = np.array([np.asarray(r, np.float64) for r in rows])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def robust_graph(x: np.ndarray, seed: int = 1) -> np.ndarray:
    """Neighbours of each row, DEGREE at most, -1 where fewer are kept.

    Of the candidates the nearest is kept, and those dropped that are ALPHA times
    nearer to it than to the row itself; and so on.
    """
    n = len(x)
    distance = np.maximum(0, 2 - 2 * (x @ x.T)).astype(np.float32)
    np.fill_diagonal(distance, np.inf)
    k = min(n - 1, NEAREST)
    if k < 1:
        return np.full((n, 1), -1)
    near = np.argpartition(distance, k - 1, axis=1)[:, :k]
    far = np.random.default_rng(seed).integers(0, n, (n, RANDOM))
    candidates = np.concatenate((near, far), 1)
    own = np.take_along_axis(distance, candidates, 1)
    open_ = np.isfinite(own)
    out = np.full((n, DEGREE), -1)
    for step in range(DEGREE):
        left = np.where(open_, own, np.inf)
        pick = left.argmin(1)
        rows = np.flatnonzero(np.isfinite(left[np.arange(n), pick]))
        if not len(rows):
            break
        chosen = candidates[rows, pick[rows]]
        out[rows, step] = chosen
        # Squared distances, so ALPHA is squared too; a chosen one drops itself.
        between = distance[chosen[:, None], candidates[rows]]
        between[candidates[rows] == chosen[:, None]] = 0
        open_[rows] &= ALPHA**2 * between > own[rows]
    return out


def range_search(x: np.ndarray, graph: np.ndarray, least: float) -> np.ndarray:
    """Rows x rows: which rows the search from the medoid and its own place finds for each row with a cosine of at least ``least``.

    All rows search at once, and a cosine is worked out only where a search arrives over an edge.
    """
    n = len(x)
    edges = np.zeros((n, n), np.float32)
    rows, _ = np.nonzero(graph >= 0)
    edges[rows, graph[graph >= 0]] = 1
    edges = np.maximum(edges, edges.T)
    cosine, done = np.full((n, n), -np.inf), np.zeros((n, n), bool)

    def arrive(new: np.ndarray, asking: np.ndarray) -> None:
        i, j = np.nonzero(new & np.isneginf(cosine[asking]))
        i = asking[i]
        for at in range(0, len(i), PAIRS):
            p, q = i[at : at + PAIRS], j[at : at + PAIRS]
            cosine[p, q] = np.einsum("ij,ij->i", x[p], x[q])

    every = np.arange(n)
    first = np.zeros((n, n), bool)
    first[:, int((x @ x.mean(0)).argmax())] = True
    first[every, every] = True
    arrive(first, every)
    for _ in range(min(BEAM, n)):
        best = np.where(done, -np.inf, cosine).argmax(1)
        done[every, best] = True
        arrive(edges[best] > 0, every)
    while (fresh := (cosine >= least) & ~done).any():
        done |= fresh
        some = np.flatnonzero(fresh.any(1))
        arrive((fresh[some].astype(np.float32) @ edges) > 0, some)
    found = cosine >= least
    np.fill_diagonal(found, False)
    return found


def _roots(links: np.ndarray) -> np.ndarray:
    root = np.arange(len(links))
    while True:
        low = np.where(links, root[None, :], len(links)).min(1, initial=len(links))
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def usable(vectors: DataFrame) -> DataFrame:
    x = F.col("embedding")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~odd & F.exists(x, lambda v: v != 0))


def sharded(nodes: DataFrame) -> DataFrame:
    """Nodes (node, label, embedding, times) with home, the name of the nearest cell, and shard, one row for each shard of a node.

    A label (with one length of vectors) of at most MOST nodes is a shard of its
    own and has no pivot. A cell of more than MOST nodes is dealt to several
    shards by hash.
    """
    nodes = nodes.withColumn("dim", F.size("embedding"))
    counts = settled(nodes.groupBy("label", "dim").agg(F.count("*").alias("n")))
    large = counts.where(F.col("n") > MOST).select("label", "dim")
    total = counts.agg(F.sum("n")).first()[0] or 0
    size = max(SHARD, -(-total // MOST_PIVOTS))
    chance = F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    grouped: dict[tuple, list] = {}
    for r in nodes.where(chance * size < 1).join(large, ["label", "dim"], "left_semi").select("label", "dim", "embedding").collect():
        grouped.setdefault((r["label"], r["dim"]), []).append(r["embedding"])
    centres = {key: unit(rows) for key, rows in grouped.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, part in pdf.groupby(["label", "dim"]):
                if key not in centres:
                    yield part.assign(cell=0, home=0)
                    continue
                k = min(OVERLAP, len(centres[key]))
                near = np.argsort(-(unit(part["embedding"].tolist()) @ centres[key].T), axis=1, kind="stable")[:, :k]
                out = part.loc[part.index.repeat(k)].reset_index(drop=True)
                out["cell"] = near.ravel().astype(np.int64)
                out["home"] = np.repeat(near[:, 0], k).astype(np.int64)
                yield out

    label, kind = nodes.schema["label"].dataType.simpleString(), nodes.schema["embedding"].dataType.elementType.simpleString()
    dealt = settled(nodes.select("node", "label", "embedding", "times", "dim").mapInPandas(lean(run), f"node long, label {label}, embedding array<{kind}>, times long, dim int, cell long, home long"))
    full = dealt.groupBy("label", "dim", "cell").agg(F.count("*").alias("n")).where(F.col("n") > MOST).withColumn("parts", F.ceil(F.col("n") / MOST)).drop("n")
    part = F.pmod(F.xxhash64("node", "cell"), F.coalesce("parts", F.lit(1)))  # two nodes are parted in one shard and not in another
    return dealt.join(full, ["label", "dim", "cell"], "left").select("node", "label", "embedding", "times", F.xxhash64("label", "dim", "home").alias("home"), F.struct("label", "dim", "cell", part.alias("part")).alias("shard"))


def blocked(nodes: DataFrame) -> DataFrame:
    """Nodes (node, label, embedding, times, home) packed into rows of about BLOCK nodes: block, dim, centre and radius of a cone around them, their homes, and their names, times and x."""
    kind = nodes.schema["embedding"].dataType.elementType.simpleString()
    width = np.float32 if kind == "float" else np.float64
    nodes = nodes.withColumn("dim", F.size("embedding"))
    counts = settled(nodes.groupBy("label", "dim").agg(F.count("*").alias("n")))
    size = max(BLOCK, -(-(counts.agg(F.sum("n")).first()[0] or 0) // MOST_PIVOTS))
    chance = F.pmod(F.xxhash64("node", F.lit("cell")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    large = counts.where(F.col("n") > size).select("label", "dim")
    grouped: dict[tuple, list] = {}
    for r in nodes.where(chance * size < 1).join(large, ["label", "dim"], "left_semi").select("label", "dim", "embedding").collect():
        grouped.setdefault((r["label"], r["dim"]), []).append(r["embedding"])
    centres = {key: unit(rows) for key, rows in grouped.items()}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cell = np.zeros(len(pdf), np.int64)
            for key, at in pdf.groupby(["label", "dim"]).indices.items():
                if key in centres:
                    for few in np.array_split(at, -(-len(at) * len(centres[key]) // (1 << 22))):
                        cell[few] = (unit(pdf["embedding"].iloc[few].tolist()) @ centres[key].T).argmax(1)
            yield pdf.assign(cell=cell)

    label = nodes.schema["label"].dataType.simpleString()
    dealt = nodes.select("node", "label", "embedding", "times", "home", "dim")
    dealt = settled(dealt.mapInPandas(lean(deal), f"node long, label {label}, embedding array<{kind}>, times long, home long, dim int, cell long")) if centres else dealt.withColumn("cell", F.lit(0).cast("long"))
    full = dealt.groupBy("label", "dim", "cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).withColumn("parts", F.ceil(F.col("n") / BLOCK)).drop("n")
    dealt = dealt.join(full, ["label", "dim", "cell"], "left").withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), F.coalesce("parts", F.lit(1))))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.array([np.asarray(r, np.float64) for r in pdf["embedding"]])
        centre, radius = cone(unit(pdf["embedding"].tolist()))
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "homes": [pdf["home"].unique().tolist()], "centre": [centre.tolist()], "radius": radius, "names": pdf["node"].to_numpy(np.int64).tobytes(), "times": pdf["times"].to_numpy(np.int64).tobytes(), "x": rows.astype(width).tobytes(), "width": np.dtype(width).str})

    packed = dealt.groupBy("label", "dim", "cell", "part").applyInPandas(pack, "dim int, homes array<long>, centre array<double>, radius double, names binary, times binary, x binary, width string")
    return settled(packed.withColumn("block", F.monotonically_increasing_id()))


def cone(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A direction and the largest angle that a row has to it."""
    mean = x.mean(0)
    length = np.sqrt(mean @ mean)
    centre = mean / length if length > SLACK else x[0]
    return centre, float(np.arccos(np.clip(x @ centre, -1, 1)).max())


def merged_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (no row's is above itself) after the pairs a, b are joined."""
    root = root.copy()
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def all_links(x: np.ndarray, times: np.ndarray, n_first: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row the sum of its partners' times and a root of its component.

    The first ``n_first`` rows are compared with the others, or all with all if there are no others.
    """
    reach = float(np.arccos(least)) + SLACK
    root, counts, weight = np.arange(len(x)), np.zeros(len(x)), times.astype(np.float64)
    rows, columns = np.arange(n_first), np.arange(n_first, len(x))
    alone = not len(columns)
    if alone:
        columns = rows
    else:
        (a, radius_a), (b, radius_b) = cone(x[rows]), cone(x[columns])
        rows, columns = rows[np.arccos(np.clip(x[rows] @ b, -1, 1)) <= radius_b + reach], columns[np.arccos(np.clip(x[columns] @ a, -1, 1)) <= radius_a + reach]
    for start in range(0, len(rows), ROWS):
        i, j = rows[start : start + ROWS], columns[start:] if alone else columns
        links = x[i] @ x[j].T >= least
        if alone:
            links &= i[:, None] < j[None, :]
        if links.any():
            dense = links.astype(np.float64)
            counts[i] += dense @ weight[j]
            counts[j] += weight[i] @ dense
            p, q = np.nonzero(links & (root[i][:, None] != root[j][None, :]))
            root = merged_roots(root, i[p], j[q])
    return counts.astype(np.int64), root


def meeting(blocks: DataFrame, gates: DataFrame, least: float) -> DataFrame:
    """Pairs of blocks (a < b) that the search reaches from one another.

    It starts with those between whose homes it found links (``gates``: home,
    other) and goes on along them, a step a round, to blocks that the angles leave in range.
    """
    of = blocks.select("block", F.explode("homes").alias("home"))
    cones = blocks.select("block", "centre", "radius")
    dot = F.aggregate(F.zip_with("ca", "cb", lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v)
    between = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    reach = F.lit(float(np.arccos(least)) + SLACK)

    def in_range(pairs: DataFrame) -> DataFrame:
        one, two = (cones.select(F.col("block").alias(e), F.col("centre").alias(f"c{e}"), F.col("radius").alias(f"r{e}")) for e in "ab")
        return pairs.join(one, "a").join(two, "b").where(between <= F.col("ra") + F.col("rb") + reach).select("a", "b")

    pairs = gates.join(of.select("home", F.col("block").alias("a")), "home").join(of.select(F.col("home").alias("other"), F.col("block").alias("b")), "other")
    beside = settled(in_range(pairs.where("a != b").select("a", "b").distinct()))
    reached = last = beside
    while not last.isEmpty():
        onward = last.select("a", F.col("b").alias("via")).join(beside.select(F.col("a").alias("via"), "b"), "via").where("a != b").select("a", "b").distinct()
        last = settled(in_range(onward.join(reached, ["a", "b"], "left_anti")))
        reached = reached.union(last)
    return reached.where("a < b")


def verified(nodes: DataFrame, gates: DataFrame, least: float) -> DataFrame:
    """The links of the nodes, compared within blocks and between blocks that meet: node, root of its component in a task, n (links there); nodes that link in no task are left out."""
    blocks = blocked(nodes)
    tasks = blocks.select(F.col("block").alias("a"), F.col("block").alias("b")).union(meeting(blocks, gates, least))
    sides = tasks.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        names, times = (np.concatenate([np.frombuffer(v, np.int64) for v in pdf[c]]) for c in ("names", "times"))
        x = [np.frombuffer(v, w).reshape(-1, d) for v, w, d in zip(pdf["x"], pdf["width"], pdf["dim"])]
        n, root = all_links(unit(np.concatenate(x)), times, len(x[0]), least)
        some = n > 0
        return pd.DataFrame({"node": names[some], "root": names[root[some]], "n": n[some]})

    return sides.join(blocks.select("block", "dim", "names", "times", "x", "width"), "block").groupBy("a", "b").applyInPandas(compare, "node long, root long, n long")


def near_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable) and kept."""
    nodes = usable(vectors).withColumn("node", F.xxhash64("label", "embedding"))
    merged = settled(nodes.groupBy("node").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("times"), F.min("vec_id").alias("rep")))
    placed = settled(sharded(merged.select("node", "label", "embedding", "times")))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        names = pdf["node"].to_numpy()
        graph = robust_graph(unit(pdf["embedding"].tolist()))
        return pd.DataFrame({"node": names, "next": [names[g[g >= 0]].tolist() for g in graph]})

    lists = placed.groupBy("shard").applyInPandas(build, "node long, next array<long>").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").reset_index(drop=True)
        names = pdf["node"].to_numpy()
        flat = np.concatenate([np.asarray(n, np.int64) for n in pdf["next"]])
        of = np.repeat(np.arange(len(pdf)), pdf["next"].map(len))
        at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
        here = names[at] == flat  # united lists also name nodes of other shards
        width = int(np.bincount(of[here], minlength=len(pdf)).max(initial=1))
        graph = np.full((len(pdf), max(1, width)), -1)
        place = np.arange(here.sum()) - np.concatenate(([0], np.cumsum(np.bincount(of[here], minlength=len(pdf)))))[of[here]]
        graph[of[here], place] = at[here]
        links = range_search(unit(pdf["embedding"].tolist()), graph, least)
        links |= links.T
        some = links.any(1)
        homes, home = np.unique(pdf["home"].to_numpy(), return_inverse=True)
        p, q = np.divmod(np.unique(np.concatenate([k * len(homes) + np.unique(home[links[home == k].any(0)]) for k in range(len(homes))])), len(homes))
        apart = p != q
        own = pd.DataFrame({"node": names[some], "root": names[_roots(links)][some], "home": homes[home[some]], "other": homes[home[some]]})
        return pd.concat((own, pd.DataFrame({"node": -1, "root": -1, "home": homes[p[apart]], "other": homes[q[apart]]})), ignore_index=True)

    found = settled(placed.join(lists, "node").groupBy("shard").applyInPandas(search, "node long, root long, home long, other long"))
    partnered = found.where("home = other").groupBy("node").agg(F.first("home").alias("home"))
    gates = found.where("home != other").select("home", "other").distinct()
    every = settled(verified(merged.join(partnered, "node").select("node", "label", "embedding", "times", "home"), gates, least))
    found = found.where("home = other")
    linked = components(found.select("node", "root").union(every.select("node", "root")).where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    rooted = merged.select("node", "rep", "times").join(linked, "node", "left").select("node", "rep", "times", F.coalesce("component", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("smallest"))
    result = rooted.join(smallest, "root").join(every.groupBy("node").agg(F.sum("n").alias("n")), "node", "left").select("node", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), "smallest")
    ids = nodes.select("vec_id", "node").join(result, "node").select("vec_id", "n_links", F.col("smallest").alias("component_id"))
    rest = vectors.select("vec_id").exceptAll(nodes.select("vec_id")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return ids.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def audit(vectors: DataFrame, found: DataFrame, least: float = 0.93, every: int = 50) -> tuple[int, int]:
    """(links counted, links there) of the vectors whose id is divisible by ``every``, held against all rows in blocks."""
    good = usable(vectors)
    asked = good.where(F.col("vec_id") % every == 0).select("vec_id", "label", "embedding", F.pmod("vec_id", F.lit(64)).alias("block"))
    block = asked.groupBy("label", F.size("embedding").alias("dim"), "block").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("asked"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    pairs = good.withColumn("dim", F.size("embedding")).join(block, ["label", "dim"]).select("vec_id", "embedding", F.explode("asked").alias("q"))
    cosine = dot(F.col("embedding"), F.col("q.embedding")) / F.sqrt(dot(F.col("embedding"), F.col("embedding")) * dot(F.col("q.embedding"), F.col("q.embedding")))
    there = pairs.where((F.col("vec_id") != F.col("q.vec_id")) & (cosine >= least)).groupBy(F.col("q.vec_id").alias("vec_id")).agg(F.count("*").alias("there"))
    row = there.join(found, "vec_id").agg(F.sum(F.least("n_links", "there")), F.sum("there")).first()
    return (row[0] or 0), (row[1] or 0)
