import numpy as np
import pytest

from lettrine.llm import queries, vectors


def brute(rows, least=0.93):
    good = {i: (label, np.asarray(x, float)) for i, x, label in rows if i is not None and label is not None and x is not None and None not in x and np.isfinite(np.asarray(x, float)).all() and np.any(np.asarray(x, float))}
    links = {i: set() for i in good}
    for i, (a, x) in good.items():
        for j, (b, y) in good.items():
            if i != j and a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i].add(j)
    root = {i: i for i in good}
    for _ in good:
        new = {i: min([root[i], *(root[j] for j in links[i])]) for i in good}
        if new == root:
            break
        root = new
    return {i: (len(links[i]), root[i]) if i in good else (0, i) for i, _, _ in rows}


def cluster(spark, groups=8, each=90, seed=1):
    pick = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = pick.normal(size=16)
        rows += [(g * 1000 + k, [float(v) for v in np.round(centre + pick.normal(size=16) * pick.choice([0.05, 0.2, 0.4]), 4)], g % 2) for k in range(each)]
    return rows


def small(monkeypatch):
    """Several overlapping shards and blocks to a label."""
    for name, value in (("SHARD", 60), ("MOST", 200), ("BLOCK", 64)):
        monkeypatch.setattr(vectors, name, value)


def test_against_brute_force(spark, monkeypatch):
    small(monkeypatch)
    rows = cluster(spark)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = vectors.near_vectors(table)
    got, wanted = {r["vec_id"]: r for r in found.collect()}, brute(rows)
    assert sum(got[i]["n_links"] for i in got) >= 0.9 * sum(n for n, _ in wanted.values())
    assert all(got[i]["n_links"] <= wanted[i][0] for i in got)  # nothing below the least
    assert np.mean([got[i]["component_id"] == wanted[i][1] for i in got]) >= 0.95
    counted, there = vectors.audit(table, found, every=10)
    assert there and counted >= 0.9 * there


@pytest.mark.parametrize("step", ["range_search", "robust_graph"])
def test_links_come_from_the_graph(spark, monkeypatch, step):
    """A graph without edges, or a search that finds nothing, leaves nothing to compare, in one shard and in many."""
    rows = cluster(spark, groups=80, each=5)  # so that hardly any is near a medoid
    wanted = sum(n for n, _ in brute(rows).values())
    if step == "range_search":
        monkeypatch.setattr(vectors, step, lambda x, graph, least: np.zeros((len(x), len(x)), bool))
    else:
        monkeypatch.setattr(vectors, step, lambda x, seed=1: np.full((len(x), 1), -1))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sum(r["n_links"] for r in vectors.near_vectors(table).collect())
    assert wanted and got <= 0.1 * wanted


def test_blocks_meet_along_found_links(spark):
    """A chain of blocks: the ends are in range of the next but one, and reached over the one between."""
    at = [0.0, 0.3, 0.6, 2.0]
    blocks = spark.createDataFrame([(i, [float(np.cos(a)), float(np.sin(a))], 0.15, [10 * i, 10 * i + 1]) for i, a in enumerate(at)], "block long, centre array<double>, radius double, homes array<long>")
    gates = spark.createDataFrame([(0, 10), (20, 11), (30, 0)], "home long, other long")
    both = gates.union(gates.select("other", "home"))
    assert {tuple(r) for r in vectors.meeting(blocks, both, 0.93).collect()} == {(0, 1), (1, 2), (0, 2)}
    assert vectors.meeting(blocks, gates.where("false"), 0.93).count() == 0


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in queries.op9_vectors(spark, sf_dir).collect()}
    assert found == brute(rows)


def test_odd_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [2.0, 0.1], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None), (6, None, 0), (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [1.0, None], 0), (11, [1.0, 0.0, 0.0], 0), (12, [], 0)]
    table = spark.createDataFrame([(*r, "extra", True) for r in rows], "vec_id long, embedding array<float>, label int, node string, kept boolean")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(table).collect()}
    assert found == brute(rows)
    assert vectors.near_vectors(table.where("false")).count() == 0


def test_all_links_of_dense_groups(spark, monkeypatch):
    """Groups larger than any shard, in few blocks and in many, beside looser ones that the angles must not cut."""
    pick = np.random.default_rng(3)
    dense = pick.normal(size=24)
    x = np.concatenate((dense + pick.normal(size=(5000, 24)) * 0.05, np.repeat(pick.normal(size=(60, 24)), 20, 0) + pick.normal(size=(1200, 24)) * 0.3)).astype(np.float32)
    y = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    links = y @ y.T >= 0.93
    np.fill_diagonal(links, False)
    wanted, roots = links.sum(1), vectors._roots(links)
    assert wanted[:5000].min() > 4000
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    for block in (vectors.BLOCK, 700):
        monkeypatch.setattr(vectors, "BLOCK", block)
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(table).collect()}
        assert got == {i: (int(wanted[i]), int(roots[i])) for i in range(len(x))}
