import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lettrine.llm import centroids, grid, queries

SCHEMA = "vec_id long, embedding array<float>, label int, distance int, cluster string"


def brute(rows, k=16, rounds=3, scale=64, dim=64):
    """Over all centroids, in Python's whole numbers."""
    kept = [(i, [math.floor(scale * float(np.float32(v))) for v in x]) for i, x in rows if x is not None and len(x) == dim and all(v is not None and math.isfinite(v) for v in x)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [x for _, x in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres)) for _, x in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(centres)):
            members = [x for (_, x), (_, c) in zip(kept, found) if c == j]
            if members:
                centres[j] = [sum(v) // len(members) for v in zip(*members)]
    found = assign()
    inertia = [sum(d for d, c in found if c == j) for j in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, found)), key=repr)


def clouds(n, seed=3, dim=64):
    pick = np.random.default_rng(seed)
    middles = pick.normal(size=(9, dim))
    return [(i, [float(np.float32(v)) for v in middles[pick.integers(9)] + pick.normal(size=dim) * 0.3]) for i in range(n)]


def query(spark, tmp_path, rows):
    spark.createDataFrame([(i, x, 1, 5, "x") for i, x in rows], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted(map(tuple, queries.op13_centroids(spark, str(tmp_path)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_against_brute_force_with_odd_rows(spark, tmp_path):
    rows = clouds(150)
    rows += [(900, None), (901, [1.0] * 63 + [None]), (902, [math.nan] * 64), (903, [math.inf] * 64), (904, [0.5] * 63), (905, []), (None, [0.25] * 64), (7, rows[7][1]), (7, rows[7][1]), (906, [0.0] * 64), (907, [-0.0] * 64)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # a group of equal vectors
    assert query(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, tmp_path, n):
    rows = clouds(n)
    assert query(spark, tmp_path, rows) == brute(rows)


def test_huge_components_count_as_the_largest(spark):
    rows = spark.createDataFrame([(1, [3e38, -3e38]), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assigned, centres = centroids.clustered(rows, k=2, dim=2)
    assert sorted(tuple(c) for c, in centres.select("centroid").collect()) == [(0, 0), (grid.largest(2), -grid.largest(2))]
    assert all(r["distance"] == 0 for r in assigned.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 12), st.integers(1, 5), st.integers(0, 1000), st.integers(1, 6))
def test_search_finds_the_first_of_the_nearest(n, k, d, seed, spread):
    """Also among many equal distances."""
    pick = np.random.default_rng(seed)
    x, c = pick.integers(-spread, spread + 1, (n, d)), pick.integers(-spread, spread + 1, (k, d))
    who, distance, _ = centroids.nearest(x, centroids.arranged(c))
    all_ = ((x[:, None] - c) ** 2).sum(2)
    assert (who == all_.argmin(1)).all() and (distance == all_.min(1)).all()


def test_inequalities_spare_most_distances():
    pick = np.random.default_rng(1)
    middles = pick.normal(size=(256, 16)) * 40 + pick.normal(size=(256, 1)) * 200
    x = (middles[pick.integers(256, size=4000)] + pick.normal(size=(4000, 16))).astype(np.int64)
    _, _, compared = centroids.nearest(x, centroids.arranged(middles.astype(np.int64)))
    assert compared < 0.1 * len(x) * len(middles)
