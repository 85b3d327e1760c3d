import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lettrine.llm import balls, queries

SCHEMA = "vec_id long, embedding array<float>, label int, codes string, error int"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """Over all entries, in Python's whole numbers."""
    kept = [(i, label, [math.floor(scale * float(np.float32(v))) for v in x]) for i, x, label in rows if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    by_id = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(by_id[0][2]) // parts if kept else 0
    kept = [r for r in kept if len(r[2]) == width * parts]
    cut = lambda x, p: x[p * width : (p + 1) * width]
    books = [[cut(x, p) for _, _, x in by_id[:entries]] for p in range(parts)]
    assign = lambda x, p: min((sum((a - b) ** 2 for a, b in zip(cut(x, p), c)), e) for e, c in enumerate(books[p]))
    for _ in range(rounds if kept else 0):
        for p in range(parts):
            found = [assign(x, p)[1] for _, _, x in kept]
            for e in set(found):
                members = [cut(x, p) for (_, _, x), f in zip(kept, found) if f == e]
                books[p][e] = [sum(v) // len(members) for v in zip(*members)]
    digest = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    done = [(i, label, [assign(x, p) for p in range(parts)]) for i, label, x in kept]
    total = {}
    for _, label, found in done:
        total[label] = total.get(label, 0) + sum(d for d, _ in found)
    return sorted(((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), total[label], digest) for i, label, found in done), key=repr)


def clouds(n, seed=3, dim=64):
    pick = np.random.default_rng(seed)
    middles = pick.normal(size=(9, dim))
    return [(i, [float(np.float32(v)) for v in middles[pick.integers(9)] + pick.normal(size=dim) * 0.3], int(pick.integers(3))) for i in range(n)]


def query(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted(map(tuple, queries.op11_ball_codes(spark, str(tmp_path)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_against_brute_force_with_odd_rows(spark, tmp_path):
    rows = clouds(260)
    rows += [(900, None, 1), (901, [1.0] * 63 + [None], 1), (902, [math.nan] * 64, 1), (903, [math.inf] * 64, None), (None, [0.25] * 64, 2), (907, [0.1] * 64, None), (908, [-0.1] * 64, None), (909, [0.3] * 32, 1)]
    rows += [(7, rows[7][1], 2), (7, rows[7][1], 2)] + [(1000 + i, rows[3][1], 0) for i in range(60)]  # repeated rows and a group of equal vectors
    assert query(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, tmp_path, n):
    rows = clouds(n)
    assert query(spark, tmp_path, rows) == brute(rows)


def test_length_of_the_smallest_id_counts(spark, tmp_path):
    rows = [(9, [1.0] * 64, 1), (1, [0.5] * 32, 1), (2, [0.5] * 33, 1), (0, [], 1), (3, [0.25] * 32, 1)]
    assert [r[0] for r in query(spark, tmp_path, rows)] == [1, 3]


def test_more_rounds_skip_balls_that_stay(spark):
    rows = clouds(300, dim=8)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    codes, _ = balls.coded(table, parts=2, entries=8, rounds=6)
    wanted = {r[0]: (r[1], r[2]) for r in brute(rows, parts=2, entries=8, rounds=6)}
    assert {r["vec_id"]: ("".join(f"{c:02x}" for c in r["codes"]), r["error"]) for r in codes.collect()} == wanted


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 9), st.integers(1, 3), st.integers(0, 1000), st.integers(1, 8))
def test_moves_are_found_by_rings(n, k, width, seed, spread):
    """Round for round, also among many equal distances."""
    pick = np.random.default_rng(seed)
    x = pick.integers(-spread, spread + 1, (n, 2, width))
    centre = pick.integers(-spread, spread + 1, (2, k, width))
    codes = balls.nearest(x, centre)
    for _ in range(4):
        former, centre, radius = centre, centre.copy(), np.zeros((2, k), np.int64)
        for p in range(2):
            for e in range(k):
                members = x[codes[:, p] == e, p]
                if len(members):
                    radius[p, e] = balls.square(members - former[p, e]).max()
                    centre[p, e] = members.sum(0) // len(members)
        codes, distances, _ = balls.reassigned(x, codes, balls.balls(centre, radius, former))
        wanted = ((x[:, :, None] - centre) ** 2).sum(3)
        assert (codes == wanted.argmin(2)).all() and (distances == wanted.min(2)).all()


def test_rings_spare_most_distances_and_are_needed():
    pick = np.random.default_rng(1)
    middles = pick.integers(-1000, 1000, (1, 64, 4))
    x = middles[0][pick.integers(64, size=5000)][:, None] + pick.integers(-150, 150, (5000, 1, 4))
    codes = balls.nearest(x, middles)
    moved = middles + pick.integers(-60, 60, middles.shape)
    radius = np.array([[balls.square(x[codes[:, 0] == e, 0] - middles[0, e]).max(initial=0) for e in range(64)]])
    b = balls.balls(moved, radius, middles)
    found, _, compared = balls.reassigned(x, codes, b)
    assert (found == balls.nearest(x, moved)).all() and (found != codes).any()
    assert compared < 0.1 * 5000 * 64
    b.near[:] = 0  # no neighbours: nothing moves
    assert (balls.reassigned(x, codes, b)[0] == codes).all()


def test_label_errors_of_a_frequent_label(spark):
    rows = [(i, 1 if i % 3 else (i if i % 2 else None), i) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, label int, error long")
    totals = {}
    for _, label, error in rows:
        totals[label] = totals.get(label, 0) + error
    assert {r["vec_id"]: r["label_error"] for r in balls.label_errors(table).collect()} == {i: totals[label] for i, label, _ in rows}
