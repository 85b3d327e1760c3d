from collections import defaultdict

import pytest

from lettrine.llm import minhash, queries
from lettrine.llm.components import components


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute(docs, size):
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j < i}:
            common = len(s & sets[j])
            if 100 * common >= 80 * len(s | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op2_minhash(spark, sf_dir).collect()}
    assert found == brute(docs, 4)


def test_chains_are_followed(spark):
    """Every text is near the next alone, so no bucket's smallest member is near all."""
    words = [f"w{k}" for k in range(260)]
    docs = [(i, " ".join(words[i * 5 : i * 5 + 100])) for i in range(30)] + [(100 + i, "x " * 60 + f"end{i}") for i in range(6)]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=4).collect()}
    assert found == brute(docs, 4)


def test_words_that_fool_polynomial_hashes(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    assert minhash.shingle_sets([word], 4)[0] != minhash.shingle_sets([other], 4)[0]
    docs = [(1, word), (2, other), (3, "some common words " + word), (4, "some common words " + other), (5, "some common words " + word)]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=4).collect()}
    assert found == brute(docs, 4)


def test_a_doc_id_with_two_texts(spark):
    docs = [(1, "one text of some words"), (1, "quite another text with others"), (1, "one text of some words"), (2, "one text of some words"), (3, None), (3, "")]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=4).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"], r["chosen"]) for r in rows) == [(1, 1, True, True)] * 3 + [(2, 1, False, False)] + [(3, 3, True, True)] * 2


def test_odd_and_empty(spark, odd, empty):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add((r["component_id"], r["kept"]))
    assert by[None] == {(None, True)} and by[1] == {(1, True)} and by[2] == {(2, True)}
    assert by[5] == {(5, True)} and by[10] == {(9, False)} and by[9] == {(9, True)}
    assert minhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (5, 4), (4, 4), (3, 1)], [(i, i + 1) for i in range(40)], [(7, i) for i in range(1000)] + [(2000 + i, 2999) for i in range(500)] + [(999, 2100)]])
def test_components(spark, edges):
    root = {x: x for e in edges for x in e}
    before = None
    while before != root:
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    wanted = {(n, r) for n, r in root.items() if sum(v == r for v in root.values()) > 1}
    assert {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == wanted
