import math
import zlib
from collections import Counter

import public_tokenizers
import pytest

from lettrine.llm import lattice, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_marginal_is_the_sum_over_all_segmentations():
    model = lattice.Lattice(PATH, {300: 40, 400: 7})

    def every(text):
        if not text:
            return 1.0
        total = sum(math.exp(model.pieces[text[:k]]) * every(text[k:]) for k in range(1, len(text) + 1) if text[:k] in model.pieces)
        if text[0] not in model.pieces:
            total += math.exp(sum(model.bytes[b] for b in text[0].encode())) * every(text[1:])
        return total

    words = ["the", "thend", "a", "été", "x✓y", "then", "a"]
    for word, found in zip(words, model.log_probabilities(words)):
        assert found == pytest.approx(math.log(every("▁" + word)), rel=1e-9)


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    unseen = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(w for i, words in docs.items() if not unseen[i] for w in [*words, None])
    n, v = sum(counts.values()), len(counts)
    spare = sum(c == 1 for c in counts.values()) / n  # the mass kept for unseen words
    least = lambda words: sum(math.log10((1 - spare) * counts[w] / n) for w in words)
    for r in queries.op3_lattice_likelihood(spark, sf_dir).collect():
        words = [*docs[r["doc_id"]], None]
        assert r["held_out"] == unseen[r["doc_id"]] and r["n_tokens"] == len(words) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)
        assert r["score"] < 0
        if r["n_known"] == r["n_tokens"]:  # whole words are arcs of the lattice, so no segmentation can be worth less
            assert r["score"] >= least(words) - 1e-6 * len(words)
        else:
            assert r["score"] < r["base_score"] + len(words)


def test_odd_and_empty(spark, odd, empty):
    docs = odd.selectExpr("doc_id", "text", "coalesce(doc_id % 2 = 1, false) as train")
    rows = lattice.score_documents(docs, PATH, block_bytes=1000).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    none = lattice.score_documents(docs.selectExpr("doc_id", "text", "false as train"), PATH).collect()
    assert all(math.isfinite(r["score"]) and r["n_known"] == 0 and r["train_tokens"] == 0 for r in none)
    assert lattice.score_documents(empty.selectExpr("doc_id", "text", "true as train"), PATH).count() == 0


def test_repeated_rows_meet_folded(spark):
    """4000 equal rows, read by 4 tasks, reach a block as 4 rows with their copies, and are given out 4000 times, with the score that one has."""
    many = spark.range(0, 4000, 1, 4).selectExpr("7L as doc_id", "'one two three ' as text", "false as train")
    rest = spark.createDataFrame([(1, "one two", True), (2, "three four", True), (3, None, False)], "doc_id long, text string, train boolean")
    alone = {r["doc_id"]: r for r in lattice.score_documents(rest.union(many.limit(1)), PATH).collect()}
    rows = lattice.score_documents(rest.union(many), PATH).collect()
    assert Counter(r["doc_id"] for r in rows) == {1: 1, 2: 1, 3: 1, 7: 4000}
    assert all(r == alone[r["doc_id"]] for r in rows)
    assert [tuple(r) for r in lattice.folded(many, 1 << 20).collect()] == [(7, "one two three ", 1000)] * 4
