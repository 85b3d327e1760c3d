import numpy as np

from lettrine.llm import queries, toxicity


def test_query_on_labels(spark, sf_dir):
    """Fitted on the sample's labels, as there are few; held-out accuracy is tested below."""
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = {r["doc_id"]: r for r in queries.op7_toxicity(spark, sf_dir).collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    clean = [i for i, t in truth.items() if t == 0 and i in rows]
    assert sum(rows[i]["toxic"] for i in clean) <= 0.02 * len(clean)


def _rows(n, seed):
    pick = np.random.default_rng(seed)
    bad, toxic = pick.random(n) < 0.3, pick.random(n) < 0.25
    words = [" ".join(["w%d" % k for k in pick.integers(0, 300, 40)] + ["junk"] * int(b) + ["vile", "Nasty,"] * int(t)) for b, t in zip(bad, toxic)]
    return words, np.column_stack((bad, toxic)).astype(float)


def test_chain_learns_and_feeds_on(spark):
    """The chain that the query fits, on documents some of whose rows repeat."""
    texts, y = _rows(800, 1)
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7])] * 50 + [(8, None)] * 50
    labels = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(y.tolist())], "doc_id long, bad int, toxic int")
    chain = {"bad": "bad = 1", "toxic": "toxic = 1"}
    models = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), labels, chain)
    assert [len(m) // 8 - (1 << toxicity.BITS) for m in models] == [1, 2]  # the second takes the first's probability
    plain = toxicity.learn(spark.createDataFrame(rows[:800], "doc_id long, text string"), labels, chain)
    assert all(np.allclose(np.frombuffer(a), np.frombuffer(b)) for a, b in zip(models, plain))
    test, z = _rows(400, 2)
    found = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(list(enumerate(test)), "doc_id long, text string"), models, chain).collect()}
    assert np.mean([(found[i]["p_bad"] > 0.5) == z[i, 0] for i in range(400)]) > 0.97
    assert np.mean([(found[i]["p_toxic"] > 0.5) == z[i, 1] for i in range(400)]) > 0.97


def test_odd_and_empty(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1, 0), (9, 0, 1), (9, 1, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    models = toxicity.learn(odd, labels, queries.TOXIC)
    rows = toxicity.score(odd, models, queries.TOXIC).collect()
    assert len(rows) == odd.count() and all(0 <= r["p_toxic"] <= 1 for r in rows)
    assert toxicity.learn(odd, labels.where("false"), queries.TOXIC) == []
    assert all(r["p_toxic"] == 0 for r in toxicity.score(odd, [], queries.TOXIC).collect())
    assert toxicity.score(empty, models, queries.TOXIC).count() == 0
