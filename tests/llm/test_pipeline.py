from collections import Counter, defaultdict

from test_minhash import brute as near
from test_packing import check
from test_repeats import brute as repeated

import corpus_pipeline as C
from lettrine.llm import langid, packing, secrets


def rows(df):
    return df.select(C.COLUMNS).collect()


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "secret_scan", "packing"]

    first = C.language_id(spark, docs, sf_dir)
    classifier = langid.Classifier(langid.learn(docs))
    wanted = set()
    for r in docs.collect():
        name, margin = classifier.classify(r["text"])
        if name != "und" and (margin >= 0.005 or len((r["text"] or "").encode()) < 64):
            wanted.add(r["doc_id"])
    assert {r["doc_id"] for r in rows(first)} == wanted and len(wanted) >= 0.95 * docs.count()
    first = first.cache()

    second = C.near_dedup(spark, first, sf_dir).cache()
    by = near([(r["doc_id"], r["text"]) for r in rows(first)], 5)
    assert sorted(r["doc_id"] for r in rows(second)) == sorted(i for i, (_, c) in by.items() if c == i)

    third = C.suffix_dedup(spark, second, sf_dir).cache()
    before = rows(second)
    kept = {r["doc_id"]: k for r, (_, _, _, k) in zip(before, repeated([r["text"].encode() for r in before], 200))}
    for r in rows(third):
        assert r["text"] == kept[r["doc_id"]].decode("utf-8", "ignore")
        assert r["n_chars"] == len(r["text"]) or r["text"] == {x["doc_id"]: x["text"] for x in before}[r["doc_id"]]

    fourth = C.secret_scan(spark, third, sf_dir).cache()
    assert fourth.count() == third.count()
    left = secrets.scan(fourth, [0.0] * 16384).selectExpr("explode(base_spans) as s").where(f"not contains(s.value, '{secrets.MASK}')").count()
    assert left == 0

    pieces = C.pack(spark, fourth, sf_dir).withColumn("ids_crc32", packing.ids_crc32("ids")).collect()
    check([(r["doc_id"], r["text"]) for r in rows(fourth)], pieces)


def test_run_keeps_every_token_of_what_is_left(spark, sf_dir):
    covered, total = defaultdict(int), {}
    for r in C.run(spark, sf_dir).select("doc_id", "length", "doc_tokens").collect():
        covered[r["doc_id"]] += r["length"]
        total[r["doc_id"]] = r["doc_tokens"]
    assert covered and covered == total


def test_odd_and_empty(spark, odd, empty):
    docs, none = odd.select(C.COLUMNS), empty.select(C.COLUMNS)
    for name, stage in C.STAGES:
        docs, none = stage(spark, docs, "").cache(), stage(spark, none, "")
        assert none.count() == 0
        if name == "near_dedup":
            assert max(Counter(r["doc_id"] for r in docs.collect() if r["doc_id"] is not None).values()) == 1
            twice = spark.createDataFrame([(1, "one text of some words"), (1, "quite another text with others"), (1, "one text of some words"), (2, "one text of some words")], "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "0L as n_chars")
            assert sorted((r["doc_id"], r["text"]) for r in stage(spark, twice, "").collect()) == [(1, "one text of some words"), (1, "quite another text with others")]
    assert docs.count() > 0
