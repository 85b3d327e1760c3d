import zlib

from lettrine.llm import langid, queries


def test_query_accuracy(spark, sf_dir):
    wanted = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_language_id(spark, sf_dir).collect()
    assert len(rows) == len(wanted) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == wanted[r["doc_id"]] for r in unseen) >= 0.95 * len(unseen)


def test_learning_leaves_out_the_held_out(spark):
    docs = spark.createDataFrame([(i, f"text {i} abc", "en") for i in range(40)], "doc_id long, text string, lang string")
    kept = docs.where(~langid.held_out(docs["doc_id"], 4, 2))
    raw = langid.learn(kept)["en"].decode()
    inside = {int(w) for w in raw.split() if w.isdigit()}
    assert inside and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in inside)


def test_odd_and_empty(spark, odd, empty):
    found = {r["text"]: r for r in langid.identify(odd, {"en": b"some words of text", "fr": b"des mots du texte"}).collect()}
    assert [found[t]["lang_pred"] for t in (None, "", "?!")] == ["und"] * 3
    assert not found[None]["accepted"] and not found["a"]["accepted"]  # no byte between the two
    assert found["a"]["kept"] is True and "n_chars" in found["a"].asDict()
    assert langid.identify(empty, {}).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, {}).collect()} == {"und"}
    assert langid.learn(empty) == {}
