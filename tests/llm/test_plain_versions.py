"""Queries held against plain versions of their methods, and models against held-out or planted rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
import zstandard
from pyspark.sql import functions as F

from lettrine.llm import lattice, queries, secrets, toxicity

LARGER = "/root/testdata/sf0.1"


def test_language_is_that_of_the_smallest_encoding(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    parts = defaultdict(dict)
    for r in rows:
        if r["text"] and r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            h = xxhash.xxh64_intdigest(r["text"].encode(), 42)
            h -= (h >> 63) << 64
            at = h % max(1, len(r["text"]) - 1023)
            slots = parts[r["lang"]]
            slots[(h >> 17) % 64] = min(slots.get((h >> 17) % 64, (1 << 63, "")), (h, r["text"][at : at + 1024]))
    encoders = {}
    for lang, slots in parts.items():
        raw = zstandard.ZstdCompressionDict("\n".join(slots[k][1].lower() for k in sorted(slots)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=6)
        encoders[lang] = zstandard.ZstdCompressor(level=6, dict_data=raw, write_content_size=False, write_dict_id=False)
    wanted = {}
    for r in rows:
        wanted[r["doc_id"]] = ("und", 0.0)
        if r["text"] and re.search(r"[^\W\d_]", r["text"]):
            data = r["text"].lower().encode()
            sizes = sorted((sum(len(c.compress(data[k : k + 2048])) for k in range(0, len(data), 2048)), lang) for lang, c in encoders.items())
            wanted[r["doc_id"]] = (sizes[0][1], 1 - sizes[0][0] / sizes[1][0])
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in queries.op8_language_id(spark, sf_dir).collect()}
    assert found.keys() == wanted.keys()
    assert all(found[i] == (wanted[i][0], pytest.approx(wanted[i][1])) for i in wanted)


def plain_hash(samples):
    """Signs of the 8 x 8 lowest cosine coefficients of a 32 x 32 picture against their median, sum by sum."""
    picture = np.zeros((32, 32))
    cells = [[(k * n // 32, max(k * n // 32 + 1, (k + 1) * n // 32)) for k in range(32)] for n in samples.shape]
    for y, (a, b) in enumerate(cells[0]):
        for x, (c, d) in enumerate(cells[1]):
            picture[y, x] = samples[a:b, c:d].astype(float).mean()
    wave = [[math.cos(math.pi * k * (2 * n + 1) / 64) for n in range(32)] for k in range(8)]
    low = [round(float((picture * np.outer(wave[u], wave[v])).sum()) / 16, 6) for u in range(8) for v in range(8)]
    middle = float(np.median(low[1:]))
    bits = [0] + [int(v > middle) for v in low[1:]]
    return "%016x" % int("".join(map(str, bits)), 2)


def test_media_features(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op6_media(spark, sf_dir).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        payload = np.frombuffer(raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw)), np.uint8).reshape(-1, 576)
        assert r["feature"] == plain_hash(payload), r["doc_id"]


def test_score_is_the_sum_over_all_segmentations(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [("The cat the mat", True), ("the cat été", True), ("a cat", True), ("thecat é✓ mat", False), (None, False), ("", True)]
    counts = Counter(w.decode() for t, train in texts if train for w in (t or "").encode().lower().split())
    ends = sum(train for _, train in texts)
    tokens = sum(counts.values()) + ends
    unseen = min(0.5, max(1e-4, sum(n == 1 for n in counts.values()) / tokens))
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = Counter()
    for word, n in counts.items():
        for i in model.encode(word):
            pieces[i] += n
    share = lambda i: (pieces[i] + 1) / (sum(pieces.values()) + model.get_piece_size())
    special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
    known = {model.id_to_piece(i): share(i) for i in range(model.get_piece_size()) if not special(i)}

    def every(text):
        if not text:
            return 1.0
        total = sum(known[text[:k]] * every(text[k:]) for k in range(1, len(text) + 1) if text[:k] in known)
        if text[0] not in known:
            total += math.prod(share(model.piece_to_id(f"<0x{b:02X}>")) for b in text[0].encode()) * every(text[1:])
        return total

    table = spark.createDataFrame([(i, t, train) for i, (t, train) in enumerate(texts)], "doc_id long, text string, train boolean")
    found = {r["doc_id"]: r["score"] for r in lattice.score_documents(table, path).collect()}
    for i, (text, _) in enumerate(texts):
        wanted = math.log10((1 - unseen) * ends / tokens)
        for word in (text or "").encode().lower().split():
            wanted += math.log10(unseen * every("▁" + word.decode()) + (1 - unseen) * counts[word.decode()] / tokens)
        assert found[i] == pytest.approx(wanted, rel=1e-9), text


def test_random_keys_are_told_from_identifiers(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pick = random.Random(7)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(pick.choices(letters if k % 2 else "0123456789ABCDEF", k=pick.randint(28, 44))) for k in range(300)]
    words = [w for r in docs.collect() if r["text"] for w in re.findall(r"\b[A-Za-z]{4,9}\b", r["text"])[:60]]
    names = ["_".join(pick.choices(words, k=4)) for _ in range(300)]
    names = [n for n in names if len(n) >= secrets.MIN_LENGTH]
    table = spark.createDataFrame([(i, f"see {s} here") for i, s in enumerate([*keys, *names])], "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in secrets.scan(table, secrets.learn(docs)).select("doc_id", secrets.listed("spans").alias("s")).collect()}
    caught = sum(got[i] == f"random:4:{4 + len(s)}" for i, s in enumerate(keys))
    false = sum(got[len(keys) + i] != "" for i in range(len(names)))
    assert caught >= 0.95 * len(keys) and false <= 0.02 * len(names), (caught, false, len(names))


def test_toxic_documents_not_learned_from(spark):
    if not Path(LARGER).exists():
        pytest.skip("the synthetic tables are not here")
    docs, labels = spark.read.parquet(f"{LARGER}/documents.parquet"), spark.read.parquet(f"{LARGER}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    models = toxicity.learn(docs, labels.where(half), queries.TOXIC)
    asked = docs.join(labels.where(~half).select("doc_id", "toxic").distinct(), "doc_id")
    found = toxicity.score(asked, models, queries.TOXIC).join(asked.select("doc_id", "toxic"), "doc_id")
    flagged = {r["toxic"]: (r["hit"], r["n"]) for r in found.groupBy("toxic").agg(F.count_if(F.col("p_toxic") >= queries.TOXIC_FROM).alias("hit"), F.count("*").alias("n")).collect()}
    assert flagged[1][0] >= 0.8 * flagged[1][1] and flagged[0][0] <= 0.01 * flagged[0][1], flagged
