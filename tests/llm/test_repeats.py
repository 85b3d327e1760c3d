import hashlib
import time
from collections import Counter
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lettrine.llm import queries, repeats


def brute(texts, window):
    counts = Counter(t[k : k + window] for t in texts for k in range(len(t) - window + 1))
    out = []
    for t in texts:
        on = np.zeros(len(t), bool)
        for k in range(len(t) - window + 1):
            if counts[t[k : k + window]] > 1:
                on[k : k + window] = True
        out.append((len(t), int(on.sum()), int((np.diff(np.concatenate(([0], on.astype(int)))) == 1).sum()), bytes(np.frombuffer(t, np.uint8)[~on])))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=40), min_size=1, max_size=5), st.sampled_from([8, 9, 11]))
def test_maximal_repeats(texts, window):
    raw = [t.encode() for t in texts]
    at = lambda t, p: raw[t][p] if 0 <= p < len(raw[t]) else -1 - t
    wanted = {}
    places = [(t, p) for t, x in enumerate(raw) for p in range(len(x))]
    for (t, p), (u, q) in combinations(places, 2):
        if at(t, p - 1) != at(u, q - 1):
            n = 0
            while at(t, p + n) == at(u, q + n) and at(t, p + n) >= 0:
                n += 1
            if n >= window:
                s = raw[t][p : p + n]
                wanted[s] = {(v, k) for v, k in places if raw[v][k : k + n] == s}
    found = {raw[o[0][0]][o[0][1] : o[0][1] + n]: set(o) for n, o in repeats.maximal_repeats(raw, window)}
    assert found == wanted
    marks = repeats.repeated_windows(raw, window)
    counts = Counter(t[k : k + window] for t in raw for k in range(len(t) - window + 1))
    assert [[k for a, b in m for k in range(a, b)] for m in marks] == [[k for k in range(len(t) - window + 1) if counts[t[k : k + window]] > 1] for t in raw]


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    wanted = {i: (n, removed, spans, hashlib.sha256(kept).hexdigest()) for (i, _), (n, removed, spans, kept) in zip(docs, brute([t for _, t in docs], 200))}
    assert {r[0]: tuple(r)[1:] for r in queries.op10_repeats(spark, sf_dir).collect()} == wanted


def test_hot_groups_and_long_texts_give_the_same(spark, monkeypatch):
    pick = np.random.default_rng(1)
    word = lambda n: "".join(chr(97 + k) for k in pick.integers(0, 26, n))
    shared = word(260)
    texts = [word(100) + shared[: pick.integers(150, 261)] + word(100) for _ in range(60)] + ["z" * 900, word(4000) + shared, "é" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = {i: b for i, b in enumerate(brute([t.encode() for t in texts], 200))}
    for group, chunk, stretch in ((repeats.GROUP, repeats.CHUNK, repeats.STRETCH), (5000, 2000, 1000), (0, 0, 1000)):
        monkeypatch.setattr(repeats, "GROUP", group)
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        monkeypatch.setattr(repeats, "STRETCH", stretch)
        rows = repeats.cut(docs).collect()
        assert {r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])) for r in rows} == wanted


def test_growing_anchors_deal_every_window_once():
    parts, windows = [(0, bytes(range(52)), 22, 8)], []  # all windows hold the anchor
    while parts:
        at, own, place, width = parts.pop()
        if width == 30:
            assert len(own) == 30
            windows.append(at)
            continue
        for _, start, cut_, p, wide, anchor in repeats.grown(own, place, width, 30):
            assert cut_ == own[start : start + len(cut_)] and cut_[p : p + wide] == anchor and wide > width
            assert p >= 0 and p + wide <= len(cut_) and len(cut_) >= 30
            parts.append((at + start, cut_, p, wide))
    assert sorted(windows) == list(range(23))


def thue_morse(n):
    """A word and its complement, whose polynomial hashes modulo powers of two are alike."""
    word = "a"
    while len(word) < n:
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


def test_words_that_fool_polynomial_hashes(spark):
    for n in (128, 2048):
        one, other = thue_morse(n)
        texts = ["x " * 100 + one, "y " * 100 + other, one[: n // 2] + " z" * 120]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        wanted = {i: b for i, b in enumerate(brute([t.encode() for t in texts], 200))}
        assert {r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])) for r in repeats.cut(docs).collect()} == wanted


def test_clashing_names_and_whole_characters(spark):
    shared = "é" * 150
    docs = spark.createDataFrame([(1, "a" + shared + "1", 7, "s", True), (2, "bb" + shared + "2", 8, "t", None)], "doc_id long, text string, key int, _spans string, removed boolean")
    rows = {r["doc_id"]: r for r in repeats.cut(docs, whole_characters=True).collect()}
    assert (rows[1]["key"], rows[1]["_spans"], rows[2]["key"]) == (7, "s", 8)
    assert [bytes(rows[i]["kept"]).decode() for i in (1, 2)] == ["a1", "bb2"]
    odd = spark.createDataFrame([(1, "é" + "x" * 250), (2, "è" + "x" * 250)], "doc_id long, text string")  # both end in the same run, after first bytes alike
    assert all(bytes(r["kept"]).decode() in ("", "é", "è") for r in repeats.cut(odd, whole_characters=True).collect())


def test_odd_and_empty(odd, empty):
    rows = repeats.cut(odd).collect()
    wanted = sorted((n, removed, kept) for n, removed, _, kept in brute([(r["text"] or "").encode() for r in odd.collect()], 200))
    assert sorted((r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), bytes(r["kept"])) for r in rows) == wanted
    assert repeats.cut(empty).count() == 0


def test_many_repeated_rows_take_linear_time(spark):
    text = " ".join(f"word{i * i % 7919}" for i in range(330))
    rows = [(1, text)] * 1500 + [(None, text)] * 500 + [(2, text[:1000] + "?" + text[1200:]), (3, "short")]
    began = time.monotonic()
    found = repeats.cut(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id", "n_bytes", F.col("kept").cast("string").alias("kept"), F.size("removed").alias("spans")).count().collect()
    assert time.monotonic() - began < 120
    assert {(r["doc_id"], r["n_bytes"], r["kept"], r["spans"], r["count"]) for r in found} == {(1, len(text), "", 1, 1500), (None, len(text), "", 1, 500), (2, len(text) - 199, "?", 2, 1), (3, 5, "short", 0, 1)}
