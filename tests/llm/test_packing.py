import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lettrine.llm import packing, queries
from lettrine.llm.tokens import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab's é\n\t 　1,.", max_size=60), max_size=6))
def test_pieces_encode_as_whole_texts(texts):
    encoder = _ENCODER
    assert [e.tolist() for e in encoder.encode([*texts, None])] == _REFERENCE([*texts, None])


def test_long_pieces_that_fool_polynomial_hashes():
    word = "a"
    while len(word) < 2048:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    texts = [" " + word, " " + other, "x " + other[:1024], "x " + word[:1024], "a" * 64, "a" * 65, " " + "b" * 63, " " + "b" * 64]
    for _ in range(2):
        assert [e.tolist() for e in _ENCODER.encode(texts)] == _REFERENCE(texts)


def test_a_hash_alone_decides_nothing(monkeypatch):
    from lettrine.llm import tokens

    monkeypatch.setattr(tokens, "hashes", lambda data, starts, ends, view=None: (ends - starts).astype(np.uint64) % np.uint64(3))
    encoder = PieceEncoder(PATH, keep=50)
    texts = ["one two six ten", "the cat sat", " one  six\n two", "é à one"]
    for _ in range(2):
        assert [e.tolist() for e in encoder.encode(texts)] == _REFERENCE(texts)


_ENCODER, _REFERENCE = PieceEncoder(PATH, keep=50), reference()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=40))
def test_blocks_keep_every_token(lengths):
    full, left = packing.pack_block([(i, 0, n) for i, n in enumerate(lengths)], (16, 8, 4))
    tail = packing.split_tail(left)
    assert all(sum(p[2] for p in row) == tier and tier in (16, 8, 4) for tier, row in full)
    assert all(sum(p[2] for p in row) == tier and tier & (tier - 1) == 0 for tier, row in tail)
    seen = defaultdict(list)
    for _, row in full + tail:
        for doc, start, length in row:
            seen[doc] += range(start, start + length)
    assert {d: sorted(s) for d, s in seen.items()} == {i: list(range(n)) for i, n in enumerate(lengths)}


def test_step_groups_are_even():
    rows = [(8, [(0, 0, 8)])] * 8 + [(4, [(1, 0, 2), (2, 0, 2)])] * 4
    groups = packing.step_groups(rows, 16)
    sums = defaultdict(int)
    for (tier, _), g in zip(rows, groups):
        sums[g] += tier
    assert set(sums.values()) == {16}


def check(docs, pieces, padded=0.02):
    ids = {}
    for i, t in docs:
        ids.setdefault((i), []).append(np.array(_REFERENCE([t])[0] + [0], "<u4"))
    sequences = defaultdict(list)
    covered = defaultdict(int)
    for p in pieces:
        whole = next(x for x in ids[p["doc_id"]] if len(x) == p["doc_tokens"])
        cut = whole[p["start"] : p["start"] + p["length"]]
        assert len(cut) == p["length"] and zlib.crc32(cut.tobytes()) == p["ids_crc32"]
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        covered[p["doc_id"]] += p["length"]
    total = pad = 0
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert 0 < at <= 1024
        total += at
        pad += 0 if at & (at - 1) == 0 else 1024 - at
    assert covered == {i: sum(map(len, x)) for i, x in ids.items()}
    assert pad <= padded * total


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(docs, queries.op1_packing(spark, sf_dir).collect())


def test_odd_and_empty(odd, empty):
    pieces = packing.pack_documents(odd, PATH, block_tokens=5000)
    rows = pieces.withColumn("ids_crc32", packing.ids_crc32("ids")).collect()
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    check(docs, rows)
    assert packing.pack_documents(empty, PATH).count() == 0
