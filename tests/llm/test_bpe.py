import hashlib
import random

import public_tokenizers as T
import tiktoken

from lettrine.llm import bpe, queries

RANKS = bpe.read_ranks(T.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_small_leaves_join_to_the_library_s_ids():
    small = bpe.Bpe(RANKS, T.PATTERN, leaf_chars=7, leaf_bytes=3)
    pick = random.Random(1)
    texts = ["", "x" * 500, "it're", "  x\n y\t z 12 's", *("".join(pick.choice("ab's \nré1　eltv!") for _ in range(pick.randint(1, 80))) for _ in range(500))]
    for text in texts:
        ids = small.encode(text)
        assert ids == LIBRARY.encode_ordinary(text)
        assert small.decode(ids) == text.encode()


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op4_byte_bpe(spark, sf_dir).collect():
        ids = LIBRARY.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_odd_and_empty(odd, empty):
    rows = bpe.encode_documents(odd, T.path("byte_bpe_50k.tiktoken"), T.PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in rows) == sorted((r["text"] or "").encode() for r in odd.collect())
    assert bpe.encode_documents(empty, T.path("byte_bpe_50k.tiktoken"), T.PATTERN).count() == 0
