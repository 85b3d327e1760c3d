import hashlib
import struct
import zlib

import numpy as np
import pytest

from lettrine.llm import media, queries


def filtered(samples, kind):
    """A PNG whose rows all have one filter, made byte by byte."""
    rows = b""
    for y, row in enumerate(samples.astype(int)):
        above = samples[y - 1].astype(int) if y else np.zeros(len(row), int)
        out = []
        for x, v in enumerate(row):
            a, b, c = (row[x - 1] if x else 0), above[x], (above[x - 1] if x else 0)
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            out.append((v - [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        rows += bytes([kind, *out])
    head = struct.pack(">IIBBBBB", samples.shape[1], samples.shape[0], 8, 0, 0, 0, 0)
    return media.SIGNATURE + b"".join(struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b)) for k, b in ((b"IHDR", head), (b"IDAT", zlib.compress(rows)), (b"IEND", b"")))


@pytest.mark.parametrize("kind", range(5))
def test_reads_every_filter(kind):
    samples = np.random.default_rng(kind).integers(0, 256, (7, 13), dtype=np.uint8)
    assert (media.read_png(filtered(samples, kind)) == samples).all()


def test_round_trip_and_checksums():
    samples = np.random.default_rng(9).integers(0, 256, (300, 576), dtype=np.uint8)
    stored = media.write_png(samples)
    assert (media.read_png(stored) == samples).all()
    for at in (20, 60, len(stored) - 6):
        broken = bytearray(stored)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            media.read_png(bytes(broken))


def test_hash_is_steady():
    smooth = np.kron(np.random.default_rng(3).integers(20, 236, (8, 8)), np.ones((8, 72))).astype(np.uint8)  # all low frequencies
    near = np.clip(smooth.astype(int) + np.random.default_rng(1).integers(-3, 4, smooth.shape), 0, 255).astype(np.uint8)
    far = np.random.default_rng(2).integers(0, 256, smooth.shape, dtype=np.uint8)
    apart = lambda a, b: bin(int(media.cosine_hash(a), 16) ^ int(media.cosine_hash(b), 16)).count("1")
    assert apart(smooth, near) <= 6 < apart(smooth, far)


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    seen = {}
    for r in queries.op6_media(spark, sf_dir).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-32:])
        assert seen.setdefault(raw, (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])


def test_odd_and_empty(odd, empty):
    rows = media.read_media(media.store_texts(odd)).collect()
    assert len(rows) == odd.count() and all(len(r["payload"]) % 576 == 0 and len(r["payload"]) for r in rows)
    assert media.read_media(media.store_texts(empty)).count() == 0
