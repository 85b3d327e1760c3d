"""Lossless 8-bit greyscale PNG in binary columns, and low-frequency cosine hashes of what is read back.

Chunks carry CRC-32, which reading tests; the image data is one zlib stream
over row-filtered bytes, undone with numpy. A null text is stored like an empty
one, as one row of padding; equal texts give equal media; a long text is one tall image;
repeated rows are stored each; an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import lean, slices

WIDTH = 576
PAD = 255
SIGNATURE = b"\x89PNG\r\n\x1a\n"  # fixed by the format


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def write_png(samples: np.ndarray, level: int = 6, idat: int = 1 << 16) -> bytes:
    """``samples``: rows x columns of uint8. Each row takes the filter of none, sub and up with the smallest sum of signed residuals."""
    height, width = samples.shape
    left = np.zeros_like(samples)
    left[:, 1:] = samples[:, :-1]
    above = np.zeros_like(samples)
    above[1:] = samples[:-1]
    tries = np.stack([samples, samples - left, samples - above])
    cost = np.abs(tries.view(np.int8).astype(np.int16)).sum(2)
    best = cost.argmin(0)
    rows = np.empty((height, width + 1), np.uint8)
    rows[:, 0] = best
    rows[:, 1:] = tries[best, np.arange(height)]
    packed = zlib.compress(rows.tobytes(), level)
    body = b"".join(_chunk(b"IDAT", packed[i : i + idat]) for i in range(0, len(packed), idat))
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + body + _chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """Samples of an 8-bit greyscale PNG without interlacing; raises ValueError if a checksum or a length is wrong."""
    if not data.startswith(SIGNATURE):
        raise ValueError("not a PNG")
    at, parts, size = len(SIGNATURE), [], None
    while at < len(data):
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + body):
            raise ValueError(f"wrong checksum in {kind!r}")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + n
        if kind == b"IEND":
            break
    else:
        raise ValueError("no IEND")
    if size is None or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("only 8-bit greyscale without interlacing")
    width, height = size[:2]
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8)
    if raw.size != height * (width + 1):
        raise ValueError("wrong length")
    return unfilter(raw.reshape(height, width + 1))


def unfilter(rows: np.ndarray) -> np.ndarray:
    kinds, out = rows[:, 0], rows[:, 1:].copy()
    sub = kinds == 1
    out[sub] = np.cumsum(out[sub], axis=1, dtype=np.uint8)
    zero = np.zeros(out.shape[1], np.uint8)
    for i in np.flatnonzero(kinds > 1):
        above = out[i - 1] if i else zero
        if kinds[i] == 2:
            out[i] += above
        elif kinds[i] == 3:
            out[i] = _average(out[i].tolist(), above.tolist())
        elif kinds[i] == 4:
            out[i] = _paeth(out[i].tolist(), above.tolist())
        else:
            raise ValueError("unknown filter")
    return out


def _average(row: list[int], above: list[int]) -> list[int]:
    left = 0
    for i, b in enumerate(above):
        left = row[i] = (row[i] + (left + b) // 2) & 255
    return row


def _paeth(row: list[int], above: list[int]) -> list[int]:
    left = corner = 0
    for i, b in enumerate(above):
        # distances of left, above and corner from left + above - corner
        near = min((abs(b - corner), 0, left), (abs(left - corner), 1, b), (abs(left + b - 2 * corner), 2, corner))[2]
        left = row[i] = (row[i] + near) & 255
        corner = b
    return row


@lru_cache
def _cosines(size: int = 32, low: int = 8) -> np.ndarray:
    k, n = np.arange(low)[:, None], np.arange(size)[None, :]
    return np.cos(np.pi * k * (2 * n + 1) / (2 * size)) * np.sqrt(2 / size)


def _thumb(samples: np.ndarray, size: int = 32) -> np.ndarray:
    """Means over a size x size grid; an axis shorter than the grid repeats its samples."""
    for axis in (0, 1):
        n = samples.shape[axis]
        if n < size:
            samples = samples.take(np.arange(size) * n // size, axis)
        else:
            edges = np.arange(size + 1) * n // size
            sums = np.add.reduceat(samples, edges[:-1], axis, dtype=np.float64)
            lengths = np.diff(edges)
            samples = sums / (lengths[:, None] if axis == 0 else lengths)
    return samples.astype(np.float64)


def cosine_hash(samples: np.ndarray) -> str:
    """64 bits in hex: signs of the 8 x 8 lowest cosine coefficients against their median, the first left out."""
    c = _cosines()
    low = np.round(c @ _thumb(samples) @ c.T, 6).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes().hex()


def store_texts(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes (UTF-8, unpadded) and media, the PNG of the padded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, ["doc_id", "text"]):
            media, sizes = [], []
            for text in texts:
                raw = (text or "").encode()
                sizes.append(len(raw))
                raw += bytes([PAD]) * (-len(raw) % width or (0 if raw else width))
                media.append(write_png(np.frombuffer(raw, np.uint8).reshape(-1, width)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, n_bytes long, media binary")


def read_media(media: DataFrame) -> DataFrame:
    """Adds payload, the samples read back and tested, and feature, their cosine hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, stored in slices(batches, ["doc_id", "n_bytes", "media"]):
            images = [read_png(m) for m in stored]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(stored, pa.binary()), pa.array([i.tobytes() for i in images], pa.binary()), pa.array([cosine_hash(i) for i in images], pa.string())],
                ["doc_id", "n_bytes", "media", "payload", "feature"],
            )

    return media.select("doc_id", "n_bytes", "media").mapInArrow(lean(run), "doc_id long, n_bytes long, media binary, payload binary, feature string")
