"""Repeated passages, by the common-prefix interval tree of an enhanced suffix array.

Every window of ``window`` bytes has one anchor, chosen by its content, so equal
windows meet under equal anchors. Neighbouring windows with one anchor are a
run. Anchors that occur once hold no repeat, and runs that are alike as a whole
repeat as a whole. What is left, different runs under one anchor, goes through
suffix arrays in chunks of whole groups: windows are ordered by prefix doubling,
a stack scan of the common prefixes of neighbours gives the interval tree, and
an interval whose occurrences differ in the byte to their left is a maximal
repeat, given out with all its occurrences.

A group of more than ``GROUP`` bytes is split before that by what stands next to
its anchor: a window holds either the left or the right half of what it lacks,
so the anchor grows by that half, and windows that differ there part. Each
split halves what is left to grow; after eight at most the anchor is the window,
and what then still shares one is alike. So every group reaches a suffix array
or is alike as a whole, however many documents hold it.

Null texts are empty; texts shorter than a window keep all; repeated rows are
repeats of each other; ties and extra columns play no part, whatever their
names; an empty table gives no rows. Long texts are walked in overlapping
stretches of 1 MB.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import GRAM, runs
from .tables import bitmap, fresh, lean, set_bits, slices, slot_of, stored
from .words import joined

CHUNK = 1 << 19
GROUP = 1 << 20
SLOTS = 1 << 26
STRETCH = 1 << 20
RUNS = "key long, g long, w long, first int, count int"


def _buffers(batch: pa.RecordBatch, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, starts, sizes, row numbers, places in their texts) of stretches of the batch's texts."""
    keys = np.asarray(batch.column("key").to_pylist(), np.int64)
    row = 0
    for (texts,) in slices([batch], ["text"]):
        data, offsets = joined(texts)
        if len(data) <= STRETCH:
            yield data, offsets[:-1], np.diff(offsets) - 1, keys[row : row + len(texts)], np.zeros(len(texts), np.int64)
        else:
            for i in range(len(texts)):
                text = data[offsets[i] : offsets[i + 1] - 1]
                for at in range(0, max(1, len(text) - window + 1), STRETCH):
                    part = text[at : at + STRETCH + window - 1]
                    yield part, np.zeros(1, np.int64), np.array([len(part)]), keys[row + i : row + i + 1], np.array([at])
        row += len(texts)


def _runs(texts: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, starts, sizes, keys, places in _buffers(batch, window):
                first, count, g, w, _ = runs(data, starts, sizes, window)
                of = np.searchsorted(starts, first, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(keys[of]), pa.array(g), pa.array(w), pa.array((first - starts[of] + places[of]).astype(np.int32)), pa.array(count.astype(np.int32))], ["key", "g", "w", "first", "count"])

    return texts.mapInArrow(lean(run), RUNS)


def _run_texts(texts: DataFrame, wanted: bytes, window: int) -> DataFrame:
    """g, w, bytes and the anchor's place of the runs whose anchor's bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, starts, sizes, _, _ in _buffers(batch, window):
                first, count, g, w, place = runs(data, starts, sizes, window)
                some = np.flatnonzero(set_bits(wanted, g & (SLOTS - 1)))
                raw = data.tobytes()
                cut = [raw[a:b] for a, b in zip(first[some].tolist(), (first + count + window - 1)[some].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(g[some]), pa.array(w[some]), pa.array(cut, pa.binary()), pa.array(place[some].astype(np.int32))], ["g", "w", "bytes", "place"])

    return texts.mapInArrow(lean(run), "g long, w long, bytes binary, place int")


def window_ranks(data: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Ranks of the windows at ``at`` in the order of their bytes; equal windows have equal ranks.

    Prefix doubling from 8 bytes on; the last step joins two overlapping prefixes.
    """
    padded = np.concatenate((data, np.zeros(window, np.uint8)))
    key = np.zeros(len(data), np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + len(data)].astype(np.uint64)
    have = 8
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    while have * 2 <= window:
        after = np.concatenate((rank[have:], np.full(have, -1)))
        rank = _dense(rank * (len(data) + 2) + after + 1)
        have *= 2
    if have < window:
        after = np.concatenate((rank, np.full(window, -1)))[at + window - have]
        return _dense(rank[at] * (len(data) + 2) + after + 1)
    return _dense(rank[at])


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
    return rank


def maximal_repeats(texts: list[bytes], window: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, [(text, place), ...]) of every maximal repeat of at least ``window`` bytes, with all its occurrences.

    No occurrence can be told from all others by the byte on its left, or on its
    right, alone; a text's edges count as bytes of their own.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(texts), np.uint8)
    of_byte = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(np.arange(len(data)) + window <= starts[of_byte + 1]) if len(data) else np.zeros(0, np.int64)
    if len(at) < 2:
        return
    rank = window_ranks(data, at, window)
    order = np.argsort(rank, kind="stable")
    at, rank = at[order], rank[order]
    left = np.where(at == starts[of_byte[at]], -1 - of_byte[at], data[np.maximum(at - 1, 0)].astype(np.int64))
    same = rank[1:] == rank[:-1]
    differs = np.concatenate(([0], np.cumsum(left[1:] != left[:-1])))
    edge = np.flatnonzero(~same) + 1
    begin, end = np.concatenate(([0], edge)), np.concatenate((edge, [len(at)]))
    # Where all have one left byte, every interval inside is that of the next place to the left.
    for b, e in zip(*(x[(end - begin > 1) & (differs[end - 1] > differs[begin])].tolist() for x in (begin, end))):
        places = at[b:e].tolist()
        tails = sorted((texts[t][p - starts[t] :], t, p - int(starts[t])) for t, p in zip(of_byte[at[b:e]].tolist(), places))
        yield from _intervals(tails, texts)


def _shared(x: bytes, y: bytes, least: int = 0) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low, high = least, n
    while low < high:  # longest common prefix by halving
        mid = (low + high + 1) // 2
        if x[:mid] == y[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _intervals(tails: list[tuple[bytes, int, int]], texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Stack scan over the common prefixes of neighbours; each interval ends where a shorter prefix follows."""
    left = [texts[t][p - 1] if p else -1 - t for _, t, p in tails]
    shared = [_shared(a[0], b[0]) for a, b in zip(tails, tails[1:])]
    stack: list[tuple[int, int]] = []  # (prefix, first)
    for i, value in enumerate([*shared, -1]):
        first = i
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            if any(left[k] != left[first] for k in range(first + 1, i + 1)):
                yield length, [(t, p) for _, t, p in tails[first : i + 1]]
        if not stack or stack[-1][0] < value:
            stack.append((value, first))


def repeated_windows(texts: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """For each text the stretches [from, to) of starts of windows that occur elsewhere, from its maximal repeats."""
    marks = [np.zeros(max(1, len(t) - window + 2), np.int32) for t in texts]
    for length, occurrences in maximal_repeats(texts, window):
        for t, p in occurrences:
            marks[t][p] += 1
            marks[t][p + length - window + 1] -= 1
    out = []
    for m in marks:
        on = np.concatenate(([0], np.cumsum(m[:-1]) > 0, [0])).astype(np.int8)
        turns = np.diff(on)
        out.append(list(zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist())))
    return out


def _by_suffix_array(groups: DataFrame, window: int) -> DataFrame:
    """(g, w, times, bytes) of different runs, whole groups in a partition, -> (g, w, from, to)."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for (g, w, times, raw), found in zip(rows, repeated_windows([r[3] for r in rows], window)):
            out += [(g, w, 0, len(raw) - window + 1)] if times > 1 else [(g, w, a, b) for a, b in found]
        cols = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["g", "w", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("g", "w", "times", "bytes"))):
                if rows and size >= CHUNK and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solve(rows)

    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return groups.repartition(n, "g").sortWithinPartitions("g").mapInArrow(lean(run), "g long, w long, `from` int, `to` int")


def grown(raw: bytes, place: int, width: int, window: int) -> list[tuple[str, int, bytes, int, int, bytes]]:
    """The run cut in two by the half that its windows hold next to the anchor: (that half, first window, bytes, the anchor's new place and width, its bytes)."""
    half = (window - width + 1) // 2
    out = []
    first = min(len(raw) - window, place - half)  # last window that holds the left half
    if first >= 0:
        out.append(("left", 0, raw[: first + window], place - half, width + half, raw[place - half : place + width]))
    if (start := max(0, place - half + 1)) <= len(raw) - window:
        wide = window - half + 1
        out.append(("right", start, raw[start:], place - start, wide, raw[place : place + wide]))
    return out


def _split(parts: DataFrame, window: int) -> DataFrame:
    """Parts of runs under longer anchors; ``at`` is a part's first window in its run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        names = ["g0", "w0", "at", "g", "w", "times", "bytes", "place", "width"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        signed = lambda h: h - (1 << 64) if h >> 63 else h
        for batch in batches:
            for some in range(0, batch.num_rows, 1024):
                rows = []
                for g0, w0, at, g, times, raw, place, width in zip(*(batch.column(n).slice(some, 1024).to_pylist() for n in ("g0", "w0", "at", "g", "times", "bytes", "place", "width"))):
                    for half, start, cut_, p, wide, anchor in grown(raw, place, width, window):
                        rows.append((g0, w0, at + start, signed(digest(b"%d %s " % (g, half.encode()) + anchor)), signed(digest(cut_, p)), times, cut_, p, wide))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * len(names), kinds)], names)

    return parts.mapInArrow(lean(run), "g0 long, w0 long, at int, g long, w long, times long, bytes binary, place int, width int")


def _inside(different: DataFrame, window: int) -> DataFrame:
    """(g, w, times, bytes, place) of different runs -> (g, w, from, to), the stretches of their windows that repeat."""
    found = []
    parts, level = different.selectExpr("g as g0", "w as w0", "0 as at", "g", "w", "times", "bytes", "place", f"{GRAM} as width"), different
    size = F.sum(F.length("bytes"))
    while True:
        sizes = level.groupBy("g").agg(size.alias("size"), F.min("w").alias("low"), F.max("w").alias("high"))
        large = stored(sizes.where((F.col("size") > GROUP) & (F.col("low") < F.col("high"))).select("g"), "large")
        some = bool(large.head(1))
        inside = _by_suffix_array((level.join(large, "g", "left_anti") if some else level).select("g", "w", "times", "bytes"), window)
        if level is not different:
            inside = parts.join(inside, ["g", "w"]).select(F.col("g0").alias("g"), F.col("w0").alias("w"), (F.col("at") + F.col("from")).alias("from"), (F.col("at") + F.col("to")).alias("to"))
        found.append(inside)
        if not some:
            return reduce(DataFrame.union, found)
        parts = stored(_split(parts.join(large, "g", "left_semi"), window), "parts")
        level = stored(parts.groupBy("g", "w").agg(F.sum("times").alias("times"), F.first("bytes").alias("bytes")), "level")


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """key and spans: for each row with repeats, by hash of doc_id and text, the stretches [from, to) of window starts. Rows that repeat share a key and its spans, each of which is kept once."""
    texts = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text").where(F.octet_length("text") >= window)
    every = stored(_runs(texts, window), "runs")
    # A table of its own, so that the join's large keys can be split.
    often = stored(every.groupBy("g").agg(F.count("*").alias("n"), F.min("w").alias("low"), F.max("w").alias("high")).where("n > 1").select("g", (F.col("low") < F.col("high")).alias("open")), "anchors")
    found = stored(every.join(often, "g"), "repeated-runs")

    slot = F.col("g").bitwiseAND(F.lit(SLOTS - 1))
    bits = bitmap(often.where("open").select(slot.alias("slot")), "slot", SLOTS, given=True)
    different = stored(_run_texts(texts, bits, window).groupBy("g", "w").agg(F.count("*").alias("times"), F.first("bytes").alias("bytes"), F.first("place").alias("place")), "run-texts")
    inside = _inside(different, window)

    whole = found.where("not open").select("key", F.col("first").alias("from"), (F.col("first") + F.col("count")).alias("to"))
    partly = found.where("open").join(inside, ["g", "w"]).select("key", (F.col("first") + F.col("from")).alias("from"), (F.col("first") + F.col("to")).alias("to"))
    return whole.union(partly).groupBy("key").agg(F.collect_set(F.struct("from", "to")).alias("spans"))


def cut(docs: DataFrame, window: int = 200, whole_characters: bool = False) -> DataFrame:
    """The documents with n_bytes, removed (array of [start, end) in bytes) and kept (the bytes left).

    Every byte that a repeated window covers is removed, in all its occurrences;
    with ``whole_characters`` those too that share a character with such a byte.
    Columns of these names are replaced.
    """
    docs = docs.drop("n_bytes", "removed", "kept")
    key, spans = fresh(docs, "key"), fresh(docs, "spans")
    found = repeated_spans(docs, window).toDF(key, spans)
    marked = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(found, key, "left").drop(key)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                yield _cut_batch(batch.slice(at, 512), spans, window, whole_characters)

    return marked.mapInArrow(lean(run), f"{fields}, n_bytes long, removed array<struct<start:int,end:int>>, kept binary")


def _cut_batch(batch: pa.RecordBatch, spans: str, window: int, whole_characters: bool) -> pa.RecordBatch:
    rows: dict[str, list] = {"n_bytes": [], "removed": [], "kept": []}
    for text, own in zip(batch.column("text").to_pylist(), batch.column(spans).to_pylist()):
        raw = (text or "").encode("utf-8", "surrogatepass")
        merged: list[list[int]] = []
        for a, b in sorted((s["from"], s["to"] + window - 1) for s in own or ()):
            if whole_characters:
                while 0 < a and raw[a] & 0xC0 == 0x80:
                    a -= 1
                while b < len(raw) and raw[b] & 0xC0 == 0x80:
                    b += 1
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        at, left = 0, []
        for a, b in merged:
            left.append(raw[at:a])
            at = b
        rows["n_bytes"].append(len(raw))
        rows["removed"].append([{"start": a, "end": b} for a, b in merged])
        rows["kept"].append(b"".join([*left, raw[at:]]))
    kinds = {"n_bytes": pa.int64(), "removed": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), "kept": pa.binary()}
    names = [n for n in batch.schema.names if n != spans]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *[pa.array(rows[n], k) for n, k in kinds.items()]], [*names, *kinds])
