"""Byte-level BPE by a monoid tree.

Encoded stretches form a monoid. A long text, or a long match inside one, is
encoded in halves down to leaves that the tiktoken library encodes; two
neighbours are joined by encoding a window around their boundary anew and
widening it until what lies outside provably stays:

* between matches of the pattern: a match depends only on where it starts and
  on the characters up to LOOK past its end, so only matches that end so near
  the left part's end are open, and once a new match starts where one of the
  right part's does, all later ones are the right part's;
* between tokens of one match: a sequence of tokens is the encoding of its
  bytes exactly if every two neighbours are the encoding of theirs, so it is
  enough to test the pairs on both edges of the window.

Decoding takes all ids of a document and concatenates up such a tree of halves.
Null texts count as empty and have no ids; ids of any text decode to its UTF-8
bytes; repeated rows are encoded each; an empty table gives no rows; other
columns stay out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from .tables import lean, slices

#: Characters past a match's end that its pattern may look at; two for contractions such as 've, one spare.
LOOK = 3
#: Ids that are decoded at once.
LEAF_IDS = 1 << 12
#: Longest match whose ids are kept.
KEPT_CHARS = 64


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = 1 << 15, leaf_bytes: int = 32, keep: int = 200_000):
        self.ranks = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.leaf = tiktoken.Encoding("leaf", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.leaf_chars, self.leaf_bytes, self.keep = leaf_chars, leaf_bytes, keep
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, list[int]] = {}
        self.decimal = {i: str(i) for i in self.bytes}

    # One match of the pattern

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a leaf: bytes of one match."""
        rank = self.ranks.get(piece)
        return [rank] if rank is not None else self.leaf(piece)

    def stays(self, a: int, b: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes."""
        if (found := self.pairs.get((a, b))) is None:
            if len(self.pairs) > self.keep:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merge(self.bytes[a] + self.bytes[b]) == [a, b]
        return found

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        i = j = 1
        while True:
            window = self.merge(self.decode([*left[-i:], *right[:j]]))
            open_left = i < len(left) and not self.stays(left[-i - 1], window[0])
            open_right = j < len(right) and not self.stays(window[-1], right[j])
            if not open_left and not open_right:
                return left[:-i] + window + right[j:]
            i, j = min(len(left), i * 2 if open_left else i), min(len(right), j * 2 if open_right else j)

    def encode_piece(self, piece: bytes) -> list[int]:
        if len(piece) <= self.leaf_bytes:
            return self.merge(piece)
        level = [self.merge(piece[i : i + self.leaf_bytes]) for i in range(0, len(piece), self.leaf_bytes)]
        while len(level) > 1:
            level = [self.join_tokens(level[k], level[k + 1]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        return level[0]

    # A text

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left or right
        keep, tail = len(left), ""
        while keep and len(tail) < LOOK:
            keep -= 1
            tail = left[keep] + tail
        reach = 4
        while True:
            taken = right[:reach]
            window = tail + "".join(taken)
            new = self.pattern.findall(window)
            if len(taken) == len(right):
                return left[:keep] + new
            starts, at = {}, len(tail)
            for k, m in enumerate(taken):
                starts[at] = k
                at += len(m)
            at = 0
            for n, m in enumerate(new):
                at += len(m)
                if at + LOOK > len(window):
                    break
                if at in starts:
                    return left[:keep] + new[: n + 1] + right[starts[at] :]
            reach *= 2

    def matches(self, text: str) -> list[str]:
        if len(text) <= self.leaf_chars:
            return self.pattern.findall(text)
        half = len(text) // 2
        return self.join_matches(self.matches(text[:half]), self.matches(text[half:]))

    def encode(self, text: str) -> list[int]:
        """Ids of the text; each distinct match of moderate length is worked out about once."""
        known = self.known
        if len(known) > self.keep:
            known.clear()
        ids: list[int] = []
        for m in self.matches(text):
            if (own := known.get(m)) is None:
                own = self.encode_piece(m.encode())
                if len(m) <= KEPT_CHARS:
                    known[m] = own
            ids += own
        return ids

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join([self.bytes[i] for i in ids])
        return self.decode(ids[: len(ids) // 2]) + self.decode(ids[len(ids) // 2 :])

    def listed(self, ids: list[int]) -> str:
        return " ".join([self.decimal[i] for i in ids])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_models: dict[tuple[str, str], Bpe] = {}


def bpe_for(path: str, pattern: str) -> Bpe:
    """One model a Python worker, kept over its tasks."""
    if (path, pattern) not in _models:
        _models[path, pattern] = Bpe(read_ranks(path), pattern)
    return _models[path, pattern]


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by one space) and decoded (the bytes that the ids decode to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_for(ranks, pattern)
        for ids, texts in slices(batches, ["doc_id", "text"]):
            out = [bpe.encode(t or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(list(map(len, out)), pa.int64()), pa.array(list(map(bpe.listed, out)), pa.string()), pa.array(list(map(bpe.decode, out)), pa.binary())],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, n_tokens long, ids string, decoded binary")
