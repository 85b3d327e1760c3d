"""Hierarchical multi-length packing.

Documents are routed to context tiers by what is left of them after whole
windows are cut off, every tier is packed, gaps of long windows are filled
from shorter tiers, and finished sequences are dealt to step groups of equal
token count and even attention cost.

Packing happens inside each input partition, in blocks of ``block_tokens``
tokens: no shuffle, memory bounded by the block, and a lost task repeats the
same work on the same split. What a block leaves over is carried to the next;
the last leftover of a partition is cut at powers of two, which need no padding.

Null texts count as empty and hold the end id alone; repeated rows are packed
again; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import lean, slices

TIERS = (1024, 512, 256, 128)
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"

Piece = tuple[int, int, int]  # document's place in the block, start, length


class Pool:
    """Pieces by length, with the longest that fits a gap found through one bit mask."""

    def __init__(self, longest: int):
        self.by = [[] for _ in range(longest + 1)]
        self.mask = 0

    def put(self, piece: Piece) -> None:
        self.by[piece[2]].append(piece)
        self.mask |= 1 << piece[2]

    def take(self, most: int) -> Piece | None:
        """The longest piece of at most ``most`` tokens."""
        n = (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1
        if n < 1:
            return None
        piece = self.by[n].pop()
        if not self.by[n]:
            self.mask &= ~(1 << n)
        return piece

    def fill(self, gap: int) -> list[Piece]:
        """Pieces for exactly ``gap`` tokens, as long as the pool lasts; only the last is cut."""
        out: list[Piece] = []
        while gap and self.mask:
            piece = self.take(gap)
            if piece is None:  # only longer ones are left: cut the shortest
                n = (self.mask & -self.mask).bit_length() - 1
                doc, start, length = self.take(n)
                piece = (doc, start, gap)
                self.put((doc, start + gap, length - gap))
            out.append(piece)
            gap -= piece[2]
        return out


def pack_block(items: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full sequences, as (tier, pieces), and the pieces left over, which fill none.

    >>> pack_block([(0, 0, 5), (1, 0, 3)], (8, 4))
    ([(8, [(0, 0, 5), (1, 0, 3)])], [])
    """
    window = tiers[0]
    full: list[tuple[int, list[Piece]]] = []
    pool = Pool(window)
    for doc, start, length in items:
        while length >= window:
            full.append((window, [(doc, start, window)]))
            start, length = start + window, length - window
        if length:
            pool.put((doc, start, length))
    left: list[Piece] = []
    for tier, below in zip(tiers, (*tiers[1:], 0)):
        while pool.mask.bit_length() - 1 > below:
            first = pool.take(window)
            row = [first, *pool.fill(tier - first[2])]
            if sum(p[2] for p in row) < tier:
                left = row
                break
            full.append((tier, row))
    return full, left


def split_tail(left: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """The leftover in sequences whose lengths are powers of two, longest first."""
    out = []
    total = sum(p[2] for p in left)
    queue = left[::-1]
    while total:
        tier = 1 << (total.bit_length() - 1)
        row, gap = [], tier
        while gap:
            doc, start, length = queue.pop()
            took = min(gap, length)
            row.append((doc, start, took))
            if took < length:
                queue.append((doc, start + took, length - took))
            gap -= took
        out.append((tier, row))
        total -= tier
    return out


def step_groups(rows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group number for each sequence: groups are of one tier and of ``step_tokens`` tokens, dealt there and back by attention cost."""
    group = [0] * len(rows)
    first = 0
    by_tier: dict[int, list[int]] = {}
    for i, (tier, _) in enumerate(rows):
        by_tier.setdefault(tier, []).append(i)
    for tier, members in sorted(by_tier.items(), reverse=True):
        n = -(-len(members) * tier // step_tokens)
        members.sort(key=lambda i: -sum(p[2] ** 2 for p in rows[i][1]))
        for k, i in enumerate(members):
            lap, at = divmod(k, n)
            group[i] = first + (n - 1 - at if lap % 2 else at)
        first += n
    return group


def pack_documents(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, end_id: int = 0, block_tokens: int = 1 << 20, step_tokens: int = 1 << 16) -> DataFrame:
    """One row per piece: ``ids`` are the piece's ids as little-endian unsigned 32-bit bytes.

    ``offset`` is the piece's place in its sequence; ``tier`` the sequence's
    length; ``step_group`` the group of sequences to train on together.
    ``tokenizer`` is a file of the tokenizers library which the executors have too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .tokens import encoder_for

        encoder = encoder_for(tokenizer)
        next_sequence = next_group = TaskContext.get().partitionId() << 33
        block: list[tuple[int, bytes]] = []
        items: list[Piece] = []
        tokens = 0

        def rows(full: list[tuple[int, list[Piece]]]) -> Iterator[pa.RecordBatch]:
            nonlocal next_sequence, next_group
            out: list[tuple] = []
            groups = step_groups(full, step_tokens)
            for (tier, row), group in zip(full, groups):
                offset = 0
                for doc, start, length in row:
                    doc_id, ids = block[doc]
                    out.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, next_sequence, offset, tier, next_group + group))
                    offset += length
                next_sequence += 1
            next_group += max(groups, default=-1) + 1
            for at in range(0, len(out), 4096):
                cols = list(zip(*out[at : at + 4096]))
                kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [f.split()[0] for f in SCHEMA.split(", ")])

        for doc_ids, texts in slices(batches, ["doc_id", "text"]):
            for doc_id, ids in zip(doc_ids, encoder.encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                items.append((len(block), 0, len(ids) // 4))
                block.append((doc_id, ids))
                tokens += items[-1][2]
            if tokens >= block_tokens:
                full, left = pack_block(items, tiers)
                yield from rows(full)
                kept = {doc: i for i, doc in enumerate(dict.fromkeys(p[0] for p in left))}
                block[:] = [block[doc] for doc in kept]
                items = [(kept[d], s, n) for d, s, n in left]
                tokens = sum(p[2] for p in items)
        full, left = pack_block(items, tiers)
        yield from rows(full + split_tail(left))

    return docs.select("doc_id", "text").mapInArrow(lean(run), SCHEMA)


def ids_crc32(ids: Column | str) -> Column:
    return F.crc32(ids)
