"""Token ids of whole texts with a public byte-level BPE, through the tokenizers library.

A text is cut before a space that a non-space character follows. The pattern
of byte-level BPE always starts a match there, so the ids of the whole text are
those of the pieces, and a distinct piece is encoded about once a worker. Known
pieces are found by a 64-bit hash and then compared by their bytes.
"""

from __future__ import annotations

import os

import numpy as np

from .words import LANES, distinct, eights, hashes, joined, lane

#: Bytes after which a space may stand inside white space: controls, and first bytes of UTF-8 for other white space.
_GLUED = np.zeros(257, bool)
_GLUED[[*range(33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


class PieceEncoder:
    """Keeps the ids of about ``keep`` distinct pieces of at most 64 bytes."""

    def __init__(self, path: str, keep: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keep = keep
        self.room = 1 << keep.bit_length()
        vocabulary = self.tokenizer.get_vocab()
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each id; a byte is one character in this vocabulary
        for token, i in vocabulary.items():
            self.widths[i] = len(token)
        self.clear()

    def clear(self) -> None:
        # Where a piece's ids are, by its hash: two places a piece, in the second the last comer stays.
        self.keys = np.zeros((2, self.room), np.uint64)
        self.slots = np.zeros((2, self.room), np.int32)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.raw = np.zeros(1 << 17, np.uint8)
        self.at = np.zeros((2, 1 << 14), np.int64)  # where a slot's ids, and its bytes, end; slot 0 is empty
        self.n = 1

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (hashes & np.uint64(self.room - 1)).astype(np.int64), (hashes >> np.uint64(40)).astype(np.int64) & (self.room - 1)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of a piece with this hash, 0 where there is none."""
        one, two = self._places(hashes)
        slots = np.where(self.keys[0, one] == hashes, self.slots[0, one], 0)
        rest = np.flatnonzero(slots == 0)
        two = two[rest]
        slots[rest] = np.where(self.keys[1, two] == hashes[rest], self.slots[1, two], 0)
        return slots

    def _same(self, slots: np.ndarray, view: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the slots hold the very bytes of these pieces."""
        own = np.ndarray((len(self.raw) - 7,), "<u8", self.raw, strides=(1,))
        begin = self.at[1, np.maximum(slots - 1, 0)]
        same = (self.at[1, slots] - begin == sizes) & (slots > 0)
        some = np.flatnonzero(same)
        for k in range(LANES):
            same[some] = lane(own, begin[some], sizes[some], k) == lane(view, starts[some], sizes[some], k)
            some = some[same[some] & (sizes[some] > 8 * (k + 1))]
        return same

    def _add(self, ids: np.ndarray, counts: np.ndarray, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        new = slice(self.n, self.n + len(counts))
        while new.stop > self.at.shape[1]:
            self.at = np.concatenate((self.at, np.zeros_like(self.at)), 1)
        last = self.at[:, self.n - 1]
        while last[0] + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while last[1] + len(raw) + 8 > len(self.raw):
            self.raw = np.concatenate((self.raw, np.zeros_like(self.raw)))
        self.flat[last[0] : last[0] + len(ids)] = ids
        self.raw[last[1] : last[1] + len(raw)] = raw
        self.at[0, new], self.at[1, new] = last[0] + np.cumsum(counts), last[1] + np.cumsum(sizes)
        self.n = new.stop
        return np.arange(new.start, new.stop)

    def _register(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        one, two = self._places(hashes)
        free = self.slots[0, one] == 0
        self.keys[0, one[free]], self.slots[0, one[free]] = hashes[free], slots[free]
        late = self.keys[0, one] != hashes
        self.keys[1, two[late]], self.slots[1, two[late]] = hashes[late], slots[late]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slots of new pieces. Regular pieces, one space first and no white space last, are encoded as one text and told apart by their bytes."""
        raw = data.tobytes()
        lead = data[np.maximum(ends - 3, 0)]
        regular = (data[starts] == 32) & (data[ends - 1] > 32) & (data[np.maximum(ends - 2, 0)] != 0xC2) & ((lead < 0xE1) | (lead > 0xE3))
        slots = np.zeros(len(starts), np.int64)
        for order, one_text in ((np.flatnonzero(regular), True), (np.flatnonzero(~regular), False)):
            if not len(order):
                continue
            parts = [raw[s:e] for s, e in zip(starts[order].tolist(), ends[order].tolist())]
            text = b"".join(parts)
            sizes = (ends - starts)[order]
            if one_text:
                (ids,) = self._encode([text.decode("utf-8", "surrogatepass")])
                counts = np.diff(np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum(sizes)) + 1, prepend=0)
            else:
                found = self._encode([p.decode("utf-8", "surrogatepass") for p in parts])
                ids, counts = np.concatenate(found), np.array([len(i) for i in found])
            slots[order] = self._add(ids, counts, np.frombuffer(text, np.uint8), sizes)
        return slots

    def _slots(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slots of all pieces; a hash proposes one, the bytes decide."""
        view, sizes = eights(data), ends - starts
        slots = np.zeros(len(starts), np.int64)
        short = np.flatnonzero((sizes > 0) & (sizes <= 8 * LANES))
        key = hashes(data, starts[short], ends[short], view=view)
        held = self._find(key)
        slots[short] = np.where(self._same(held, view, starts[short], sizes[short]), held, 0)
        open_ = np.flatnonzero(slots[short] == 0)
        if len(open_):
            some, first, which = distinct(key[open_])
            new = short[open_[first]]
            learned = self._learn(data, starts[new], ends[new])
            self._register(some, learned)
            given = learned[which]
            new = short[open_]
            slots[new] = np.where(self._same(given, view, starts[new], sizes[new]), given, 0)
        rest: dict[bytes, list[int]] = {}  # long pieces, and those that share a hash with another
        raw = data.data if data.flags.c_contiguous else data.tobytes()
        for i in np.flatnonzero((slots == 0) & (sizes > 0)).tolist():
            rest.setdefault(bytes(raw[starts[i] : ends[i]]), []).append(i)
        if rest:
            found = self._encode([p.decode("utf-8", "surrogatepass") for p in rest])
            for own, at in zip(self._add(np.concatenate(found), np.array([len(f) for f in found]), np.zeros(0, np.uint8), np.zeros(len(found), np.int64)), rest.values()):
                slots[at] = own
        return slots

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        data, offsets = joined(texts)
        if self.n > self.keep or len(self.flat) > 8 * self.keep:
            self.clear()
        following = np.append(data[1:], 0)
        begins = (data == 32) & ~_GLUED[following]
        begins[offsets[:-1]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        last = np.searchsorted(starts, offsets[1:]) - 1  # each text's last piece ends before the line feed put after it
        ends[last] = offsets[1:] - 1
        slots = self._slots(data, starts, ends)
        begin = self.at[0, np.maximum(slots - 1, 0)] * (slots > 0)
        sizes = self.at[0, slots] - begin
        total = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.flat[np.arange(total[-1]) + np.repeat(begin - total[:-1], sizes)]
        cuts = total[np.append(np.searchsorted(starts, offsets[:-1]), len(starts))].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


_encoders: dict[str, PieceEncoder] = {}


def encoder_for(path: str) -> PieceEncoder:
    """One encoder a Python worker, kept over its tasks."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
