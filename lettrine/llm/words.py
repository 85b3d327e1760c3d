"""Hashes of words and other byte ranges of many texts at once, with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers with well-spread bits.
_ROOT = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_U = np.uint64
#: Ranges of at most so many lanes of 8 bytes are hashed side by side, longer ones each by the xxhash library.
LANES = 8


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers whose bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = x + _U((salt * _ROOT) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _U(30))) * _U(_MIX[0])
        x = (x ^ (x >> _U(27))) * _U(_MIX[1])
        return x ^ (x >> _U(31))


def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place of the buffer on as one number; zeros follow the buffer. A view that reads at any place."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


#: By how many bytes of a lane belong to its range: the bits to keep.
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def lane(view: np.ndarray, starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Bytes 8k to 8k + 7 of ranges that are longer than 8k, zeros past their ends."""
    return view[starts + 8 * k] & _KEEP[np.minimum(sizes - 8 * k, 8)]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0, view: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of byte ranges, from a state of two words that every lane of 8 bytes is mixed into."""
    view = eights(data) if view is None else view
    sizes = ends - starts
    with np.errstate(over="ignore"):
        a = mixed(sizes.astype(np.uint64), salt + 1)
        b = mixed(a, salt + 2)
        some = np.flatnonzero(sizes > 0)
        for k in range(LANES):
            if not len(some):
                break
            x = lane(view, starts[some], sizes[some], k)
            a[some] = mixed(a[some] ^ x, 3)
            b[some] = mixed(b[some] * _U(_ROOT) + x, 4)
            some = some[sizes[some] > 8 * (k + 1)]
        raw = data.data if data.flags.c_contiguous else data.tobytes()
        for i in some.tolist():
            h = xxhash.xxh3_128_intdigest(raw[starts[i] : ends[i]], salt)
            a[i], b[i] = h & 0xFFFFFFFFFFFFFFFF, h >> 64
        return mixed(a ^ mixed(b, 5), 6)


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of the texts' UTF-8 bytes, a line feed after each, and len + 1 offsets of the texts in it."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    return data, offsets


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(texts: list[str | None], bytes_as: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) buffer, starts and ends of its words ``[^\\x20\\x09-\\x0D]+``, and for each text the number of its first word (len + 1 numbers). ``bytes_as`` replaces bytes before."""
    data, offsets = joined(texts)
    data = _LOWER[data if bytes_as is None else bytes_as[data]]
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return data, starts, ends, np.searchsorted(starts, offsets)


def sorted_set(x: np.ndarray) -> np.ndarray:
    ordered = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new]


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers, a place where each is found, and the place among them of every number."""
    order = np.argsort(x)
    ordered = x[order]
    new = np.ones(len(x), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(x), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], order[new], which
