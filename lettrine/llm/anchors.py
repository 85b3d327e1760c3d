"""Anchors: short strings chosen by content, so that equal windows of texts have equal anchors at equal places."""

from __future__ import annotations

import numpy as np
import xxhash

from .words import eights

GRAM = 48
# Odd multipliers with well-spread bits.
_BLEND = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_PLACE = np.uint64((1 << 24) - 1)
#: Longest buffer that places fit in.
MOST = 1 << 24


def lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, in log(width) passes."""
    reach = 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def _blended(x: np.ndarray, gap: int, n: int, y: np.ndarray) -> np.ndarray:
    """Of the first ``n`` places: the hash at a place with that of ``y`` at ``gap`` places further."""
    z = x[:n] ^ (x[:n] >> np.uint64(29))
    z *= np.uint64(_BLEND[0])
    z += y[gap : gap + n]
    z ^= z >> np.uint64(32)
    z *= np.uint64(_BLEND[1])
    z ^= z >> np.uint64(29)
    return z


def grams(data: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from every place on: 8 and 8 make 16, two of these 32, 32 and 16 make 48."""
    n = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        eight = eights(data)
        sixteen = _blended(eight, 8, n + 32, eight)
        return _blended(_blended(sixteen, 16, n + 16, sixteen), 32, n, sixteen)


def runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of the texts data[starts[i] : starts[i] + sizes[i]] that have one anchor.

    A window's anchor is its gram of GRAM bytes with the lowest hash, the first
    of equals. Returns for each run the place of its first window, its number of
    windows, its anchor's hash, a hash of its bytes and of where the anchor lies
    in them, and that place. Windows don't cross texts.
    """
    none = np.zeros(0, np.int64)
    n = len(data) - window + 1
    inside = np.zeros(max(n, 0) + 1, np.int32)
    fit = sizes >= window
    if n < 1 or not fit.any():
        return none, none, none, none, none
    inside[starts[fit]] += 1
    inside[starts[fit] + sizes[fit] - window + 1] -= 1
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    hashes = grams(data)
    low = lowest((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), window - GRAM + 1)[at]
    cut = np.ones(len(at), bool)
    cut[1:] = (low[1:] != low[:-1]) | (np.diff(at) > 1)
    begin = np.flatnonzero(cut)
    first, count, place = at[begin], np.diff(np.append(begin, len(at))), (low[begin] & _PLACE).astype(np.int64)
    raw, digest = data.tobytes(), xxhash.xxh3_64_intdigest
    whole = np.array([digest(raw[a:b], p) for a, b, p in zip(first.tolist(), (first + count + window - 1).tolist(), (place - first).tolist())], np.uint64)
    return first, count, hashes[place].view(np.int64), whole.view(np.int64), place - first
