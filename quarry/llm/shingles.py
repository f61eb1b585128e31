"""Word shingle sets of whole texts as 64-bit hashes.

Words are maximal runs of characters other than space and \\x09-\\x0D, A-Z lower-cased.
A shingle is five consecutive words; a text of one to four words is a single shingle, an
empty text has none. Two different shingles of a pair of texts share a 64-bit hash with a
chance of about n*m / 2**64, which is nil for texts of any length that occurs.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_U = np.uint64
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                 dtype=np.uint64)  # odd factors, one for each place in a shingle
_BASE, _PIECE = 0x2545F4914F6CDD1D, 1 << 16
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64) + _U(1)
_LOWER[65:91] += _U(32)


def _powers(base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(_PIECE, base, np.uint64)]))


_POWER, _BACK = _powers(_BASE), _powers(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(29))
    x = x * _U(0x9FB21C651E98DF25)
    return x ^ (x >> _U(32))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word, in order: the word's bytes as a polynomial (prefix sums
    over the text, shifted back to the word's start), then mixed with the word's length."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) if text else np.empty(0, np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    if len(raw) <= _PIECE:
        return _hash_spans(raw, starts, ends)
    out, first = [], 0
    while first < len(starts):  # pieces of whole words, at most _PIECE bytes each
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _PIECE, "right")))
        lo = starts[first]
        if ends[first] - lo > _PIECE:  # one word longer than a piece: chain its parts
            out.append(_long_word(raw[lo: ends[first]]))
            first += 1
            continue
        out.append(_hash_spans(raw[lo: ends[last - 1]], starts[first:last] - lo, ends[first:last] - lo))
        first = last
    return np.concatenate(out)


def _hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LOWER[raw] * _POWER[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _BACK[starts] + (ends - starts).astype(np.uint64))


def _long_word(raw: np.ndarray) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    for at in range(0, len(raw), _PIECE):
        part = raw[at: at + _PIECE]
        h = mix(h * _MULT[0] + (_LOWER[part] * _POWER[: len(part)]).sum(keepdims=True, dtype=np.uint64) + _U(len(part)))
    return h


def shingle_hashes(ids: np.ndarray) -> np.ndarray:
    """Hash of every shingle, in order of place."""
    n = len(ids)
    if n == 0:
        return ids
    if n < WIDTH:
        return mix((ids * _MULT[:n]).sum(keepdims=True, dtype=np.uint64) + _U(n))
    out = ids[: n - WIDTH + 1] * _MULT[0]
    for k in range(1, WIDTH):
        out += ids[k: n - WIDTH + 1 + k] * _MULT[k]
    return mix(out)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingle_hashes(word_hashes(text)))


def similar(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """100 * |a & b| >= percent * |a | b| for sorted distinct arrays; empty sets are like nothing."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)
