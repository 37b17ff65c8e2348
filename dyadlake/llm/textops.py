"""Vectorised word splitting and Rabin-Karp hashing over UTF-8 bytes.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``.  All hashes are
polynomials modulo 2**64, evaluated for any slice from one prefix sum:
``hash(s, e) = (S[e] - S[s]) * B**-s`` with ``S`` the running sum of
``value[i] * B**i``; an odd base has an inverse, so no window is rehashed.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Bytes hashed with one prefix sum; longer texts go in blocks that end between words.
_BLOCK = 1 << 20

_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

_pow = np.ones(1, _U)
_inv = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, 4096, min(2 * len(_pow), _BLOCK + 1))
        steps = np.full(size, _BASE, _U)
        steps[0] = 1
        _pow = np.cumprod(steps)
        steps[1:] = _BASE_INV
        _inv = np.cumprod(steps)
    return _pow[:n], _inv[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that low bits depend on all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def encode(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which words start and end."""
    if not raw:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gap = np.ones(len(raw) + 2, np.int8)
    gap[1:-1] = _WS[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(gap))
    return edge[::2], edge[1::2]


def word_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One 64-bit hash a word; with ``lower``, A-Z count as a-z."""
    out = np.empty(len(starts), _U)
    data = np.frombuffer(raw, np.uint8)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, base + _BLOCK, "right")))
        part = data[base : int(ends[last - 1])]
        powers, inverse = _powers(len(part) + 1)
        run = np.zeros(len(part) + 1, _U)
        np.cumsum(_BYTE[_LOWER[part] if lower else part] * powers[:-1], out=run[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (run[e] - run[s]) * inverse[s]
        first = last
    return mix(out)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hashes of every window of ``size`` words, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.empty(n, _U)
    for base in range(0, n, _BLOCK):
        part = words[base : min(base + _BLOCK, n) + size - 1]
        powers, inverse = _powers(len(part) + 1)
        run = np.zeros(len(part) + 1, _U)
        np.cumsum(part * powers[:-1], out=run[1:])
        m = len(part) - size + 1
        out[base : base + m] = (run[size:] - run[:-size]) * inverse[:m]
    return mix(out)


def covered(flags: np.ndarray, size: int, n_words: int) -> np.ndarray:
    """Words lying in at least one flagged window: merged removal intervals as a mask."""
    edge = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(flags)
    if len(at):
        np.add.at(edge, at, 1)
        np.add.at(edge, at + size, -1)
    return np.cumsum(edge[:-1]) > 0
