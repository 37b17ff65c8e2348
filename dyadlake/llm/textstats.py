"""Statistics of lines and documents that the learned operators share."""

from __future__ import annotations

import re

import numpy as np

from . import textops as T

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_CLASSES = np.zeros((8, 256), np.float32)
for _k, _chars in enumerate(("#*$%&|<>", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".", ",", "!?", "|", "=:;/\\@_{}[]()+-\"'")):
    _CLASSES[_k, [ord(c) for c in _chars]] = 1
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_END = re.compile(r"[.?]\s*$")

LINE_FEATURES = 14


def line_features(line: str, seen: bool) -> np.ndarray:
    """Indicator features of one line; all zero for a blank one but the bias."""
    out = np.zeros(LINE_FEATURES, np.float32)
    words = line.split()
    n = len(words)
    out[0] = 1
    if not n:
        return out
    chars = len(line)
    raw = np.bincount(np.frombuffer(line.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    symbols, digits = int(raw[_SYMBOLS].sum()), int(raw[48:58].sum())
    upper = sum(map(str.isupper, words))
    counts = len(set(words))
    again = sum(a == b for a, b in zip(words, words[1:]))
    out[1] = symbols > 0.02 * chars
    out[2] = symbols > 0.1 * chars
    out[3] = upper > 0.5 * n and n > 2
    out[4] = digits > 0.2 * chars
    out[5] = again > 0.2 * n
    out[6] = counts < 0.5 * n
    out[7] = raw[33] > 0.3 * n
    out[8] = seen
    out[9] = n < 3
    out[10] = n >= 8
    out[11] = _END.search(line) is not None
    out[12] = max(map(len, words)) > 40
    out[13] = raw[124] > 0.2 * n
    return out


def document_lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, code points) of a text's lines, in order."""
    lines = text.split("\n")
    seen: set[str] = set()
    rows, sizes = [], []
    for line in lines:
        rows.append(line_features(line, line in seen and not line.isspace() and line != ""))
        seen.add(line)
        sizes.append(len(line))
    return np.array(rows), np.array(sizes)


DOC_FEATURES = 26


def doc_features(text: str | None) -> np.ndarray:
    """Statistics of a whole text, of bounded range; an empty one gives zeros."""
    out = np.zeros(DOC_FEATURES)
    raw = T.encode(text)
    starts, ends = T.word_bounds(raw)
    n = len(starts)
    if not n:
        return out
    hashes = T.word_hashes(raw, starts, ends)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(text)
    lengths = ends - starts
    out[0] = np.log1p(n)
    out[1] = lengths.mean() / 10
    out[2] = lengths.std() / 10
    out[3] = np.log1p(lengths.max())
    shares = _CLASSES @ counts / chars
    out[4:12] = np.sqrt(shares)
    unique, times = np.unique(hashes, return_counts=True)
    out[12] = len(unique) / n
    out[13] = times.max() / n
    out[14] = np.square(times / n).sum() ** 0.5
    out[15] = np.count_nonzero(hashes[1:] == hashes[:-1]) / n
    lines = text.split("\n")
    full = [x for x in lines if x.strip()]
    out[16] = np.log1p(len(full))
    out[17] = 1 - len(set(full)) / len(full) if full else 0
    out[18] = np.log1p(n / max(1, len(full)))
    out[19] = sum(bool(_END.search(x)) for x in full) / max(1, len(full))
    windows = T.window_hashes(hashes, 3)
    if len(windows):
        _, inverse, times = np.unique(windows, return_inverse=True, return_counts=True)
        out[20] = np.count_nonzero(times[inverse] > 1) / len(windows)
    windows = T.window_hashes(hashes, 8)
    if len(windows):
        _, inverse, times = np.unique(windows, return_inverse=True, return_counts=True)
        out[21] = np.count_nonzero(times[inverse] > 1) / len(windows)
    first = np.frombuffer(raw, np.uint8)[starts]
    last = np.frombuffer(raw, np.uint8)[ends - 1]
    out[22] = np.count_nonzero((first >= 65) & (first <= 90)) / n
    out[23] = np.count_nonzero(((last < 48) | (last > 57)) & (last < 65)) / n
    out[24] = np.count_nonzero(lengths == 1) / n
    out[25] = np.log1p(max((len(x) for x in full), default=0))
    return out
