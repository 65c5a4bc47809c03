"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a longest run of ``[0-9a-z]`` after lower-casing A-Z, or of bytes
from 0x80 (that is, of code points from U+0080).  A word's hash is a polynomial
over its bytes modulo 2^64, so that all words of a chunk come from one
cumulative sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_i = np.arange(256)
LOWER = np.where((_i >= 0x41) & (_i <= 0x5A), _i + 32, _i).astype(np.uint8)
IS_WORD = ((LOWER >= 0x30) & (LOWER <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (LOWER >= 0x80)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-xor-multiply)."""
    with np.errstate(over="ignore"):  # modulo 2^64 is meant
        x = np.asarray(x, np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_VALUE = mix(LOWER.astype(np.uint64) + np.uint64(1))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string array without nulls."""
    wide = pa.types.is_large_string(texts.type)
    off = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off.astype(np.int64) - int(off[0])


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, offsets) of runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    data, off = buffers(texts)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and each text's first word (one more at the end)."""
    is_word = IS_WORD[data]
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    cut = off[:-1][off[:-1] < len(data)]
    first[cut] = is_word[cut]
    before = cut[cut > 0] - 1
    last[before] = is_word[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; equal words have equal hashes wherever they stand."""
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within each text, and each text's first shingle (one more at the end).

    A text of fewer words, but not none, has one shingle of all its words.
    """
    n, counts = len(words), np.diff(first)
    size = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    at = np.zeros(len(first), np.int64)
    np.cumsum(size, out=at[1:])
    if not n:
        return np.zeros(0, np.uint64), at
    total = np.zeros(n, np.uint64)
    for j in range(k):
        c = mix(np.uint64(0xA0761D6478BD642F + j))
        total[:n - j] += words[j:] * c
    owner = np.repeat(np.arange(len(counts)), size)
    start = first[owner] + (np.arange(at[-1]) - at[owner])
    out = mix(total[start])
    for t in np.flatnonzero((counts > 0) & (counts < k)):
        w = words[first[t]:first[t + 1]]
        out[at[t]] = mix(np.bitwise_xor.reduce(mix(w + np.arange(1, len(w) + 1, dtype=np.uint64))))
    return out, at
