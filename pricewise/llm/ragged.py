"""Words and word shingles of many texts at once, as flat numpy arrays.

A batch of texts is held as one byte array and offsets, as Arrow has it; words,
their hashes and shingles come from whole-array operations. Memory follows the
slice of texts in hand (``slices``), never the partition.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Hashes have 64 bits;
two different words or shingles share one with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SHINGLE = 5
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240517)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_COEF = _RNG.integers(1, 2**63, SHINGLE, dtype=U64) * U64(2) + U64(1)
_SHORT = _RNG.integers(1, 2**63, SHINGLE, dtype=U64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and int64 offsets; a null counts as empty. The bytes
    are those of the column, not a copy."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.large_string())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    kind = np.int32 if pa.types.is_string(col.type) else np.int64
    off = np.frombuffer(offsets, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if col.null_count and np.diff(off)[col.is_null().to_numpy(zero_copy_only=False)].any():
        return text_bytes(col.fill_null(""))  # bytes under a null
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of at most ``limit`` bytes, or a single longer text."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each text the range of its words (offsets)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, U64), np.zeros(len(off), np.int64)
    space = _SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    inner = off[(off > 0) & (off < n)]
    before[inner] = True
    after[inner - 1] = True
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    powers = np.full(n, _BASE, U64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum(_BYTE[_LOWER[data]] * powers, out=total[1:])
    inverse = np.full(n, _BASE_INV, U64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    h = (total[end] - total[start]) * inverse[start] + (end - start).astype(U64)
    return mix(h), np.searchsorted(start, off)


def shingle_hashes(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its 5-word shingles; a text of
    1 to 4 words has one, its whole sequence; a text without words none."""
    words, at = word_hashes(data, off)
    runs = np.zeros(0, U64)
    if len(words) >= SHINGLE:
        m = len(words) - SHINGLE + 1
        acc = words[:m] * _COEF[0]
        for k in range(1, SHINGLE):
            acc = acc + words[k:m + k] * _COEF[k]
        runs = mix(acc)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= SHINGLE:
            s = np.sort(runs[a:b - SHINGLE + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            out.append(mix((words[a:b] * _COEF[:b - a]).sum(dtype=U64, keepdims=True) + _SHORT[b - a]))
        else:
            out.append(np.zeros(0, U64))
    return out
