"""Word shingles of texts as 64-bit hashes, computed over the bytes of whole Arrow slices."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

#: Words are maximal runs of anything but these bytes.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _ODD, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)[_LOWER]
_INSIDE = np.ones(256, bool)
_INSIDE[list(BLANKS)] = False


def word_hashes(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased, and for each row the number of words before it."""
    inside = _INSIDE[data]
    if not inside.any():
        return np.empty(0, np.uint64), np.zeros(len(rows), np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = rows[:-1][rows[:-1] < len(data)]
    begins[heads] = inside[heads]
    at = np.flatnonzero(inside)
    starts = np.flatnonzero(begins)
    first = np.searchsorted(at, starts)
    lengths = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    weights = powers(int(lengths.max()))
    words = np.add.reduceat(_CODES[data[at]] * weights[place], first)
    return mix(words ^ lengths.astype(np.uint64)), np.searchsorted(starts, rows)


def shingle_sets(data: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every row, end to end, and their offsets.

    A row with fewer than ``width`` words has its whole sequence as one shingle, a row without words none.
    """
    words, at = word_hashes(data, rows)
    counts = np.diff(at)
    factors = mix(powers(width + 1) + np.uint64(width))
    if len(words) >= width:
        whole = np.zeros(len(words) - width + 1, np.uint64)
        for j in range(width):
            whole += words[j : len(words) - width + 1 + j] * factors[j]
        whole = mix(whole)
    else:
        whole = np.empty(0, np.uint64)
    parts, sizes = [], np.zeros(len(counts), np.int64)
    for row, (start, n) in enumerate(zip(at[:-1].tolist(), counts.tolist(), strict=True)):
        if n >= width:
            own = whole[start : start + n - width + 1].copy()
            own.sort()
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            own = mix((words[start : start + n] * factors[:n]).sum(keepdims=True) ^ factors[width] * np.uint64(n))
        else:
            continue
        parts.append(own)
        sizes[row] = len(own)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])
