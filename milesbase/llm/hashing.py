"""Vectorised hashing of Arrow text columns (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the finaliser of a common public-domain generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(seed))


BYTES = stream(256, 11)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_slices(column: pa.Array, max_bytes: int = 1 << 19):
    """Cut a string column into runs of rows of about ``max_bytes`` (one longer row stays whole).
    Yields first row, end row, the bytes of the run, and each row's offsets in them; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        j = min(j, len(column))
        yield i, j, data[offsets[i]:offsets[j]], (offsets[i:j + 1] - offsets[i]).astype(np.int64)
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all rows in order, and the number of words of each row.
    ``lower``: A-Z only."""
    n_rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    if lower:
        data = LOWER[data]
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] |= solid[heads]
    at = np.flatnonzero(solid)
    starts = np.flatnonzero(first[at])  # index of each word's first byte among the solid bytes
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    lengths = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    powers = stream(int(lengths.max()), 23) | U(1)
    with np.errstate(over="ignore"):
        h = mixed(np.add.reduceat(BYTES[data[at]] * powers[place], starts) + lengths.astype(np.uint64))
    per_row = np.diff(np.searchsorted(at[starts], offsets))
    return h, per_row


def shingle_sets(words: np.ndarray, per_row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row's ``size``-word shingles (rows with fewer words: all of them as one),
    row after row, and the number of each row."""
    n_rows = len(per_row)
    ends = np.cumsum(per_row)
    begins = ends - per_row
    n = np.where(per_row >= size, per_row - size + 1, (per_row > 0).astype(np.int64))
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    at = np.cumsum(n) - n
    index = np.repeat(begins - at, n) + np.arange(total)
    weights = stream(size, 37) | U(1)
    h = np.zeros(total, np.uint64)
    padded = np.append(words, np.zeros(size, np.uint64))
    short = np.repeat((per_row < size) & (per_row > 0), n)
    count = np.repeat(np.minimum(per_row, size), n).astype(np.uint64)
    with np.errstate(over="ignore"):
        for t in range(size):
            part = padded[index + t] * weights[t]
            if t:  # short rows have no word here
                part[short & (t >= count)] = U(0)
            h += part
        h = mixed(h + count)
    row_end = np.cumsum(n)
    for s, e in zip((row_end - n).tolist(), row_end.tolist()):
        h[s:e].sort()
    keep = np.ones(total, bool)
    keep[1:] = h[1:] != h[:-1]
    keep[at[n > 0]] = True
    row = np.repeat(np.arange(n_rows), n)[keep]
    return h[keep], np.bincount(row, minlength=n_rows)
