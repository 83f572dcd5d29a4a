"""Numpy over Arrow string buffers: words, lines and 64-bit hashes of byte ranges.

Texts are handled whole, as concatenated UTF-8 bytes; no Python string is made.
Hashes are polynomials modulo 2**64 with an odd base, mixed at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20  # bytes worked on at once; one longer text is one chunk

# Two odd 64-bit bases and the finalizer's constants.
BASE = 0x9E3779B97F4A7C15
BASE2 = 0xC2B2AE3D27D4EB4F
MIX1 = np.uint64(0xFF51AFD7ED558CCD)
MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class _Tables(dict):
    """A process's own cache: empty again wherever the code is shipped."""

    def __reduce__(self):
        return (_Tables, ())


_powers = _Tables()


def power_table(base: int, size: int) -> np.ndarray:
    """``base**0 .. base**(size-1)`` modulo 2**64, kept and grown on demand."""
    table = _powers.get(base)
    if table is None or len(table) < size:
        size = max(size, CHUNK + 1, 2 * (0 if table is None else len(table)))
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        _powers[base] = table
    return table


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> SHIFT)) * MIX1
    h = (h ^ (h >> SHIFT)) * MIX2
    return h ^ (h >> SHIFT)


def range_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of ``data[s:e]`` for each range; ranges rise and do not overlap."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    n = len(data)
    terms = np.zeros(n + 1, dtype=np.uint64)
    np.multiply(data, power_table(base, n + 1)[:n], out=terms[:n], dtype=np.uint64)
    terms[:n] += power_table(base, n + 1)[:n]  # so that zero bytes count
    bounds = np.empty(2 * len(starts), dtype=np.int64)
    bounds[::2], bounds[1::2] = starts, ends
    sums = np.add.reduceat(terms, bounds)[::2]
    sums[starts == ends] = 0
    inverse = pow(base, -1, 1 << 64)
    return mix(sums * power_table(inverse, n + 1)[starts] + (ends - starts).astype(np.uint64))


def chunks(column: pa.Array, size: int = CHUNK):
    """``(first row, row offsets, bytes)`` of runs of whole texts of ``size`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, dtype=np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]]
        a = b


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the index of its first word (with an end)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~IS_SPACE[data]
    change = inside[1:] != inside[:-1]
    starts = np.flatnonzero(change & inside[1:])
    ends = np.flatnonzero(change & ~inside[1:])
    # a word never runs across the border of two texts
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[inside[cut + 1] & inside[cut]]
    if len(cut):
        starts = np.sort(np.concatenate([starts, cut]))
        ends = np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and each text's first word index (with an end)."""
    starts, ends, first = word_ranges(data, offsets)
    return range_hash(data, starts, ends), first


# Odd multipliers, one for each place in a shingle.
PLACES = np.array(
    [0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x589965CC75374CC3],
    dtype=np.uint64,
)


def shingle_sets(hashes: np.ndarray, first: np.ndarray, size: int = 5):
    """For each text the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words has its whole sequence as one shingle, one without
    words none.
    """
    n = len(hashes)
    if n >= size:
        joined = sum(
            (mix(hashes[k : n - size + 1 + k] * PLACES[k % len(PLACES)] + np.uint64(k)) for k in range(size)),
            np.zeros(n - size + 1, dtype=np.uint64),
        )
        joined = mix(joined)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield _distinct(joined[a : b - size + 1])
        elif b > a:
            h = sum((mix(hashes[a + k : a + k + 1] * PLACES[k] + np.uint64(k)) for k in range(b - a)), np.zeros(1, dtype=np.uint64))
            yield mix(h + np.uint64(b - a))
        else:
            yield hashes[:0]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.empty(len(values), dtype=bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]
