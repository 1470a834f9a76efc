"""UTF-8 text as numpy byte arrays: slices of Arrow batches, word boundaries, hashes.

These helpers run inside tasks.  A batch is worked on in slices of a few MB of text, so
memory does not follow the number of rows in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
# Odd multipliers of 64-bit polynomial hashes and of the finaliser.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def text_and_offsets(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and its ``n + 1`` offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pa.concat_arrays([column.cast(pa.large_binary()).fill_null(b"")])
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[:len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(batch, text_column: str, limit: int = SLICE_BYTES) -> Iterator:
    """The rows of a batch in order, in pieces of about ``limit`` bytes of text (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    off = text_and_offsets(batch.column(text_column))[1]        # the copied bytes are not kept
    start = 0
    while start < n:
        stop = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield batch.slice(start, stop - start)
        start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that order by hash is order at random."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX_A
    h = h ^ (h >> np.uint64(27))
    h = h * MIX_B
    return h ^ (h >> np.uint64(31))


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def word_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; words never cross rows."""
    if len(buf) == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    inside = _WORD[buf]
    first, last = off[:-1][np.diff(off) > 0], off[1:][np.diff(off) > 0] - 1
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(off, starts, side="right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    lens = ends - starts
    firsts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    place = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(firsts, lens)
    powers = np.cumprod(np.full(int(lens.max()), BASE, dtype=np.uint64))
    value = (buf[place + np.repeat(starts, lens)].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix(np.add.reduceat(value, firsts) + lens.astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` consecutive entries of ``words``."""
    if len(words) < width:
        return np.zeros(0, dtype=np.uint64)
    n = len(words) - width + 1
    h = np.full(n, np.uint64(width))
    for i in range(width):
        h = mix(h * BASE + words[i:i + n])
    return h


def split_lists(values: np.ndarray, counts: np.ndarray, kind=pa.int64()) -> pa.ListArray:
    """An Arrow list column whose rows hold ``counts`` consecutive entries of ``values``."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
