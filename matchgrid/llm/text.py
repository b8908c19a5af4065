"""Whole columns of text as byte arrays: words and their hashes in numpy, a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once.
SLICE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL = 0x5851F42D4C957F2D
_INV = pow(_MUL, -1, 1 << 64)
_powers: list[np.ndarray] = []


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Truth by byte value; the ranges are inclusive."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Bytes of words of digits, letters and everything beyond ASCII, and bytes that are no white space.
WORD = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
SOLID = ~byte_table((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads their bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text column; null is empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(raw: np.ndarray, at: np.ndarray, solid: np.ndarray, size: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, rows, starts): runs of whole rows up to ``size`` bytes, each row followed by one space.

    A longer row comes as several slices of its own, cut behind the last byte outside ``solid``; a word longer than a slice
    is never cut.  The cuts depend on the row alone, so results do not depend on how rows were batched.
    """
    n, row = len(at) - 1, 0
    while row < n:
        if at[row + 1] - at[row] > size:
            begin, end = int(at[row]), int(at[row + 1])
            while begin < end:
                stop = min(begin + size, end)
                if stop < end:
                    gap = np.flatnonzero(~solid[raw[begin:stop]])
                    if len(gap):
                        stop = begin + int(gap[-1]) + 1
                    else:
                        while stop < end and solid[raw[stop]]:
                            stop += 1
                yield np.append(raw[begin:stop], np.uint8(32)), np.array([row]), np.array([0])
                begin = stop
            row += 1
            continue
        last = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        while last > row + 1 and at[last] - at[last - 1] > size:
            last -= 1
        rows = np.arange(row, last)
        ends = (at[row + 1 : last + 1] - at[row]).astype(np.int64)
        out = np.insert(raw[at[row] : at[last]], ends, np.uint8(32))
        yield out, rows, at[row:last] - at[row] + np.arange(last - row)
        row = last


def words(data: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes in ``solid``; ``data`` ends outside one."""
    inside = solid[data].view(np.int8)
    edge = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
    return edge[::2], edge[1::2]


class Hashes:
    """Hashes of any substring of ``data`` from one running sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        if not _powers or len(_powers[0]) <= n:
            size = max(n + 1, SLICE + 65536)
            ups, downs = np.full(size, _MUL, np.uint64), np.full(size, _INV, np.uint64)
            ups[0] = downs[0] = 1
            _powers[:] = np.cumprod(ups), np.cumprod(downs)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[0][:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of data[start:end] for each pair, never 0."""
        h = (self.sums[ends] - self.sums[starts]) * _powers[1][starts]
        return np.maximum(mix(h + (ends - starts).astype(np.uint64) * _ODD), np.uint64(1))
