"""Words and windows of Arrow text columns as NumPy arrays, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time; a longer document is worked on alone.
SLICE = 1 << 20
U64 = np.uint64


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes in the inclusive ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


#: Bytes outside words.
SPACES = byte_table((0x20, 0x20), (0x09, 0x0D))
NON_WORDS = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


_BYTE = constants(256, 11)
_STEP = 0xD1342543DE82EF95
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n - 1 of the polynomial's base, and of its inverse modulo 2**64."""
    for k, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
        while len(_POWERS[k]) < n:
            old = _POWERS[k]
            _POWERS[k] = np.concatenate([old, old * U64(pow(base, len(old), 1 << 64))])
    return _POWERS[0][:n], _POWERS[1][:n]


def column(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null is empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if values.null_count:
        values = pc.fill_null(values, "")
    values = values.cast(pa.large_string())
    _, at, data = values.buffers()
    offsets = np.frombuffer(at, np.int64)[values.offset : values.offset + len(values) + 1] if at else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def parts(values, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of each slice of a text column."""
    data, offsets = column(values)
    for i, j in slices(offsets, most):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def words(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document and the number of words) of the maximal runs of bytes not ``outside``."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~outside[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, "right")))
        base = starts[i]
        part = data[base : ends[j - 1]]
        up, down = powers(len(part))
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(_BYTE[part] * up, out=total[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[b] - total[a]) * down[a] + (b - a).astype(U64))
        i = j
    return out


def byte_windows(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` bytes, by its start."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.empty(n, U64)
    for i in range(0, n, SLICE):
        part = data[i : min(i + SLICE, n) + length - 1]
        up, down = powers(len(part))
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(_BYTE[part] * up, out=total[1:])
        m = len(part) - length + 1
        out[i : i + m] = mix((total[length:] - total[:m]) * down[:m] + U64(seed))
    return out


def windows(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` hashes, by its start, across document borders."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for k, c in enumerate(constants(length, 1000 + seed)):
        total += hashes[k : k + n] * c
    return mix(total + U64(length))


def repeat_ranges(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, value) for the values first .. first + count - 1 of every range."""
    which = np.repeat(np.arange(len(first)), count)
    skipped = np.concatenate([[0], np.cumsum(count)])[:-1]
    return which, np.arange(len(which)) - skipped[which] + first[which]
