"""Numpy passes over the bytes of an Arrow string column, shared by the operators that hash words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
# Odd multiplier of the rolling hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes of text, or of one row; what Arrow no longer needs goes back to the system after the last."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    begin = held = 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > limit:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(lengths):
        yield begin, len(lengths)
        pa.default_memory_pool().release_unused()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows one after another, and each row's bounds (nulls are empty)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word (a run of bytes that are no separators, within one row), and each row's first word."""
    inside = np.concatenate([~separator[data], [False]])
    before = np.concatenate([[False], inside[:-1]])
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds[:-1]] = True
    begins = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return begins, ends, np.searchsorted(begins, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, the same wherever the bytes stand."""
    global _powers
    if len(_powers[0]) <= len(data):
        steps = [np.full(len(data) + 1, b, np.uint64) for b in (BASE, _INVERSE)]
        for x in steps:
            x[0] = 1
        _powers = tuple(np.multiply.accumulate(x) for x in steps)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[0][: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * _powers[1][begins] + (ends - begins).astype(np.uint64))


def segment_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive entries of ``firsts``; empty ranges give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[firsts[1:]] - total[firsts[:-1]]
