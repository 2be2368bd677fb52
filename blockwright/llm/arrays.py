"""Numpy over Arrow text columns: a batch of texts is one byte array with offsets; no Python object per word.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; A-Z count as a-z. Words are told apart by a 64-bit
polynomial hash, mixed at the end.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[SPACE] = 0
_BYTE[65:91] = _BYTE[97:123]
_ODD = np.uint64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.full(1 << 12, _ODD, np.uint64))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(max(n, 2 * len(_powers)), _ODD, np.uint64))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and len + 1 offsets; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``size`` bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, prefix: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Hash of every word in order, the number of words of each document, and, if asked for, a hash of each word's first bytes."""
    hashes, counts, heads = [], [], []
    for i, j in slices(offsets):
        b = data[offsets[i] : offsets[j]]
        at = offsets[i : j + 1] - offsets[i]
        if not len(b):
            counts.append(np.zeros(j - i, np.int64))
            continue
        solid = ~SPACE[b]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = at[:-1][at[:-1] < len(b)]
        first[inner] = solid[inner]
        starts = np.flatnonzero(first)
        counts.append(np.diff(np.searchsorted(starts, at)))
        if not len(starts):
            continue
        starts = starts.astype(np.int32)
        where = np.arange(len(b), dtype=np.int32)
        where -= starts[np.maximum(np.cumsum(first, dtype=np.int32) - 1, 0)]
        np.maximum(where, 0, out=where)
        values = _BYTE[b]
        values *= powers(int(where.max()) + 1)[where]
        hashes.append(mix(np.add.reduceat(values, starts)))
        if prefix:
            head = np.zeros(len(starts), np.uint64)
            ends = np.append(starts[1:], len(b))
            for k in range(prefix):
                p = starts + k
                head += np.where(p < ends, _BYTE[b[np.minimum(p, len(b) - 1)]], 0).astype(np.uint64) * powers(prefix)[k]
            heads.append(mix(head))
    none = np.zeros(0, np.uint64)
    return (np.concatenate(hashes) if hashes else none, np.concatenate(counts) if counts else np.zeros(0, np.int64), (np.concatenate(heads) if heads else none) if prefix else None)


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on between tasks, beside the JVM that then needs it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)


def freed(batches: Callable) -> Callable:
    """A function of batches that releases its memory when it ends."""

    def run(rows):
        yield from batches(rows)
        release()

    return run


def freed_group(group: Callable) -> Callable:
    """A function of a group's key and table that releases its memory after each group."""

    def run(key, table):
        try:
            return group(key, table)
        finally:
            release()

    return run
