"""Vectorised word and shingle hashing over Arrow string buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D, which is the
same as ``[^\\x20\\x09-\\x0D]+`` over the text.  Hashes are 64-bit: a random
value per byte, weighted by powers of an odd constant, mixed.  Everything here
works on whole texts; memory is bounded by ``CHUNK_BYTES`` besides the batch
itself, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = CHUNK_BYTES if n <= CHUNK_BYTES else n
    if size in _TABLES:
        return _TABLES[size]
    tables = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
    if size == CHUNK_BYTES:
        _TABLES[size] = tables
    return tables


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offs[0] : offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and ``bounds``: text i has words bounds[i]:bounds[i + 1]."""
    solid = ~_BLANK[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    begin, end = offs[:-1], offs[1:]
    full = end > begin
    first[begin[full]] = solid[begin[full]]
    last[end[full] - 1] = solid[end[full] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + CHUNK_BYTES, side="right")))
        size = int(ends[j - 1] - at)
        up, down = _power_tables(size)
        total = np.empty(size + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[data[at : at + size]] * up[:size], out=total[1:])
        a, b = starts[i:j] - at, ends[i:j] - at
        out[i:j] = mix((total[b] - total[a]) * down[a])
        i = j
    return out


def batches(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a column of about ``limit`` bytes of text each, one row at least."""
    data, offs = text_buffer(texts)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = j


_LANES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``size`` words in a row, and their bounds by text.

    A text of fewer words has one shingle of all its words; one without words has none.
    """
    n = np.diff(bounds)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    total = int(out_bounds[-1])
    text = np.repeat(np.arange(len(n)), count)
    first = bounds[:-1][text] + (np.arange(total) - out_bounds[:-1][text])
    acc = np.zeros(total, np.uint64)
    short = (n < size)[text]
    for k in range(size):
        at = first + k
        lane = words[np.minimum(at, max(len(words) - 1, 0))] * _LANES[k % len(_LANES)] + _U(k + 1)
        if short.any():
            lane[short & (at >= bounds[1:][text])] = _U(0)
        acc += lane
    return mix(acc), out_bounds
