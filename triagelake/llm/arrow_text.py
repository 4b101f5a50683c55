"""Text columns of Arrow batches as byte arrays, cut into words and hashed with numpy.

Every function sees whole texts.  A batch is walked in pieces of whole documents so that the working arrays stay small;
only a single document longer than a piece makes one larger.  A null text counts as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def _table(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Bytes that belong to a word.  Separators are ASCII, so bytes of UTF-8 give the same words as code points.
NOT_SPACE = ~_table([0x20, *range(0x09, 0x0E)])
ALNUM = _table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100), *range(0x41, 0x5B)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the multiplier, modulo 2^64."""
    global _powers
    if len(_powers) < n:
        size = max(4096, 2 * n)
        table = np.full(size, _MULTIPLIER, dtype=np.uint64)
        table[0] = 1
        _powers = np.cumprod(table, dtype=np.uint64)
    return _powers[:n]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw, offsets


def small_batches(batches, column: str | int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about `limit` bytes in the text column; a longer text is a slice of its own.

    Results of a slice go out before the next one is read, so neither side holds a second copy of a whole batch.
    """
    give_back()
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for i, j in pieces(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), limit):
            yield batch.slice(i, j - i)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from stage to stage and keep what they once held."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents with about `limit` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


class Words:
    """Words of some documents: byte ranges (from the first document's start), document numbers, 64-bit hashes."""

    def __init__(self, raw, offsets, member, lower: bool):
        base = offsets[0]
        self.offsets = offsets - base
        self.bytes = raw[base : offsets[-1]]
        if lower:
            self.bytes = LOWER[self.bytes]
        inside = member[self.bytes]
        total = len(inside)
        edge = np.zeros(total + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.empty(total, dtype=bool)
        if total:
            before[0] = False
            before[1:] = inside[:-1]
            before[edge[:-1]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty(total, dtype=bool)
        if total:
            after[-1] = False
            after[:-1] = inside[1:]
            after[edge[1:]] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.inside = inside
        self.doc = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.per_doc = np.bincount(self.doc, minlength=len(offsets) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.per_doc)])

    def hashes(self) -> np.ndarray:
        n = len(self.starts)
        if n == 0:
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        body = np.flatnonzero(self.inside)
        within = np.arange(len(body)) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        values = (self.bytes[body].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[within]
        sums = np.add.reduceat(values, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
        return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, by first word (documents are not looked at)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = (out ^ hashes[k : k + len(out)]) * np.uint64(0xC2B2AE3D27D4EB4F)
        out ^= out >> np.uint64(29)
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's long."""
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)


def replaced(column: pa.Array, changed: dict[int, str]) -> pa.Array:
    """The column with new texts in some rows; the others are not decoded."""
    rows = sorted(changed)
    source = pa.concat_arrays([column, pa.array([changed[r] for r in rows], column.type)])
    places = np.arange(len(column))
    places[rows] = len(column) + np.arange(len(rows))
    return source.take(pa.array(places))
