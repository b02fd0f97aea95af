"""Array code over Arrow text columns, for use inside Spark tasks.

A slice of rows is one byte array with row bounds. Words, lines and n-grams are found
with whole-array operations, so no Python object is made for a word or a character.
Memory is bounded by the slice (SLICE bytes, or one text when that is longer).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_ROOT_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def byte_class(*members: int, inverse: bool = False) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return ~table if inverse else table


WORD = byte_class(*SPACES, inverse=True)
LETTER = byte_class(*range(65, 91), *range(97, 123), *range(128, 256))
ALNUM = byte_class(*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each row begins (one entry more at the end); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of one hold at most `limit` bytes, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, upto - at)
            at = upto
    release()


def release() -> None:
    """Hands freed memory back to the system: workers are used again for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def spans(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of member bytes inside rows: starts, ends (exclusive), rows."""
    n = len(data)
    if n == 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    inside = member[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (edge[:n] | ~before))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE + 1)
        for name, root in (("up", _ROOT), ("down", _ROOT_INVERSE)):
            p = np.full(size, root, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit Karp-Rabin hash of each span, from running sums of the whole array."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of one row, and the index of each window's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    first = np.flatnonzero(rows[:n] == rows[k - 1 :])
    out = hashes[first]
    for j in range(1, k):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[first + j]
    return mix(out), first


def row_sums(values: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n_rows)
