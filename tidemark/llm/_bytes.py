"""Word arithmetic on the UTF-8 bytes of an Arrow string column.

Tasks that look at every word of a corpus work on whole batches of bytes at once: word bounds come
from a table of byte classes and a word's 64-bit hash from prefix sums of a polynomial modulo 2**64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

#: Fixed value: the bytes that separate words, 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Upper-case ASCII letters to lower case; every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2**64; a worker keeps those for chunks of the usual size."""
    known = _known_powers.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    out = np.full(max(n, 1 << 20), base, dtype=np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if len(out) <= 2 << 20:
        _known_powers[base] = out
    return out[:n]


class Chunk:
    """Some consecutive rows of a column: their bytes, and where each row starts."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1


def give_back() -> None:
    """Return freed memory to the system: workers live on, and share a machine with the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunks(column: pa.Array, most: int = 2 << 20, most_rows: int = 1 << 16) -> Iterator[Chunk]:
    """Cut a string column into chunks of at most ``most_rows`` rows and about ``most`` bytes, at
    least a row each. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        end = min(end, row + most_rows)
        yield Chunk(row, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end
    give_back()


def word_bounds(chunk: Chunk, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in byte positions, and the row of each. cut: further places
    (a flag for each byte) before which a word ends."""
    n = len(chunk.data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    inside = ~SPACE[chunk.data]
    fresh = np.zeros(n, dtype=bool)
    fresh[chunk.offsets[:-1][chunk.offsets[:-1] < n]] = True
    if cut is not None:
        fresh |= cut
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (fresh | ~before))
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, ~inside[1:] | fresh[1:]
    ends = np.flatnonzero(inside & after) + 1
    rows = np.searchsorted(chunk.offsets, starts, side="right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word, A-Z lower-cased."""
    low = Chunk(chunk.first, LOWER[chunk.data], chunk.offsets)
    starts, ends, rows = word_bounds(low)
    return span_hashes(low.data, starts, ends), rows


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, a place where each occurs, and for each place the index of its value."""
    codes, found = pd.factorize(values)
    first = np.empty(len(found), dtype=np.int64)
    first[codes[::-1]] = np.arange(len(values) - 1, -1, -1)
    return found, first, codes


def combine(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``n`` consecutive words within a row."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for k in range(n):
        total = total * np.uint64(_BASE) + hashes[k : len(hashes) - n + 1 + k]
    same = rows[: len(rows) - n + 1] == rows[n - 1 :]
    return mix64(total[same]), rows[: len(rows) - n + 1][same]


def sequence_hashes(values: np.ndarray, edges: np.ndarray, odd: int) -> np.ndarray:
    """A 64-bit hash of each run of values from one edge to the next, in their order."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values * np.uint64(odd) + np.uint64(1)) * _powers(_BASE, max(len(values), 1))[: len(values)], out=sums[1:])
    inverse = _powers(_INVERSE, len(values) + 1)
    return mix64((sums[edges[1:]] - sums[edges[:-1]]) * inverse[edges[:-1]] + np.diff(edges).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned integers, as compressed planes of the bytes of their differences."""
    import zstandard

    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Counts in any order, as compressed planes of their bytes."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_counts(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()
