"""Whole-batch word indexing with numpy.

The text column of an Arrow batch is one byte buffer; words, their hashes and
rolling shingle hashes are computed for a run of rows at once.  Runs are cut
by bytes, so memory does not follow the number of rows in a batch, and the
per-byte work of one very long text is done block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The separators of ``[^\x20\x09-\x0D]+`` (also those of ``bytes.split()``).
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Normalised words: ASCII letters lower-cased, every other ASCII character
# that is no digit separates, bytes of non-ASCII characters are word bytes.
_NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers never vanish
_RUN_BYTES = 1 << 21
_BLOCK_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer (bijective on 64 bits): close inputs get unrelated outputs."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _MULT)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """Words of a run of rows: byte range, row within the run and 64-bit hash
    of each word; ``first[r]:first[r+1]`` are the words of row ``r``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, normalise: bool = False):
        self.data = _LOWER[data] if normalise else data
        space = (_NOT_ALNUM if normalise else _SPACES)[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        left, right = edge[:-1].copy(), edge[1:].copy()
        left[1:] |= space[:-1]
        right[:-1] |= space[1:]
        self.start = np.flatnonzero(left & ~space)
        self.end = np.flatnonzero(right & ~space) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.first = np.searchsorted(self.row, np.arange(len(offsets)))
        self.hash = self._hashes()

    def __len__(self) -> int:
        return len(self.start)

    def _hashes(self) -> np.ndarray:
        """Polynomial hash of each word's bytes, mixed; words in blocks."""
        out = np.empty(len(self.start), dtype=np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + _BLOCK_BYTES)))
            size = self.end[i:j] - self.start[i:j]
            begin = np.cumsum(size) - size
            at = np.arange(int(size.sum())) - np.repeat(begin, size)
            byte = self.data[np.repeat(self.start[i:j], size) + at].astype(np.uint64) + np.uint64(1)
            out[i:j] = np.add.reduceat(byte * _powers(int(size.max()))[at], begin)
            i = j
        return mix64(out)

    def shingles(self, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each word on (``len(self) - k + 1``
        values; those that reach into the next row are to be ignored)."""
        n = max(0, len(self) - k + 1)
        out = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            out = out * _MULT + self.hash[j:n + j]
        return mix64(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    if len(x) < width:
        return x[:0]
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def text_runs(column: pa.Array | pa.ChunkedArray, size: int = _RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) over runs of about ``size``
    bytes; a longer text is a run of its own.  Nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary()) if column.null_count else column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j
