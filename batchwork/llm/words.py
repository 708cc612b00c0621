"""Word hashing over Arrow batches, vectorised over the batch's UTF-8 bytes.

A word's 64-bit hash is a polynomial of random byte values taken from prefix sums, then
mixed; it depends on the word's bytes alone, so it is the same in every task and run.  The
bytes are handled in blocks that end at a separator, so memory follows the block (or the
longest single word), not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_values(separators: bytes, fold_case: bool = True) -> np.ndarray:
    """A random odd value for each byte; 0 marks separators.  A-Z count as a-z if folded."""
    t = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    if fold_case:
        t[65:91] = t[97:123]
    t[list(separators)] = 0
    return t


WHITESPACE = byte_values(b"\x20\x09\x0a\x0b\x0c\x0d")
# letters, digits and every byte of a character beyond ASCII make words; fixed by contract
ALNUM = byte_values(bytes(b for b in range(128) if not chr(b).isalnum()))
LETTERS = byte_values(bytes(b for b in range(128) if not chr(b).isalpha()))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the offsets of its rows in them."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    d = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]] if len(o) else d, o - o[0] if len(o) else np.zeros(1, np.int64)


class Hasher:
    """Hash the words of texts; keeps its power tables between batches."""

    def __init__(self, values: np.ndarray):
        self.values, self.up, self.down = values, *powers(BLOCK_BYTES + 1)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end byte of every word, and the number of its row, in order."""
        parts = list(self._blocks(data, offsets))
        if not parts:
            e = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), e, e, e
        h, s, t = (np.concatenate(x) for x in zip(*parts))
        return h, s, t, np.searchsorted(offsets, s, "right") - 1

    def _blocks(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        at, size = 0, len(data)
        while at < size:
            end = min(at + BLOCK_BYTES, size)
            while end < size:  # up to a separator or a row's start
                row = offsets[np.searchsorted(offsets, end, "right") - 1]
                gaps = np.flatnonzero(self.values[data[at:end]] == 0)
                cut = max(int(row), at + int(gaps[-1]) + 1 if len(gaps) else 0)
                if cut > at:
                    end = cut
                    break
                end = min(end + BLOCK_BYTES, size)
            if end - at >= len(self.up):
                self.up, self.down = powers(end - at + 1)
            yield self._block(data[at:end], offsets, at)
            at = end

    def _block(self, data: np.ndarray, offsets: np.ndarray, at: int):
        v = self.values[data]
        inside = v != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        lo, hi = np.searchsorted(offsets, [at, at + len(data)])
        starts = offsets[lo:hi] - at  # rows that begin in the block split words too
        first[starts] |= inside[starts]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        s, t = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(v * self.up[:len(data)], out=total[1:])
        return mix((total[t] - total[s]) * self.down[s]), s + at, t + at


def row_blocks(batch: pa.RecordBatch, column: str, block_bytes: int = 8 * BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch whose texts hold about ``block_bytes`` at most (one row at least)."""
    _, offsets = text_bytes(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + block_bytes, "right")) - 1)
        yield batch.slice(at, min(end, n) - at)
        at = min(end, n)
