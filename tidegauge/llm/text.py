"""Whole texts as numpy arrays inside Arrow tasks: bytes, words and hashes of any span in constant time.

A batch is worked on in pieces of about ``PIECE`` bytes, so a task's memory does not depend on its share of the
table. A single text longer than that is one piece of its own; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * PIECE)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


class Sums:
    """Prefix sums of a sequence of 64-bit values; equal spans have equal hashes wherever they stand."""

    def __init__(self, values: np.ndarray) -> None:
        up, self._down = _POWERS.get(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    def span(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sums[stop] - self._sums[start]) * self._down[start] + (stop - start).astype(np.uint64))

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of one length, by start."""
        n = len(self._sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sums[length:] - self._sums[:n]) * self._down[:n] + np.uint64(length))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def byte_sums(data: np.ndarray) -> Sums:
    return Sums(_BYTE_VALUES[data])


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and their offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, ends, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in their order, cut where about ``limit`` bytes of text have come together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _byte_set(text: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text)] = True
    return out


#: Between words: blank, tab, line feed, vertical tab, form feed, carriage return.
BREAKS = _byte_set(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words (runs of bytes outside ``BREAKS``) of some texts; those of text d are first[d] to first[d + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        inside = ~BREAKS[data]
        begins, ends = inside.copy(), inside.copy()
        if len(data):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            edges = offsets[(offsets > 0) & (offsets < len(data))]
            begins[edges] = inside[edges]
            ends[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(begins)
        self.stop = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.sums = byte_sums(data)
        self.hash = self.sums.span(self.start, self.stop)

    def texts_of(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
