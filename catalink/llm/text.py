"""Vectorised text helpers used inside Arrow tasks.

Texts of one Arrow batch are handled as one UTF-8 byte array with document
offsets, in blocks of about a megabyte, so that numpy works on long arrays
whatever the length of a single text.  A longer text forms a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

# Space and the control characters 0x09-0x0D: what separates words.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[ord("A") : ord("Z") + 1] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


@dataclass
class Block:
    """Rows ``first .. first + len(off) - 2`` of an Arrow batch; texts are ``data[off[i]:off[i+1]]``."""

    batch: pa.RecordBatch
    first: int
    data: np.ndarray
    off: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.off) - 1

    def column(self, name: str) -> np.ndarray:
        col = self.batch.column(self.batch.schema.get_field_index(name)).slice(self.first, self.rows)
        return col.to_numpy(zero_copy_only=False)

    def arrow(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name)).slice(self.first, self.rows)

    def text(self, i: int) -> bytes:
        return self.data[self.off[i] : self.off[i + 1]].tobytes()


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut Arrow batches into blocks of about ``size`` bytes of text; a null text is empty."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        col = col.cast(pa.large_binary()) if pa.types.is_binary(col.type) else col.cast(pa.large_string())
        if col.null_count:
            col = col.fill_null(b"" if pa.types.is_large_binary(col.type) else "")
        bufs = col.buffers()
        off = np.frombuffer(bufs[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
        data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
        i, n = 0, len(col)
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
            j = min(j, n)
            yield Block(batch, i, data[off[i] : off[j]], off[i : j + 1] - off[i])
            i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-dependent hash of two hash arrays."""
    return mix(a * _ODD + (b ^ (b >> _S31)) * _M1 + np.uint64(1))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


class Rolling:
    """Karp-Rabin hashes modulo 2^64 of ranges of a symbol array, from prefix sums.

    ``hash(i, j) = sum(sym[k] * base^(k - i))``; the base is odd, so that it
    has an inverse and equal ranges hash alike wherever they start.
    """

    BASE = 0x5851F42D4C957F2D
    INVERSE = pow(BASE, -1, 1 << 64)
    _pow = _inv = np.ones(1, np.uint64)

    def __init__(self, sym: np.ndarray):
        n = len(sym) + 1
        cls = type(self)
        if len(cls._pow) < n:
            size = 1 << (n - 1).bit_length()
            cls._pow, cls._inv = _powers(self.BASE, size), _powers(self.INVERSE, size)
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum(sym * cls._pow[: n - 1], out=self.prefix[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.prefix[end] - self.prefix[start]) * type(self)._inv[start]
        return mix(raw + (end - start).astype(np.uint64) * _ODD)

    def windows(self, length: int) -> np.ndarray:
        """Hash of the ``length`` symbols at every start (empty if there are fewer)."""
        n = len(self.prefix) - 1 - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        raw = (self.prefix[length : length + n] - self.prefix[:n]) * type(self)._inv[:n]
        return mix(raw + np.uint64(length * int(_ODD) % (1 << 64)))


def word_bounds(block: Block, is_space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of the block, and each document's first word (n + 1 offsets)."""
    data, off = block.data, block.off
    n = len(data)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(off), np.int64)
    inside = ~is_space[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = off[:-1][off[:-1] < n]
    begin[edges] = inside[edges]  # a word never runs on into the next document
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    last = off[1:][off[1:] > 0] - 1
    stop[last] = inside[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, off)


def word_hashes(block: Block, fold: np.ndarray | None = None, is_space: np.ndarray = IS_SPACE):
    """64-bit hash of every word, its byte bounds, and the documents' word offsets."""
    starts, ends, first = word_bounds(block, is_space)
    data = fold[block.data] if fold is not None else block.data
    hashes = Rolling(mix(data.astype(np.uint64) + np.uint64(1))).ranges(starts, ends)
    return hashes, starts, ends, first


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... inside each of the consecutive groups of the given lengths."""
    total = int(lengths.sum())
    begin = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(total, dtype=np.int64) - begin
