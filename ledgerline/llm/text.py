"""Words and 64-bit hashes of many texts at once, as numpy arrays.

A `TextBlock` holds the bytes of some whole texts end to end. Finding words, lower-casing and hashing
run over the block as array operations, so a task pays per byte and not per Python object.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once. A longer text is a block of its own, and never cut.
BLOCK_BYTES = 1_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_U64 = np.uint64


def _separators(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


# Bytes that belong to a word. Every byte of a multi-byte character does.
SPACED = _separators((0x20, 0x20), (0x09, 0x0D))
ALNUM = _separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = h ^ (h >> _U64(33))
    h = h * _U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U64(33))
    h = h * _U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U64(33))


class _Powers:
    """Powers of the hash base and of its inverse mod 2**64, grown on demand."""

    up = np.ones(1, dtype=_U64)
    down = np.ones(1, dtype=_U64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = 1 << int(n + 1).bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(size, base, dtype=_U64)
                powers[0] = 1
                setattr(cls, name, np.multiply.accumulate(powers))
        return cls.up, cls.down


class TextBlock:
    """Some whole texts. `doc` numbers them from 0; a null text is an empty one."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        lengths = np.diff(offsets)
        if texts.null_count:
            lengths = np.where(texts.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
            texts = texts.fill_null(b"")
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
            offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.empty(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets - offsets[0]
        self.n = len(lengths)

    def words(self, table: np.ndarray) -> "Words":
        inside = table[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        first = self.offsets[:-1][self.offsets[:-1] < len(inside)]
        before[first] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        last = self.offsets[1:][self.offsets[1:] > 0] - 1
        after[last] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return Words(self, starts, ends)


class Words:
    """The words of a block in order: byte spans, and for each text the first word (`first[doc]`)."""

    def __init__(self, block: TextBlock, starts: np.ndarray, ends: np.ndarray):
        self.block, self.starts, self.ends = block, starts, ends
        self.first = np.searchsorted(starts, block.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(block.n), self.counts)

    def hashes(self) -> np.ndarray:
        data = self.block.data
        up, down = _Powers.of(len(data))
        sums = np.zeros(len(data) + 1, dtype=_U64)
        np.cumsum((data.astype(_U64) + _U64(1)) * up[: len(data)], out=sums[1:])
        spans = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(spans + (self.ends - self.starts).astype(_U64) * _U64(0xD6E8FEB86659FD93))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each `size` neighbouring entries; one per position that has them."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=_U64)
    total = np.full(n, size, dtype=_U64)
    factor = 1
    for j in range(size):
        factor = factor * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB & (1 << 64) - 1
        total += hashes[j : j + n] * _U64(factor | 1)
    return mix(total)


# The C library keeps what numpy has freed, up to the peak of any earlier stage.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """A worker lives on between tasks; what it does not need goes back to the machine."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about `limit` bytes of text each, at least one row."""
    if not batch.num_rows:
        return
    sizes = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64
    )
    label = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(label)) + 1), batch.num_rows]
    for low, high in zip(cuts, cuts[1:]):
        yield batch.slice(low, high - low)
    give_back()


def span_hashes(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of the entries of each range [start, stop), whatever its length."""
    up, down = _Powers.of(len(hashes))
    sums = np.zeros(len(hashes) + 1, dtype=_U64)
    np.cumsum((hashes | _U64(1)) * up[: len(hashes)], out=sums[1:])
    spans = (sums[stops] - sums[starts]) * down[starts]
    return mix(spans + (stops - starts).astype(_U64) * _U64(0xD6E8FEB86659FD93))
