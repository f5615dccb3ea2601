"""Texts as byte arrays: words, lines, hashes and windows of whole Arrow batches at once.

All helpers work inside one task on a bounded slice of rows. Offsets are byte positions; a
text is never cut. Words are runs of bytes other than space and 0x09-0x0D, which are the words
``[^\\x20\\x09-\\x0D]+`` of the decoded text, because UTF-8 never uses those bytes inside a
longer sequence.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
#: 1 for every byte that begins a code point.
LEAD = (np.arange(256) & 0xC0) != 0x80

SLICE_BYTES = 2 << 20
HASH_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_libc = ctypes.CDLL(None)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@dataclass
class Texts:
    """Bytes of some texts, one after the other; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Spans:
    """Byte ranges in order; those of text i are starts[first[i]:first[i + 1]]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def texts_of(column: pa.Array) -> Texts:
    """Null texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about ``limit`` bytes of text each, so that memory stays bounded
    whatever the rows of a batch; one row is never split."""
    for batch in batches:
        release()
        texts = texts_of(batch.column(column)) if batch.num_rows else None
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    release()


def release() -> None:
    """Gives freed memory back to the system. Workers are used again and again, by stages of all kinds;
    what each keeps for later adds up beside the executor's own memory."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def spans(texts: Texts, separator: np.ndarray) -> Spans:
    """Maximal runs without a separator byte; none crosses from one text to the next."""
    inside = ~separator[texts.data]
    size = len(inside)
    before = np.empty(size, bool)
    after = np.empty(size, bool)
    if size:
        before[0] = after[-1] = False
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        bounds = texts.offsets[1:-1]
        before[bounds[bounds < size]] = False
        after[bounds[bounds > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Spans(starts, ends, np.searchsorted(starts, texts.offsets))


def words(texts: Texts) -> Spans:
    return spans(texts, SPACE)


def lines(texts: Texts) -> Spans:
    """Lines that are not empty."""
    return spans(texts, NEWLINE)


def lower_ascii(texts: Texts) -> Texts:
    data = texts.data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    return Texts(data, texts.offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(0)
    if have is None or len(have[0]) < size:
        n = max(size, HASH_BYTES + (1 << 16))
        up, down = np.full(n, _U(_BASE)), np.full(n, _U(_INVERSE))
        up[0] = down[0] = _U(1)
        have = _powers[0] = (np.cumprod(up), np.cumprod(down))
    return have


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, the same wherever the range stands. Ranges are in order and
    apart; they are taken in stretches of about ``HASH_BYTES``, which bounds the memory."""
    out = np.empty(len(starts), _U)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + HASH_BYTES, "right")))
        low = int(starts[at])
        out[at:end] = _hash_spans(data[low : ends[end - 1]], starts[at:end] - low, ends[at:end] - low)
        at = end
    return out


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def chain(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` values in a row, at each place where so many are left."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = h[:n].copy()
    for j in range(1, size):
        out = mix(out * _U(_BASE)) + h[j : j + n]
    return mix(out)


def windows(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (of the first word) and hashes of all windows of ``size`` words inside one text."""
    chained = chain(h, size)
    left = np.repeat(first[1:], np.diff(first))[: len(chained)] - np.arange(len(chained))
    at = np.flatnonzero(left >= size)
    return at, chained[at]


def with_owner(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Values that are equal only for equal hashes of the same owner."""
    return mix(h + (owner.astype(_U) + _U(1)) * _U(0xA0761D6478BD642F))


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values in order. Sorting is many times faster here than a hash table."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] - 1) != 0] if len(values) else values


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i + 1]] for each i, empty ranges included."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, … (counts[0] of them), then those of starts[1], and so on."""
    total = int(counts.sum())
    base = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return base + np.arange(total)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
