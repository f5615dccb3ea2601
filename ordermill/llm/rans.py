"""Blocks of token ids coded by a range asymmetric numeral system with a shared static table.

A block is coded by ``LANES`` interleaved coders: token i belongs to lane i mod LANES, and all
lanes advance together, which numpy does in one operation. Each lane holds a 64-bit state; when a
state grows too large its low 32 bits go to the stream. Every ``CHECKPOINT`` steps the states and
the place in the stream are kept, so that a reader may begin there, and parts of a block decode in
parallel.

Block, little-endian: magic ``RNB1``; uint32 tokens, lanes, steps between checkpoints, number of
checkpoints, words in the stream; crc32 of the tokens as uint32; crc32 of all that follows this
header; per checkpoint uint32 place in the stream and uint64 state of each lane; the stream as
uint32 words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 256
CHECKPOINT = 1024
PRECISION = 20
_LOW = 31
_U = np.uint64
_HEAD = struct.Struct("<4s7I")


class Corrupt(ValueError):
    """A block whose checksum does not fit its bytes."""


def table(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Frequencies that add up to 2**precision, at least 1 for every id, in proportion to counts."""
    size, total = len(counts), 1 << precision
    if size > total:
        raise ValueError("more ids than the precision can tell apart")
    counts = counts.astype(np.float64)
    weight = counts.sum()
    spare = total - size
    share = counts * (spare / weight) if weight else np.full(size, spare / size)
    freq = np.floor(share).astype(np.int64) + 1
    short = total - int(freq.sum())
    order = np.argsort(-(share - np.floor(share)), kind="stable")
    freq[order[:short]] += 1
    return freq.astype(np.uint32)


class Coder:
    """Codes with one table of frequencies."""

    def __init__(self, freq: np.ndarray, precision: int = PRECISION):
        self.precision = precision
        self.freq = freq.astype(_U)
        self.cumulative = np.concatenate([[0], np.cumsum(freq.astype(np.int64))[:-1]]).astype(_U)
        self.limit = self.freq << _U(_LOW - precision + 32)
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq.astype(np.int64))
        return self._symbol

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT) -> bytes:
        n = len(ids)
        lanes = max(1, min(lanes, n))
        steps = -(-n // lanes)
        ids = ids.astype(np.int64)
        freq, start, limit = self.freq[ids], self.cumulative[ids], self.limit[ids]
        state = np.full(lanes, 1 << _LOW, _U)
        shift, low = _U(self.precision), _U(0xFFFFFFFF)
        out: list[np.ndarray] = []
        kept: list[tuple[int, np.ndarray]] = []
        written = 0
        # Last step first; the reader goes the other way.
        for t in range(steps - 1, -1, -1):
            a, b = t * lanes, min((t + 1) * lanes, n)
            x, f = state[: b - a], freq[a:b]
            over = x >= limit[a:b]
            words = (x[over] & low).astype(np.uint32)
            out.append(words)
            written += len(words)
            x = np.where(over, x >> _U(32), x)
            q = x // f
            state[: b - a] = (q << shift) + (x - q * f) + start[a:b]
            if t % every == 0:
                kept.append((written, state.copy()))
        kept.reverse()
        stream = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
        body = b"".join(
            struct.pack("<I", written - w) + s.astype("<u8").tobytes() for w, s in kept
        ) + stream.astype("<u4").tobytes()
        tokens = zlib.crc32(ids.astype("<u4").tobytes())
        return _HEAD.pack(b"RNB1", n, lanes, every, len(kept), written, tokens, zlib.crc32(body)) + body

    def decode(self, block: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The tokens, or those of checkpoints ``start`` up to ``stop`` alone."""
        if len(block) < _HEAD.size or block[:4] != b"RNB1":
            raise Corrupt("no block")
        _, n, lanes, every, points, words, tokens, check = _HEAD.unpack_from(block)
        body = memoryview(block)[_HEAD.size :]
        if len(body) != points * (4 + 8 * lanes) + 4 * words or zlib.crc32(body) != check:
            raise Corrupt("checksum of the bytes")
        stop = points if stop is None else min(stop, points)
        if start >= stop:
            return np.zeros(0, np.uint32)
        one = 4 + 8 * lanes
        at = struct.unpack_from("<I", body, start * one)[0]
        state = np.frombuffer(body, "<u8", lanes, start * one + 4).astype(_U)
        stream = np.frombuffer(body, "<u4", words, points * one)
        first, last = start * every * lanes, min(stop * every * lanes, n)
        out = np.empty(last - first, np.uint32)
        mask, shift, symbol = _U((1 << self.precision) - 1), _U(self.precision), self.symbol
        for a in range(first, last, lanes):
            b = min(a + lanes, last)
            x = state[: b - a]
            slot = x & mask
            s = symbol[slot.astype(np.int64)]
            out[a - first : b - first] = s
            x = self.freq[s] * (x >> shift) + slot - self.cumulative[s]
            under = np.flatnonzero(x < _U(1 << _LOW))
            x[under] = (x[under] << _U(32)) | stream[at : at + len(under)].astype(_U)
            at += len(under)
            state[: b - a] = x
        if start == 0 and stop == points and zlib.crc32(out.astype("<u4").tobytes()) != tokens:
            raise Corrupt("checksum of the tokens")
        return out


def length(block: bytes) -> int:
    return _HEAD.unpack_from(block)[1]
