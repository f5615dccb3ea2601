"""Periodic runs of words, found online by catchers of squares.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbouring word
extends; it is reported if it has at least ``exponent`` periods and ``min_words`` words. Any run with two
periods or more is made of squares, stretches u u.

The words arrive in order, one or many at a time. At level k, each completed block of B = 2**k words at a
multiple of B is held by a catcher, which waits for squares whose first half contains the block and whose
half is 2B - 1 to 4B - 2 words long; one block at least lies in the first half of every such square. Each
appended word ends one new window of B words at each level, whose hash is made from two of the level
below. It is compared with the two blocks whose catchers wait at that distance. An equal pair is
extended to both sides, as far as words at that distance are equal; pairs that reach the end of the text
stay open and go on with the next words. A stretch as long as its distance is a square, and all squares
of one distance that overlap are one run. Longer distances inside a run known to have a period that
divides them are not looked at again; of runs over the same words the smallest period stays.

Windows and stretches are compared by 64-bit and 61-bit hashes; the second is a prefix sum modulo the
prime 2**61 - 1, which tells stretches of any length apart, Thue-Morse words included. The work is
n log n and the memory about 100 bytes a word, whatever the text repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm import text as X

EXPONENT = 4
MIN_WORDS = 6
APPEND_WORDS = 1 << 20
_U = np.uint64
_PRIME = _U((1 << 61) - 1)
_BASE = _U(0x12D4B5A9C3E7F163)
_LOW31, _LOW30 = _U((1 << 31) - 1), _U((1 << 30) - 1)


def _modulo(v: np.ndarray) -> np.ndarray:
    v = (v & _PRIME) + (v >> _U(61))
    return np.where(v >= _PRIME, v - _PRIME, v)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1, for values below it."""
    ah, al, bh, bl = a >> _U(31), a & _LOW31, b >> _U(31), b & _LOW31
    middle = ah * bl + al * bh
    return _modulo(_U(2) * ah * bh + (middle >> _U(30)) + ((middle & _LOW30) << _U(31)) + al * bl)


class Stretches:
    """Compares stretches of a growing sequence of hashes."""

    def __init__(self):
        self.sums = np.zeros(1, _U)
        self.powers = np.ones(1, _U)

    def __len__(self) -> int:
        return len(self.sums) - 1

    def append(self, hashes: np.ndarray) -> None:
        size = len(self) + len(hashes)
        while len(self.powers) <= size:
            self.powers = np.concatenate([self.powers, _times(self.powers, _times(self.powers[-1:], _BASE))])
        terms = _times(_modulo(hashes >> _U(3)), self.powers[len(self) : size])
        total = _modulo(_times(_modulo(np.cumsum(terms >> _U(31))), _U(1 << 31)) + np.cumsum(terms & _LOW31))
        self.sums = np.concatenate([self.sums, _modulo(total + self.sums[-1])])

    def equal(self, at: np.ndarray, distance: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` values from ``at`` on equal those ``distance`` further on."""
        here = _modulo(self.sums[at + size] + (_PRIME - self.sums[at]))
        there = _modulo(self.sums[at + distance + size] + (_PRIME - self.sums[at + distance]))
        return _times(here, self.powers[distance]) == there

    def extend(self, at: np.ndarray, distance: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many values from ``at`` on (before ``at``) equal those ``distance`` further on, up to ``most``."""
        size = np.zeros(len(at), np.int64)
        bits = int(most.max(initial=0)).bit_length()
        for step in (1 << b for b in range(bits - 1, -1, -1)):
            some = np.flatnonzero(size + step <= most)
            begin = at[some] - size[some] - step if back else at[some] + size[some]
            size[some[self.equal(begin, distance[some], np.full(len(some), step))]] += step
        return size


class Catchers:
    """Finds the maximal repetitions of a sequence of hashes while it grows. ``max_period`` bounds the
    periods looked for."""

    def __init__(self, max_period: int | None = None):
        self.max_period = max_period
        self.stretches = Stretches()
        #: Hashes of the latest windows of each level, and the place of the first one kept.
        self.tails: list[tuple[int, np.ndarray]] = []
        #: Columns distance, from, to: the values in [from, to) equal those that much further on.
        self.squares = np.zeros((3, 0), np.int64)
        self.open = np.zeros((3, 0), np.int64)
        #: The known run of three periods or more that reaches furthest over each place.
        self.cover = np.zeros(0, np.int64)

    def append(self, hashes: np.ndarray) -> None:
        """Any number of further values; the result does not depend on how they are dealt."""
        old = len(self.stretches)
        self.stretches.append(hashes)
        size = len(self.stretches)
        self.cover = np.concatenate([self.cover, np.full(len(hashes), -1)])
        self._go_on(old)
        below = None
        level = 0
        while True:
            block = 1 << level
            if block > size or (self.max_period is not None and 2 * block - 1 > self.max_period):
                break
            offset, kept = self.tails[level] if level < len(self.tails) else (0, np.zeros(0, _U))
            count, total = offset + len(kept), size - block + 1
            if level == 0:
                fresh = hashes[len(hashes) - (total - count) :]
            else:
                at, windows = below
                one = windows[count - at : total - at]
                two = windows[count + block // 2 - at : total + block // 2 - at]
                fresh = X.mix(one * _U(0x9E3779B97F4A7C15) + X.mix(two + _U(level)))
            windows = np.concatenate([kept, fresh])
            self._catch(block, offset, windows, count, total)
            below = (offset, windows)
            tail = min(len(windows), 5 * block)
            state = (total - tail, windows[len(windows) - tail :].copy())
            self.tails[level : level + 1] = [state]
            level += 1
        shut = self.open[0] + self.open[2] < size
        self.open = self.open[:, ~shut]

    def _go_on(self, old: int) -> None:
        """Extends what reached the old end of the sequence."""
        size = len(self.stretches)
        for found in (self.squares, self.open):
            at = np.flatnonzero(found[0] + found[2] == old)
            if len(at):
                distance, end = found[0, at], found[2, at]
                found[2, at] += self.stretches.extend(end, distance, size - distance - end)
        grown = np.flatnonzero(self.squares[0] + self.squares[2] > old)
        self._mark(grown)
        whole = self.open[2] - self.open[1] >= self.open[0]
        self._add(self.open[:, whole])
        self.open = self.open[:, ~whole]

    def _add(self, found: np.ndarray) -> None:
        before = self.squares.shape[1]
        self.squares = np.concatenate([self.squares, found], axis=1)
        self._mark(np.arange(before, self.squares.shape[1]))

    def _mark(self, runs: np.ndarray) -> None:
        distance, start, end = self.squares[:, runs]
        end = end + distance
        long = np.flatnonzero(end - start >= 3 * distance)
        long = long[np.lexsort((-distance[long], end[long]))]
        sizes = end[long] - start[long]
        place, which = X.ranges(start[long], sizes), np.repeat(runs[long], sizes)
        if not len(place):
            return
        now = self.cover[place]
        known, reach = self.squares[0, now], self.squares[0, now] + self.squares[2, now]
        period, to = np.repeat(distance[long], sizes), np.repeat(end[long], sizes)
        further = (now < 0) | (to > reach) | (to == reach) & (period < known)
        self.cover[place[further]] = which[further]

    def _catch(self, block: int, offset: int, windows: np.ndarray, count: int, total: int) -> None:
        """Compares the windows from place ``count`` on with the blocks 2B - 1 to 4B - 2 places before."""
        first = max(count, 2 * block - 1)
        if first >= total:
            return
        place = np.arange(first, total)
        near = (place - (2 * block - 1)) // block * block
        starts, distances = [], []
        for at in (near, near - block):
            held = np.maximum(at, offset) - offset
            same = np.flatnonzero((at >= offset) & (windows[held] == windows[first - offset :]))
            starts.append(at[same])
            distances.append(place[same] - at[same])
        a, p = np.concatenate(starts), np.concatenate(distances)
        if self.max_period is not None:
            a, p = a[p <= self.max_period], p[p <= self.max_period]
        a, p = self._unknown(a, p, block)
        if not len(a):
            return
        order = np.lexsort((a, p))
        a, p = a[order], p[order]
        new = np.ones(len(a), bool)
        new[1:] = (p[1:] != p[:-1]) | (a[1:] != a[:-1] + block)
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(a)) - 1
        p, start, end = p[head], a[head], a[last] + block
        back = self.stretches.extend(start, p, start, back=True)
        on = self.stretches.extend(end, p, len(self.stretches) - p - end)
        found = np.unique(np.stack([p, start - back, end + on]), axis=1)
        whole = found[2] - found[1] >= p
        self._add(found[:, whole])
        reaches = ~whole & (found[0] + found[2] == len(self.stretches))
        self.open = np.concatenate([self.open, found[:, reaches]], axis=1)

    def _unknown(self, a: np.ndarray, p: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Leaves out pairs that lie in a stretch being followed, and those inside a run with a period
        that divides the distance."""
        run = self.cover[a]
        inside = run >= 0
        if inside.any():
            q, start, end = self.squares[:, run]
            end = end + q
            inside &= (p % q == 0) & (p > q) & (a >= start) & (a + p + block <= end) & (end - start >= p + q)
            a, p = a[~inside], p[~inside]
        live = np.concatenate([self.squares, self.open], axis=1)
        if live.shape[1] and len(a):
            live = live[:, np.isin(live[0], p)]
            key = live[0] << 32 | live[1]
            order = np.argsort(key)
            live, key = live[:, order], key[order]
            at = np.searchsorted(key, p << 32 | a, "right") - 1
            if len(key):
                held = (at >= 0) & (live[0, at] == p) & (a < live[2, at])
                a, p = a[~held], p[~held]
        return a, p

    def runs(self, exponent: int = 2, min_words: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and smallest period of the runs, in order of start, then period."""
        period, start, end = self.squares
        end = end + period
        order = np.lexsort((period, end, start))
        period, start, end = period[order], start[order], end[order]
        keep = np.ones(len(period), bool)
        keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        keep &= (end - start >= exponent * period) & (end - start >= min_words)
        period, start, end = period[keep], start[keep], end[keep]
        order = np.lexsort((period, start))
        return start[order], end[order], period[order]


def runs_of(hashes: np.ndarray, first: np.ndarray, exponent: int, min_words: int, append: int = APPEND_WORDS):
    """Start, end and period of the runs inside each text; places count from the first word of all. Words
    of different texts are never equal here."""
    longest = int(np.diff(first).max(initial=0))
    catchers = Catchers(longest // exponent)
    owned = X.with_owner(hashes, np.repeat(np.arange(len(first) - 1), np.diff(first)))
    for at in range(0, len(owned), append):
        catchers.append(owned[at : at + append])
    return catchers.runs(exponent, min_words)


def joined(texts: X.Texts, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """The given words of each text, joined by single spaces."""
    sizes = ends - starts + 1
    data = np.append(texts.data, np.uint8(32))
    parts = []
    at = 0
    total = np.concatenate([[0], np.cumsum(sizes)])
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(total, total[at] + X.HASH_BYTES, "right")) - 1)
        part = data[X.ranges(starts[at:end], sizes[at:end])]
        part[total[at + 1 : end + 1] - total[at] - 1] = 32
        parts.append(part)
        at = end
    out = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    bounds = total[first]
    some = np.diff(first) > 0
    keep = np.ones(len(out), bool)
    keep[bounds[1:][some] - 1] = False
    offsets = bounds - np.concatenate([[0], np.cumsum(some)])
    return pa.LargeStringArray.from_buffers(
        len(first) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[keep])
    )


FOUND = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"
)


def find(documents: DataFrame, exponent: int = EXPONENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, the runs of each text (in order of start, then period; ``start`` is the number of
    the run's first word, from 0) and the collapsed text: its words without those that a run repeats,
    joined by single spaces.

    One row per row given, repeated rows included, whatever other columns there are. Null and empty texts
    and those of white space alone have no words, no runs and an empty collapsed text; a null doc_id stays
    null. Texts are taken whole at any length, a run may have any period.
    """

    def run(batches):
        for batch in X.slices(batches, "text"):
            texts = X.texts_of(batch.column("text"))
            words = X.words(texts)
            hashes = X.hash_spans(texts.data, words.starts, words.ends)
            start, end, period = runs_of(hashes, words.first, exponent, min_words)
            change = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, end, -1)
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            left = joined(texts, words.starts[kept], words.ends[kept], np.searchsorted(kept, words.first))
            owner = np.searchsorted(words.first, start, "right") - 1
            rows = pa.StructArray.from_arrays(
                [pa.array(start - words.first[owner]), pa.array(end - start), pa.array(period)],
                names=["start", "length", "period"],
            )
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(start, words.first).astype(np.int32)), rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(words.counts), lists, left.cast(pa.string())],
                names=["doc_id", "n_words", "runs", "text"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, FOUND)
