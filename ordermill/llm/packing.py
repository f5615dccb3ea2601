"""Documents packed into sequences of a fixed number of tokens, as few as can be found.

Texts become token ids, each followed by an end id; only what is longer than a sequence is cut,
into pieces of full length and a rest. Packing works on the number of pieces of each length, which
is bounded by the sequence length whatever the corpus: Martello-Toth reduction fixes sets of
pieces that dominate every other way to fill the sequence of the longest piece left, and best-fit
decreasing places the remainder. The plan says for each length which sequences its k-th piece
goes to, so pieces only have to be numbered within their length.

Empty and null texts are one piece with the end id alone. Repeated documents are packed one by
one; ``doc_id`` may be null or repeated. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm import tokens
from ordermill.llm.store import held

SLICE_BYTES = 2 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


@dataclass
class Plan:
    """Groups of equal sequences. Group g holds ``times[g]`` sequences with ids from ``first[g]``,
    each with the lengths ``sizes[g]`` one after the other."""

    capacity: int
    sizes: list[list[int]]
    times: list[int]

    @property
    def sequences(self) -> int:
        return sum(self.times)

    def slots(self) -> tuple[np.ndarray, ...]:
        """For each length and range of ranks: the first sequence, how many of the length each
        sequence takes, and where in the sequence they begin. Ordered by length and rank."""
        rows, used, first = [], {}, 0
        for sizes, times in zip(self.sizes, self.times, strict=True):
            at, k = 0, 0
            while k < len(sizes):
                size, n = sizes[k], 1
                while k + n < len(sizes) and sizes[k + n] == size:
                    n += 1
                begin = used.get(size, 0)
                rows.append((size, begin, first, n, at))
                used[size] = begin + n * times
                at += n * size
                k += n
            first += times
        rows.sort()
        return tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 5


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[list[int], int]], dict[int, int]]:
    """Martello-Toth reduction: sets that some best packing contains, with how often, and what is left.

    For the longest piece w with room r beside it, in this order:
    - nothing fits beside it: {w};
    - a piece of exactly r exists: {w, r};
    - no two pieces fit together beside it: {w, the longest that fits};
    - at most two fit, and the longest that fits alone is at least as long as any fitting pair:
      {w, that one};
    - at most two fit, a is the longest that fits and b the longest that fits beside it, and no two pieces
      longer than b fit together: {w, a, b}, as of any pair that fits one piece is at most as long as a and
      the other as b.
    In each case any packing can be changed to contain the set without using more sequences. A
    piece for which none holds is put aside; after each pass that fixed something the pieces put
    aside are tried again, since what could stand in the way has gone.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    fixed: list[tuple[list[int], int]] = []
    changed = True
    while changed:
        changed = False
        for w in sorted(left, reverse=True):
            while left.get(w):
                room = capacity - w
                lengths = sorted(s for s, n in left.items() if n - (s == w) > 0)
                fit = lengths[: bisect_left(lengths, room + 1)]
                if not fit:
                    chosen = [w]
                elif fit[-1] == room or not _fits(fit, left, w, 2, room) or (
                    not _fits(fit, left, w, 3, room) and fit[-1] >= _best_pair(fit, left, w, room)
                ):
                    chosen = [w, fit[-1]]
                elif not _fits(fit, left, w, 3, room) and (pair := _dominant_pair(fit, left, w, room)):
                    chosen = [w, *pair]
                else:
                    break
                # Fewer pieces only make the conditions easier: the choice holds while all of it last.
                need = Counter(chosen)
                times = min(left[s] // n for s, n in need.items())
                for s, n in need.items():
                    left[s] -= n * times
                    if not left[s]:
                        del left[s]
                fixed.append((chosen, times))
                changed = True
    return fixed, left


def _fits(fit: list[int], left: dict[int, int], w: int, number: int, room: int) -> bool:
    """Whether the ``number`` shortest pieces, without one of length w, fit into ``room``."""
    total = 0
    for s in fit:
        n = min(number, left[s] - (s == w))
        total += n * s
        number -= n
        if not number:
            return total <= room
    return False


def _dominant_pair(fit: list[int], left: dict[int, int], w: int, room: int) -> tuple[int, int] | None:
    """The longest piece that fits and the longest beside it, if no two pieces longer than the second fit."""
    a = fit[-1]
    for k in range(bisect_left(fit, room - a + 1) - 1, -1, -1):
        b = fit[k]
        if left[b] - (b == w) - (b == a) > 0:
            # Without the pieces up to b: do the two shortest left fit together?
            return None if _fits(fit[k + 1 :], left, w, 2, room) else (a, b)
    return None


def _best_pair(fit: list[int], left: dict[int, int], w: int, room: int) -> int:
    best, low, high = 0, 0, len(fit) - 1
    while low <= high:
        if low == high and left[fit[low]] - (fit[low] == w) < 2:
            break
        if (total := fit[low] + fit[high]) <= room:
            best = max(best, total)
            low += 1
        else:
            high -= 1
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit decreasing over lengths with counts: each piece goes to the open sequence with the
    least room that holds it. Equal sequences are kept as one group with a number."""
    rooms: list[int] = []
    open_: dict[int, list[tuple[list[int], int]]] = {}

    def put(room: int, sizes: list[int], times: int) -> None:
        if room not in open_:
            rooms.insert(bisect_left(rooms, room), room)
            open_[room] = []
        open_[room].append((sizes, times))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            k = bisect_left(rooms, size)
            if k == len(rooms):
                fit = capacity // size
                if n >= fit:
                    put(capacity - fit * size, [size] * fit, n // fit)
                    n %= fit
                else:
                    put(capacity - n * size, [size] * n, 1)
                    n = 0
                continue
            room = rooms[k]
            sizes, times = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(k)
            # The piece's sequence then has the least room of all, so the next goes there too.
            fit = min(room // size, n)
            full = min(times, n // fit)
            put(room - fit * size, sizes + [size] * fit, full)
            n -= fit * full
            if times > full:
                put(room, sizes, times - full)
    return [group for room in rooms for group in open_[room]]


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    fixed, left = reduce_dominated(counts, capacity)
    groups = fixed + best_fit(left, capacity)
    return Plan(capacity, [g[0] for g in groups], [g[1] for g in groups])


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    return -(-sum(s * n for s, n in counts.items()) // capacity)


def cut(
    documents: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None
) -> DataFrame:
    """One row per piece, written to the shared folder: doc_id, piece, start, length, ids_crc32, and
    its number (``rank``) among the pieces of its length in one part of the table."""
    path = tokenizer or tokens.default_file()

    def pieces(batches):
        import pyspark

        part = pyspark.TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for ids_of, ids, first in tokens.encoded_slices(batches, path, end_id, SLICE_BYTES):
            lengths = np.diff(first)
            n = -(-lengths // capacity)
            owner = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, lengths[owner] - start)
            begin = first[owner] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(begin.tolist(), length.tolist(), strict=True)]
            rank = np.empty(len(owner), np.int64)
            order = np.argsort(length, kind="stable")
            in_order = length[order]
            new = np.flatnonzero(np.diff(in_order, prepend=-1))
            run = np.diff(np.append(new, len(in_order)))
            rank[order] = np.arange(len(in_order)) - np.repeat(new, run) + seen[in_order]
            seen[in_order[new]] += run
            rows = [pa.array(ids_of.take(pa.array(owner))), piece.astype(np.int32), start, length,
                    np.array(crc, np.int64), np.full(len(owner), part, np.int32), rank]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in rows],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
            )

    return held(documents.select("doc_id", "text").mapInArrow(pieces, PIECES), "pieces")


def length_counts(pieces: DataFrame) -> dict[int, int]:
    """How many pieces have each length: at most ``capacity`` numbers, whatever the corpus."""
    return {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}


def place(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` by the plan.

    Ranks within a part become ranks within the length through the parts' running counts, a small
    table with one row for each part and length; the pieces are not sorted or moved for it.
    """
    w = Window.partitionBy("length").orderBy("part")
    before = (
        pieces.groupBy("length", "part").count()
        .withColumn("before", F.sum("count").over(w) - F.col("count"))
        .select("part", "length", "before")
    )
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    size, begin, first, each, at = plan.slots()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def placed(batches):
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            # lengths first, then ranks: one number per slot that keeps their order
            key = np.searchsorted(_pairs(size, begin), _pairs(length, rank), "right") - 1
            beyond = rank - begin[key]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names[:5]]
                + [pa.array(first[key] + beyond // each[key]), pa.array(at[key] + beyond % each[key] * length)],
                names=names,
            )

    return ranked.mapInArrow(
        placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def _pairs(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Length and rank as one sortable number (lengths stay below 2**20, ranks below 2**43)."""
    return (length.astype(np.int64) << 43) | rank.astype(np.int64)


def pack(
    documents: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    pieces = cut(documents, capacity, end_id, tokenizer)
    return place(pieces, make_plan(length_counts(pieces), capacity))
