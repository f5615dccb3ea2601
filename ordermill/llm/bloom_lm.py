"""Language-model scores from quantised n-gram counts in a Bloom filter.

The filter holds, for an n-gram that occurs c times in the training texts, the pairs (n-gram, 1) to
(n-gram, q) with q = 1 + floor(log2 c). A count is read back by probing level after level until one
is missing; level q says that the count is from 2**(q-1) to 2**q - 1. Counts never come back too low, and
too high with the filter's error rate for each further level.

    P(w | h) = (least(hw) + mass * P(w | shorter h)) / (most(h) + mass)
    P(w)     = (least(w) + 0.5) / (N + 0.5 * (V + 1))

``least`` and ``most`` are the ends of the range a level stands for (of a single word as context, the exact
count, which ``base_score`` needs anyway), so the probabilities of all words after a context never add up
to more than 1; what is missing to 1 is the price of quantised counts.

Fitting: texts become blocks of word hashes, stored once; the distinct n-grams of the training texts of each
block move to the segment of their hash, where counts add up and the segment's part of the filter is filled
and stored (:class:`Model`). Scoring: the distinct n-grams of each block to be scored move to the stored
segments, are probed there and the levels found go back to their blocks. Nothing else than probes says what
a count is. A filter grows with the corpus, so it isn't held whole anywhere: a task has one segment of it, of
about ``tokens_a_segment`` n-grams and ``bits_an_entry`` bits per entry, at any size.

The exact word counts behind ``base_score`` move in the same way: a block asks the segments of its
distinct words and gets their counts back.

Words are told apart by a 64-bit hash, n-grams by 32 bits within their segment. Null and empty
texts consist of the end token; repeated rows count each; with no training text N = V = 0. A null
``doc_id`` is never held out. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as X
from ordermill.llm.store import held

END = np.uint64(0x1F83D9ABFB41BD6B)
BLOCK_BYTES = 4 << 20
FAN = 8_192
_U = np.uint64


@dataclass(frozen=True)
class Model:
    """The stored filter (segment, size, probes, bits) and the training totals."""

    segments: DataFrame
    count: int
    order: int
    tokens: int
    words: int


def found_levels(keys: np.ndarray, size: int, probes: int, bits: np.ndarray) -> np.ndarray:
    """Levels of n-grams by probing a segment level after level; 0 if missing."""
    level = np.zeros(len(keys), np.int64)
    at = np.arange(len(keys) if size else 0)
    j = 1
    while len(at):
        ok = np.ones(len(at), bool)
        for i in range(probes):
            live = np.flatnonzero(ok)
            place = probe(keys[at[live]], j, i, np.full(len(live), size))
            ok[live] = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        at = at[ok]
        level[at] = j
        # No count has so many bits; a crowded filter could go on.
        if j == 63:
            break
        j += 1
    return level


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; memory freed after a block goes back to the system."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
            X.release()


def least(level: np.ndarray) -> np.ndarray:
    """The least count a level stands for: 2**(q-1)."""
    return np.where(level > 0, 2.0 ** (level - 1), 0.0)


def most(level: np.ndarray) -> np.ndarray:
    """The largest count a level stands for: 2**q - 1."""
    return 2.0**level - 1


def levels(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return ((keys >> _U(32)) % _U(segments)).astype(np.int64)


def short_key(keys: np.ndarray) -> np.ndarray:
    return keys & _U(0xFFFFFFFF)


def probe(keys: np.ndarray, level: int, i: int, size: np.ndarray) -> np.ndarray:
    h = X.mix(keys + _U(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    step = (h >> _U(32)) | _U(1)
    return ((h + _U(i) * step) % size.astype(_U)).astype(np.int64)


def planes(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bytes as planes of their low, middle and high bytes, compressed."""
    table = values.astype(f"<u{8 if width > 4 else 4}").view(np.uint8).reshape(len(values), -1)[:, :width]
    return zstandard.compress(np.ascontiguousarray(table.T).tobytes(), 1)


def from_planes(raw: bytes, width: int) -> np.ndarray:
    table = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(width, -1)
    full = 8 if width > 4 else 4
    out = np.zeros((table.shape[1], full), np.uint8)
    out[:, :width] = table.T
    return out.reshape(-1).view(f"<u{full}")


BLOCKS = "block long, doc_ids array<long>, held array<boolean>, tokens long, first binary, codes binary, words binary"


def blocks_of(documents: DataFrame, held_out: Column) -> DataFrame:
    """Stored rows of about 4 MB of text: the documents, their words as numbers into the block's
    distinct word hashes (0 is the end token), the most frequent words first."""

    def run(batches: Iterator[pa.RecordBatch]):
        import pyspark

        block = pyspark.TaskContext.get().partitionId() << 24
        for batch in X.slices(batches, "text", BLOCK_BYTES):
            texts = X.lower_ascii(X.texts_of(batch.column("text")))
            spans = X.words(texts)
            n = len(texts)
            h = X.hash_spans(texts.data, spans.starts, spans.ends)
            distinct, code, count = np.unique(h, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(1, len(order) + 1)
            first = spans.first + np.arange(n + 1)
            codes = np.zeros(first[-1], np.int64)
            inner = np.ones(len(codes), bool)
            inner[first[1:] - 1] = False
            codes[inner] = rank[code]
            words = np.concatenate([[END], distinct[order]]).astype("<u8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([batch.column("held").to_pylist()], pa.list_(pa.bool_())),
                 pa.array([len(codes)]), pa.array([first.astype("<i8").tobytes()]), pa.array([planes(codes, 4)]),
                 pa.array([words.tobytes()])],
                names=["block", "doc_ids", "held", "tokens", "first", "codes", "words"],
            )
            block += 1

    rows = documents.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    return held(rows.mapInArrow(run, BLOCKS), "lm-blocks")


class Block:
    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.held = np.array(row["held"], bool)
        self.first = np.frombuffer(row["first"], "<i8")
        self.codes = from_planes(row["codes"], 4).astype(np.int64)
        self.words = np.frombuffer(row["words"], "<u8").astype(_U)
        self.owner = np.repeat(np.arange(len(self.doc_ids)), np.diff(self.first))
        self.place = np.arange(len(self.codes)) - self.first[self.owner]

    def train_counts(self) -> np.ndarray:
        return np.bincount(self.codes[~self.held[self.owner]], minlength=len(self.words))

    def ngrams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Last positions and keys of all n-grams inside a text."""
        h = self.words[self.codes]
        keys = X.mix(X.chain(h, order) + _U(order))
        last = np.arange(order - 1, len(h))
        inside = self.place[last] >= order - 1
        return last[inside], keys[inside]

    def asked(self, order: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct n-grams up to ``order`` as (segment, short key) in one number, in order; the place
        among them of each word and then of each n-gram in the text, their training counts, and
        the last positions of the n-grams of each order from 2 on."""
        keys, weights, lasts = [X.mix(X.chain(self.words, 1) + _U(1))], [self.train_counts()], []
        for k in range(2, order + 1):
            last, found = self.ngrams(k)
            keys.append(found)
            weights.append(~self.held[self.owner[last]])
            lasts.append(last)
        flat = np.concatenate(keys)
        placed = (segment_of(flat, segments).astype(_U) << _U(32)) | short_key(flat)
        distinct, code = np.unique(placed, return_inverse=True)
        return distinct, code, np.concatenate(weights), lasts


def word_totals(blocks: DataFrame, segments: int) -> DataFrame:
    """Stored answers: for each block and segment the training counts of the block's words there,
    in the order they have in the block. The row with block -1 has how many words and tokens of the
    training texts fall to the segment."""

    def ask(batches):
        for row in _rows(batches):
            b = Block(row)
            count, seg = b.train_counts(), (b.words % _U(segments)).astype(np.int64)
            order = np.argsort(seg, kind="stable")
            cuts = np.searchsorted(seg[order], np.arange(segments + 1))
            some = np.flatnonzero(np.diff(cuts))
            parts = [order[cuts[s] : cuts[s + 1]] for s in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([row["block"]] * len(some)),
                 pa.array([b.words[p].astype("<u8").tobytes() for p in parts]),
                 pa.array([planes(count[p], 4) for p in parts])],
                names=["segment", "block", "words", "counts"],
            )

    def answer(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, "<u8") for w in table["words"].to_pylist()]
        counts = [from_planes(c, 4) for c in table["counts"].to_pylist()]
        flat = np.concatenate(words)
        distinct, code = np.unique(flat, return_inverse=True)
        total = np.bincount(code, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        at = np.cumsum([0] + [len(w) for w in words])
        each = [planes(total[code[a:z]], 8) for a, z in zip(at[:-1], at[1:], strict=True)]
        segment = table["segment"][0].as_py()
        return pa.table({
            "block": pa.array(table["block"].to_pylist() + [-1], pa.int64()),
            "segment": pa.array([segment] * (len(each) + 1), pa.int64()),
            "totals": pa.array([*each, None], pa.binary()),
            "n_words": pa.array([None] * len(each) + [int((total > 0).sum())], pa.int64()),
            "n_tokens": pa.array([None] * len(each) + [int(total.sum())], pa.int64()),
        })

    asked = blocks.mapInArrow(ask, "segment long, block long, words binary, counts binary")
    answers = asked.groupBy("segment").applyInArrow(
        answer, "block long, segment long, totals binary, n_words long, n_tokens long"
    )
    return held(answers, "lm-words")


def _width(segments: int) -> int:
    """Segments in one range that blocks send to."""
    return -(-segments // FAN)


def _training(blocks: DataFrame, segments: int, order: int) -> DataFrame:
    """For each block and range the block's distinct training n-grams there, with their counts."""
    width = _width(segments)

    def send(batches):
        for row in _rows(batches):
            distinct, code, weight, _ = Block(row).asked(order, segments)
            count = np.bincount(code, weights=weight, minlength=len(distinct)).astype(np.int64)
            some = count > 0
            yield from _messages(row["block"], distinct[some], 0, segments, width, count[some])

    return blocks.mapInArrow(send, "segment long, block long, keys binary, counts binary")


def _asked(blocks: DataFrame, segments: int, order: int) -> DataFrame:
    """For each block and range the block's distinct n-grams there."""
    width = _width(segments)

    def send(batches):
        for row in _rows(batches):
            yield from _messages(row["block"], Block(row).asked(order, segments)[0], 0, segments, width)

    return blocks.mapInArrow(send, "segment long, block long, keys binary")


def _messages(
    block: int, keys: np.ndarray, first: int, last: int, width: int, counts: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """Keys (segment and short key in one number, in order) to the ranges of ``width`` segments from ``first``
    to ``last``: range, block, and the keys there, counted from the start of the range."""
    bounds = np.arange(first, last + width, width).astype(_U) << _U(32)
    cuts = np.searchsorted(keys, bounds)
    some = np.flatnonzero(np.diff(cuts))
    parts = list(zip(bounds[some], cuts[some].tolist(), cuts[some + 1].tolist(), strict=True))
    columns = [pa.array((bounds[some] >> _U(32)).astype(np.int64) // width), pa.array([block] * len(some), pa.int64()),
               pa.array([planes(np.diff(keys[a:z], prepend=low), 8 if width > 1 else 4) for low, a, z in parts], pa.binary())]
    if counts is not None:
        columns.append(pa.array([planes(counts[a:z], 4) for _, a, z in parts], pa.binary()))
    yield pa.RecordBatch.from_arrays(columns, names=["segment", "block", "keys", "counts"][: len(columns)])


def _keys(packed: bytes, width: int = 1) -> np.ndarray:
    return np.cumsum(from_planes(packed, 8 if width > 1 else 4).astype(_U))


def _grouped(sent: DataFrame, blocks: DataFrame) -> DataFrame:
    """The messages with the asker their block belongs to."""
    askers = max(1, -(-blocks.count() // FAN))
    return sent.withColumn("asker", F.pmod(F.xxhash64("block"), F.lit(askers)))


def _merged(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The distinct keys of an asker's blocks in a range, the place among them of each key of each block, and
    how many keys each block has."""
    each = [_keys(k, width) for k in table["keys"].to_pylist()]
    distinct, code = np.unique(np.concatenate(each), return_inverse=True)
    return distinct, code, [len(k) for k in each]


def _to_segments(sent: DataFrame, width: int, segments: int) -> DataFrame:
    """The messages of each asker to a range, merged and sent on to its segments (with ``block`` the asker)."""
    counted = "counts" in sent.columns

    def split(table: pa.Table) -> pa.Table:
        distinct, code, _ = _merged(table, width)
        total = None
        if counted:
            flat = np.concatenate([from_planes(c, 4) for c in table["counts"].to_pylist()])
            total = np.bincount(code, weights=flat, minlength=len(distinct)).astype(np.int64)
        first = table["segment"][0].as_py() * width
        out = _messages(table["asker"][0].as_py(), distinct + (_U(first) << _U(32)), first, min(first + width, segments), 1, total)
        X.release()
        return pa.Table.from_batches(list(out))

    schema = "segment long, block long, keys binary" + (", counts binary" if counted else "")
    return sent.groupBy("segment", "asker").applyInArrow(split, schema)


def _filled(keys: np.ndarray, counts: np.ndarray, bits_an_entry: float) -> tuple[int, int, np.ndarray]:
    """Size in bits, number of probes and bytes of a segment with these n-grams."""
    level = levels(counts)
    entries = int(level.sum())
    size = int(max(64, bits_an_entry * entries)) // 64 * 64
    probes = max(1, min(16, round(size / max(entries, 1) * 0.69)))
    bits = np.zeros(size, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        mine = keys[level >= j]
        for i in range(probes):
            bits[probe(mine, j, i, np.full(len(mine), size))] = True
    return size, probes, np.packbits(bits, bitorder="little")


def filter_segments(blocks: DataFrame, segments: int, order: int, bits_an_entry: float = 10.0) -> DataFrame:
    """The stored filter of the training texts: a row per segment that has an n-gram."""

    def fill(table: pa.Table) -> pa.Table:
        flat = np.concatenate([_keys(k) for k in table["keys"].to_pylist()])
        counts = np.concatenate([from_planes(c, 4) for c in table["counts"].to_pylist()])
        distinct, code = np.unique(flat, return_inverse=True)
        total = np.bincount(code, weights=counts, minlength=len(distinct)).astype(np.int64)
        size, probes, bits = _filled(distinct, total, bits_an_entry)
        X.release()
        return pa.table({
            "segment": table["segment"][:1], "size": pa.array([size], pa.int64()),
            "probes": pa.array([probes], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary()),
        })

    sent, width = _training(blocks, segments, order), _width(segments)
    if width > 1:
        sent = _to_segments(_grouped(sent, blocks), width, segments)
    return held(sent.groupBy("segment").applyInArrow(fill, "segment long, size long, probes long, bits binary"), "lm-filter")


def probed(blocks: DataFrame, model: Model) -> DataFrame:
    """Stored answers: for each block and segment the levels of the block's distinct n-grams there, in
    the order of their keys, read from the stored filter."""

    def answer(asked: pa.Table, part: pa.Table) -> pa.Table:
        keys = [_keys(k) for k in asked["keys"].to_pylist()]
        at = np.cumsum([0] + [len(k) for k in keys])
        level = np.zeros(at[-1], np.uint8)
        if len(part) and len(keys):
            row = part.to_pylist()[0]
            distinct, code = np.unique(np.concatenate(keys), return_inverse=True)
            level = found_levels(distinct, row["size"], row["probes"], np.frombuffer(row["bits"], np.uint8)).astype(np.uint8)[code]
        X.release()
        return pa.table({
            "block": asked["block"], "segment": asked["segment"],
            "levels": pa.array([zstandard.compress(level[a:z].tobytes(), 1) for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary()),
        })

    def dealt(sent: pa.Table, answers: pa.Table) -> pa.Table:
        distinct, code, sizes = _merged(sent, width)
        parts = sorted(zip(answers["segment"].to_pylist(), answers["levels"].to_pylist(), strict=True))
        level = np.frombuffer(b"".join(zstandard.decompress(p) for _, p in parts), np.uint8)[code]
        at = np.cumsum([0, *sizes])
        X.release()
        return pa.table({
            "block": sent["block"], "segment": sent["segment"],
            "levels": pa.array([zstandard.compress(level[a:z].tobytes(), 1) for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary()),
        })

    kept = model.segments.withColumnRenamed("segment", "part").groupBy("part")
    schema = "block long, segment long, levels binary"
    sent, width = _asked(blocks, model.count, model.order), _width(model.count)
    if width == 1:
        return held(sent.groupBy("segment").cogroup(kept).applyInArrow(answer, schema), "lm-levels")
    sent = held(_grouped(sent, blocks), "lm-asked")
    asked = _to_segments(sent, width, model.count).groupBy("segment").cogroup(kept).applyInArrow(answer, schema)
    back = asked.select(F.col("block").alias("to"), F.floor(F.col("segment") / width).alias("range"), "segment", "levels")
    both = sent.groupBy("segment", "asker").cogroup(back.groupBy("range", "to"))
    return held(both.applyInArrow(dealt, schema), "lm-levels")


def log_probabilities(
    block: Block, level: np.ndarray, code: np.ndarray, lasts: list[np.ndarray], exact: np.ndarray,
    mass: float, tokens: int, words: int,
) -> np.ndarray:
    """log10 of the smoothed probability of each token of a block, from the levels of its distinct
    n-grams and the exact counts of its words; ``code`` and ``lasts`` are those of ``Block.asked``."""
    found, at = level[code], len(block.words)
    p = (least(found[:at][block.codes]) + 0.5) / (tokens + 0.5 * (words + 1))
    context = exact[block.codes].astype(float)
    for k, last in enumerate(lasts, 2):
        mine = np.zeros(len(block.codes), np.int64)
        mine[last] = found[at : at + len(last)]
        at += len(last)
        before = np.concatenate([[0.0], context[:-1]])
        has = block.place >= k - 1
        p = np.where(has, (np.minimum(least(mine), before) + mass * p) / (before + mass), p)
        context = most(mine)
    return np.log10(p)


def score(
    documents: DataFrame, held_out: Column, order: int = 3, mass: float = 4.0,
    bits_an_entry: float = 10.0, tokens_a_segment: int = 1 << 21,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    blocks = blocks_of(documents, held_out)
    size = blocks.agg(F.sum("tokens")).first()[0] or 0
    # Segments follow the data, so that what meets in one task stays the same at any size.
    segments = max(8, int(size * order // tokens_a_segment))
    answers = word_totals(blocks, segments)
    seen, total = (n or 0 for n in answers.where("block = -1").agg(F.sum("n_words"), F.sum("n_tokens")).first())
    model = Model(filter_segments(blocks, segments, order, bits_an_entry), segments, order, total, seen)
    found = probed(blocks, model)

    def run(batches):
        for row in _rows(batches):
            b = Block(row)
            seg = (b.words % _U(segments)).astype(np.int64)
            order_ = np.argsort(seg, kind="stable")
            got = sorted((a for a in row["answers"] if a["totals"] is not None), key=lambda a: a["segment"])
            c = np.empty(len(b.words), np.int64)
            c[order_] = np.concatenate([from_planes(a["totals"], 8).astype(np.int64) for a in got])
            base = np.log10((c + 0.5) / (total + 0.5 * (seen + 1)))
            got = sorted((a for a in row["answers"] if a["levels"] is not None), key=lambda a: a["segment"])
            level = np.frombuffer(b"".join(zstandard.decompress(a["levels"]) for a in got), np.uint8).astype(np.int64)
            _, code, _, lasts = b.asked(order, segments)
            log_p = log_probabilities(b, level, code, lasts, c, mass, total, seen)
            n = np.diff(b.first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.doc_ids, pa.int64()), pa.array(b.held), pa.array(n),
                 pa.array(X.segment_sums((c > 0)[b.codes], b.first)),
                 pa.array(np.full(len(n), total, np.int64)),
                 pa.array(_sums(base[b.codes], b.first)), pa.array(_sums(log_p, b.first))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    both = answers.where("block >= 0").select("block", "segment", "totals").unionByName(found, allowMissingColumns=True)
    got = both.groupBy("block").agg(F.collect_list(F.struct("segment", "totals", "levels")).alias("answers"))
    return blocks.join(got, "block").mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums by text, each added up on its own so that its value does not depend on its neighbours."""
    return np.add.reduceat(values, first[:-1]) if len(first) > 1 else np.zeros(0)
