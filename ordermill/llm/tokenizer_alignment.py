"""Alignment of two tokenizers' tokens over the same text, by galloping intersection.

Tokenizer A is a byte-level file of the ``tokenizers`` library and reads a space and the text; B is a
``sentencepiece`` model and reads the text, before which it puts a space itself. Each token stands for
some bytes: an entry of A decoded byte by byte, a piece of B in UTF-8 with U+2581 as a space and <0xHH> as
that byte. A text whose tokens do not give back the space and the text on either side has no tokens here,
nor has a null or empty one. No special token is added, and its string inside a text is plain text.

1. The byte offsets at which tokens end ascend in either list. The shorter list drives: for each of its
   offsets an exponential search goes on from the last position in the longer one, and a binary search
   ends it. Lanes of ``LANE`` offsets do this side by side.
2. The offsets found in both cut the tokens into groups; differences of their ranks in the two lists
   are the tokens a group has on either side.
3. The two tokens that end at one common offset are linked. Links are counted for each pair of ids within
   a block of texts first and then over all blocks, so that what is shuffled are the distinct pairs of each
   block, whatever a pair's share of all links. Every block then gets the counts of its own pairs back.

Steps 1 and 2 are done once a task for each distinct chunk of text (see :class:`Pair`); of a text only the
numbers of its chunks go on. Blocks hold about ``BLOCK_BYTES`` of text, or one longer text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as X
from ordermill.llm.store import held

LANE = 32
BLOCK_BYTES = 4 << 20
KEPT_CHUNKS = 400_000
KEPT_BYTES = 64 << 20
SPACE_MARK = "▁"
def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves,
    the others, in order, for the letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """The bytes of each id, one after the other."""

    def __init__(self, entries: list[bytes]):
        self.length = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.length[ids])

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self.data[X.ranges(self.start[ids], self.length[ids])]


class Pair:
    """Both tokenizers, with the alignment of each distinct chunk of text made once.

    Texts fall into chunks where that cannot change a token: at a single space, and before a single line end,
    between characters that are no white space. A ends a token there by its pattern, B because no piece of it
    goes on from another character to a space and none but that of the byte has a line end. So groups
    end there too. If a tokenizer is not of that kind, a text is one chunk. Chunks are told apart by 64 bits;
    about ``KEPT_CHUNKS`` of them are held, then it starts afresh.
    """

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        letters = _byte_letters()
        names = {i: w for w, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = Vocabulary([_spelt(names.get(i, ""), letters) for i in range(max(names) + 1)])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = Vocabulary([self._piece(i, piece) for i, piece in enumerate(pieces)])
        digits = max(len(self.bytes_a.length), len(self.bytes_b.length))
        self.digits = Vocabulary([b"%d," % i for i in range(digits)])
        with open(file_a, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.cuts = (
            spec.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
            and not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}|\n", piece) for piece in pieces)
            and all(self._same(t) for t in _PROBES)
        )
        self._clear()

    def _piece(self, i: int, piece: str) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return piece.replace(SPACE_MARK, " ").encode()

    def _same(self, text: str) -> bool:
        """Whether the chunks of a text have the tokens of the whole."""
        texts = X.texts_of(pa.array([text]))
        starts, ends, after_line, _ = chunks(texts)
        raw = texts.data.tobytes()
        parts = [raw[i:j].decode() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
        a, _, b, _ = self._encode(parts, after_line)
        whole = self._encode([text], np.zeros(1, bool))
        return np.array_equal(a, whole[0]) and np.array_equal(b, whole[2])

    def _encode(self, parts: list[str], after_line: np.ndarray):
        """Ids of A and of B, each with where those of every part begin."""
        flat_a, flat_b, counts_a, counts_b = [], [], [], []
        for at in range(0, len(parts), 1_000):
            some, bare = parts[at : at + 1_000], after_line[at : at + 1_000].tolist()
            given = [p if own else " " + p for p, own in zip(some, bare, strict=True)]
            encoded = [e.ids for e in self.a.encode_batch_fast(given, add_special_tokens=False)]
            counts_a += map(len, encoded)
            flat_a.append(np.fromiter(chain.from_iterable(encoded), np.int64))
            # After a line end there is no space; the one B puts before the line end is a token of its own.
            encoded = [ids[1:] if own else ids for ids, own in zip(self.b.encode(some, num_threads=1), bare, strict=True)]
            counts_b += map(len, encoded)
            flat_b.append(np.fromiter(chain.from_iterable(encoded), np.int64))
        none = np.zeros(0, np.int64)
        firsts = [np.concatenate([[0], np.cumsum(c)]).astype(np.int64) for c in (counts_a, counts_b)]
        return np.concatenate([none, *flat_a]), firsts[0], np.concatenate([none, *flat_b]), firsts[1]

    def _clear(self) -> None:
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        #: Per chunk: tokens of A and B, whether both give it back, where its links and its text begin.
        self.n_a, self.n_b, self.good = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.link_first, self.text_first = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.links, self.text = np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def _learn(self, hashes: np.ndarray, parts: list[str], after_line: np.ndarray) -> None:
        """Adds chunks, given with their hashes in ascending order."""
        a, a_first, b, b_first = self._encode(parts, after_line)
        wanted = X.texts_of(pa.array([p if own else " " + p for p, own in zip(parts, after_line.tolist(), strict=True)]))
        good = _gives_back(self.bytes_a, a, a_first, wanted) & _gives_back(self.bytes_b, b, b_first, wanted)
        n_a, n_b = np.where(good, np.diff(a_first), 0), np.where(good, np.diff(b_first), 0)
        a = a[np.repeat(good, np.diff(a_first))]
        b = b[np.repeat(good, np.diff(b_first))]
        a_first, b_first = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
        # Either side spells the same bytes, so offsets from the first chunk on agree too.
        at_a, at_b = common_ends(self.bytes_a.ends(a), a_first, self.bytes_b.ends(b), b_first)
        link_first = np.searchsorted(at_a, a_first)
        in_a, in_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        text, text_first = group_texts(self.digits, a, b, in_a, in_b, link_first)
        at = np.searchsorted(self.known, hashes)
        self.slot = np.insert(self.slot, at, len(self.n_a) + np.arange(len(parts)))
        self.known = np.insert(self.known, at, hashes)
        self.n_a, self.n_b = np.concatenate([self.n_a, n_a]), np.concatenate([self.n_b, n_b])
        self.good = np.concatenate([self.good, good])
        self.link_first = np.concatenate([self.link_first, len(self.links) + link_first[1:]])
        self.text_first = np.concatenate([self.text_first, len(self.text) + text_first[1:]])
        self.links = np.concatenate([self.links, a[at_a] << 32 | b[at_b]])
        self.text = np.concatenate([self.text, text])

    def chunk_slots(self, texts: X.Texts) -> tuple[np.ndarray, np.ndarray]:
        """The known chunk each chunk of the texts is, and where the chunks of every text begin."""
        if len(self.known) > KEPT_CHUNKS or len(self.text) > KEPT_BYTES:
            self._clear()
        starts, ends, after_line, first = chunks(texts, self.cuts)
        hashes = X.mix(X.hash_spans(texts.data, starts, ends) + after_line.astype(np.uint64))
        distinct, place, code = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.ones(len(distinct), bool)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        if len(self.known):
            new = self.known[at] != distinct
        if new.any():
            raw, here = texts.data, place[new]
            parts = [raw[i:j].tobytes().decode() for i, j in zip(starts[here].tolist(), ends[here].tolist(), strict=True)]
            self._learn(distinct[new], parts, after_line[here])
        return self.slot[np.searchsorted(self.known, distinct)][code], first


_PROBES = ("ab cd, e's 12 3.4\nnew line\n\ntwo  spaces é ü ﬁ½ 日本 x", "a\nb c\n d e\tf g ", " lead 's ' s\n's\n12 ▁x y▁ z")


def chunks(texts: X.Texts, cuts: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each chunk, whether it begins with a line end, and where the chunks of every text
    begin. A space that separates two chunks belongs to neither. Empty texts have none."""
    data, offsets = texts.data, texts.offsets
    n = len(data)
    at = np.flatnonzero((data == 32) | (data == 10)) if cuts else np.zeros(0, np.int64)
    bounds = np.zeros(n + 1, bool)
    bounds[offsets] = True
    at = at[(at > 0) & (at < n - 1)]
    at = at[~bounds[at] & ~bounds[at + 1]]
    before, after = data[at - 1], data[at + 1]
    # Characters that may be white space: controls, and those of two or three bytes that could be.
    ok = (before > 32) & (before != 127) & (after > 32) & (after != 127) & ~np.isin(after, [0xC2, 0xE1, 0xE2, 0xE3])
    two, three = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    ok &= ~((before >= 0x80) & ((two == 0xC2) | np.isin(three, [0xE1, 0xE2, 0xE3])))
    at = at[ok]
    line = data[at] == 10
    heads = offsets[:-1][np.diff(offsets) > 0]
    starts = np.concatenate([heads, np.where(line, at, at + 1)])
    cut_at = np.concatenate([heads, at])
    order = np.argsort(starts, kind="stable")
    starts, cut_at = starts[order], cut_at[order]
    after_line = np.concatenate([np.zeros(len(heads), bool), line])[order]
    ends = np.append(cut_at[1:], n)[: len(starts)]
    # The last chunk of a text ends with it.
    return starts, ends, after_line, np.searchsorted(starts, offsets)


def _spelt(entry: str, letters: dict[str, int]) -> bytes:
    return bytes(letters[c] for c in entry) if letters.keys() >= set(entry) else b""


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(file_a: str, file_b: str) -> Pair:
    """One per Python worker."""
    if (file_a, file_b) not in _pairs:
        _pairs[file_a, file_b] = Pair(file_a, file_b)
    return _pairs[file_a, file_b]


def search(values: np.ndarray, low: np.ndarray, bound: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each wanted value the first place in [low, bound) of the ascending values that is not below
    it (else bound): steps of 1, 2, 4, … from low, then halving."""
    lo, hi = low.copy(), low.copy()
    active = np.flatnonzero(lo < bound)
    active = active[values[lo[active]] < wanted[active]]
    step = 1
    while len(active):
        lo[active] = hi[active] + 1
        hi[active] = np.minimum(hi[active] + step, bound[active])
        step *= 2
        active = active[hi[active] < bound[active]]
        active = active[values[hi[active]] < wanted[active]]
    active = np.flatnonzero(lo < hi)
    while len(active):
        middle = (lo[active] + hi[active]) // 2
        less = values[middle] < wanted[active]
        lo[active[less]] = middle[less] + 1
        hi[active[~less]] = middle[~less]
        active = active[lo[active] < hi[active]]
    return lo


def gallop(driver: np.ndarray, driver_first, other: np.ndarray, other_first) -> tuple[np.ndarray, np.ndarray]:
    """Places in either list of the values both have, text by text. Each lane of the driver goes on in the
    other list from where its last value was found."""
    counts = np.diff(driver_first)
    lanes = -(-counts // LANE)
    text = np.repeat(np.arange(len(counts)), lanes)
    at = X.ranges(np.zeros(len(counts), np.int64), lanes) * LANE + driver_first[text]
    end = np.minimum(at + LANE, driver_first[text + 1])
    low, bound = other_first[text].astype(np.int64), other_first[text + 1]
    place = np.empty(len(driver), np.int64)
    common = np.zeros(len(driver), bool)
    while len(at):
        low = search(other, low, bound, driver[at])
        place[at] = low
        inside = np.flatnonzero(low < bound)
        common[at[inside]] = other[low[inside]] == driver[at[inside]]
        at = at + 1
        go = at < end
        at, end, low, bound = at[go], end[go], low[go], bound[go]
    found = np.flatnonzero(common)
    return found, place[found]


def common_ends(ends_a, first_a, ends_b, first_b) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common values of ascending lists, text by text; the shorter list drives."""
    shorter = np.diff(first_a) <= np.diff(first_b)
    found = []
    for mine, lists in ((shorter, (ends_a, first_a, ends_b, first_b)), (~shorter, (ends_b, first_b, ends_a, first_a))):
        driver, d_first, other, o_first = lists
        d_count, o_count = np.diff(d_first)[mine], np.diff(o_first)[mine]
        d_rows = X.ranges(d_first[:-1][mine], d_count)
        o_rows = X.ranges(o_first[:-1][mine], o_count)
        d, o = gallop(
            driver[d_rows], np.concatenate([[0], np.cumsum(d_count)]), other[o_rows], np.concatenate([[0], np.cumsum(o_count)])
        )
        found.append((d_rows[d], o_rows[o]))
    (a1, b1), (b2, a2) = found
    a, b = np.concatenate([a1, a2]), np.concatenate([b1, b2])
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _gives_back(words: Vocabulary, ids: np.ndarray, first: np.ndarray, wanted: X.Texts) -> np.ndarray:
    """Which of the texts the tokens spell."""
    sizes = np.diff(wanted.offsets)
    same = X.segment_sums(words.length[ids], first) == sizes
    spelt = words.spell(ids[X.ranges(first[:-1][same], np.diff(first)[same])])
    given = wanted.data[X.ranges(wanted.offsets[:-1][same], sizes[same])]
    same[same] = X.segment_sums(spelt != given, np.concatenate([[0], np.cumsum(sizes[same])])) == 0
    return same


def group_texts(digits: Vocabulary, a, b, in_a, in_b, group_first) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` for each chunk, as bytes, and where each begins."""
    both = in_a + in_b
    start = np.cumsum(both) - both
    ids = np.empty(len(a) + len(b), np.int64)
    ids[X.ranges(start, in_a)] = a
    ids[X.ranges(start + in_a, in_b)] = b
    out = digits.spell(ids).copy()
    after = np.cumsum(digits.length[ids])
    out[after[start + in_a - 1] - 1] = ord("|")
    out[after[start + both - 1] - 1] = ord(";")
    return out, np.append(0, after)[np.append(start, len(ids))[group_first]]


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ranges one after the other, copied in bounded stretches."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(total[-1]), np.uint8)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(total, total[at] + X.HASH_BYTES, "right")) - 1)
        out[total[at] : total[end]] = data[X.ranges(starts[at:end], sizes[at:end])]
        at = end
    return out


ALIGNED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, groups string, chunks binary, "
    "pairs array<struct<pair: long, n: long>>, chunk_links array<int>, chunk_first array<int>"
)
_PAIRS = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
_INTS = pa.list_(pa.int32())
_COUNTED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)
_NAMES = ["block", "doc_id", "n_a", "n_b", "n_groups", "groups", "chunks", "pairs", "chunk_links", "chunk_first"]


def _block_rows(pair: Pair, block: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A row for each text of a block, with the chunks it has by their numbers in the block, and one for the
    block: its linked pairs with their numbers, and which of them each of its chunks has."""
    slots, first = pair.chunk_slots(X.texts_of(batch.column("text")))
    good = (X.segment_sums(~pair.good[slots], first) == 0) & (np.diff(first) > 0)
    n = batch.num_rows
    slots = slots[np.repeat(good, np.diff(first))]
    first = np.concatenate([[0], np.cumsum(np.where(good, np.diff(first), 0))])
    sizes = np.diff(pair.text_first)[slots]
    text = _gathered(pair.text, pair.text_first[slots], sizes)
    # No group separator behind the last group of a text.
    bounds = np.concatenate([[0], np.cumsum(sizes)])[first]
    keep = np.ones(len(text), bool)
    keep[bounds[1:][good] - 1] = False
    offsets = bounds - np.concatenate([[0], np.cumsum(good)])
    groups = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text[keep]))
    distinct, number, seen = np.unique(slots, return_inverse=True, return_counts=True)
    # Frequent chunks get small numbers, which pack well.
    order = np.argsort(-seen, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    distinct, seen, number = distinct[order], seen[order], rank[number]
    kind = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
    raw, width = number.astype(kind).tobytes(), np.dtype(kind).itemsize
    cells = [raw[i * width : j * width] for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    n_links = np.diff(pair.link_first)[distinct]
    links = pair.links[X.ranges(pair.link_first[distinct], n_links)]
    pairs, link_number = np.unique(links, return_inverse=True)
    counts = np.bincount(link_number, weights=np.repeat(seen, n_links), minlength=len(pairs)).astype(np.int64)
    sums = [X.segment_sums(v[slots], first) for v in (pair.n_a, pair.n_b, np.diff(pair.link_first))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, block)), batch.column("doc_id").cast(pa.int64()), *map(pa.array, sums), groups.cast(pa.string()),
         pa.array(cells, pa.binary()), pa.nulls(n, _PAIRS), pa.nulls(n, _INTS), pa.nulls(n, _INTS)], names=_NAMES
    )
    rows = pa.StructArray.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    chunk_first = np.concatenate([[0], np.cumsum(n_links)]).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([block]), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()),
         one(rows), one(pa.array(link_number.astype(np.int32))), one(pa.array(chunk_first))], names=_NAMES
    )


def aligned(documents: DataFrame, file_a: str, file_b: str, groups: Callable[[Column], Column]) -> DataFrame:
    """The rows of all blocks (see :func:`_block_rows`), with ``groups`` applied to the groups' text. Written
    to the shared folder, which settles the numbers of the blocks."""

    def run(batches):
        pair = pair_of(file_a, file_b)
        block = TaskContext.get().partitionId() << 32
        for batch in X.slices(batches, "text", BLOCK_BYTES):
            yield from _block_rows(pair, block, batch)
            block += 1

    rows = documents.select("doc_id", "text").mapInArrow(run, ALIGNED)
    return held(rows.withColumn("groups", F.when(F.col("pairs").isNull(), groups(F.col("groups")))), "aligned")


def _counted_block(rows: pa.Table, answers: pa.Table) -> pa.Table:
    blocks = rows.filter(pc.is_valid(rows["pairs"]))
    texts = rows.filter(pc.is_null(rows["pairs"]))
    pairs = np.asarray(blocks["pairs"].combine_chunks().flatten().field("pair"))
    chunk_links = np.asarray(blocks["chunk_links"].combine_chunks().flatten()).astype(np.int64)
    chunk_first = np.asarray(blocks["chunk_first"].combine_chunks().flatten()).astype(np.int64)
    asked = np.asarray(answers["pair"])
    order = np.argsort(asked)
    place = order[np.searchsorted(asked[order], pairs)][chunk_links] if len(pairs) else np.zeros(0, np.int64)
    kind = np.uint16 if len(chunk_first) - 1 <= 1 << 16 else np.uint32
    cells = texts["chunks"].to_pylist()
    numbers = np.frombuffer(b"".join(cells), kind)
    first = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int64) // np.dtype(kind).itemsize
    best = X.segment_sums(np.asarray(answers["best"])[place], chunk_first)
    links = X.segment_sums(np.asarray(answers["links"])[place], chunk_first)
    X.release()
    return pa.table({
        "doc_id": texts["doc_id"], "n_a": texts["n_a"], "n_b": texts["n_b"], "n_groups": texts["n_groups"],
        "n_links": texts["n_groups"], "n_best": X.segment_sums(best[numbers], first),
        "count_sum": X.segment_sums(links[numbers], first), "groups": texts["groups"],
    })


def align(
    documents: DataFrame, file_a: str | None = None, file_b: str | None = None,
    groups: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """doc_id, n_a and n_b (tokens), n_groups, n_links (pairs of tokens that end together, one a group),
    n_best (links whose pair of ids no pair with the same id of B exceeds in links over all texts), count_sum
    (sum over the links of their pair's links over all texts) and the groups as text, ``a1,a2|b1;a3|b2,b3``.

    ``groups`` is applied to that text before it is stored and shuffled, for who needs less than all of it.
    One row per row given, repeated rows included (they count as often), whatever other columns there are.
    Texts without tokens (null, empty, not given back by both tokenizers) have zeros and empty groups; a null
    doc_id stays null. Texts are taken whole at any length.
    """
    if file_a is None or file_b is None:
        default_a, default_b = default_files()
        file_a, file_b = file_a or default_a, file_b or default_b
    blocks = aligned(documents, file_a, file_b, groups)
    pairs = blocks.where("pairs IS NOT NULL").select(F.col("block").alias("asker"), F.inline("pairs"))
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("links"))
    counts = held(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pair-links")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    known = counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))
    answers = pairs.select("asker", "pair").join(known, "pair").select("asker", "pair", "links", "best")
    return blocks.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_counted_block, _COUNTED)
