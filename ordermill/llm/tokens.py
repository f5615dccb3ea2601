"""Token ids of whole texts by a tokenizer file, with each distinct word encoded once a task.

The vocabulary drops white space and starts a new token at every word, so a text's ids are those
of its white-space separated chunks, one after the other. A chunk of letters and an optional run
of marks falls further into two parts that the tokenizer splits too; any other chunk goes to the
tokenizer whole. Results equal ``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from ordermill.llm.text import SLICE_BYTES, hash_spans, ranges, release, segment_sums, slices, texts_of, words

#: What a byte is to the tokenizer: part of a letter, a mark that runs with its neighbours, or neither.
_LETTER, _MARK, _OTHER = 0, 1, 2
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[[b for b in range(33, 127) if _KIND[b] == _OTHER and chr(b) not in "'<0123456789"]] = _MARK
#: Most plain words that go to the tokenizer as one text.
WORDS_A_TEXT = 64


def _byte_level() -> np.ndarray:
    """The code point that stands for each byte in a byte-level vocabulary; a space stays one."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = np.zeros(256, "<u4")
    out[own] = own
    rest = np.flatnonzero(out == 0)
    out[rest] = 256 + np.arange(len(rest))
    out[32] = 32
    return out


_POINTS = _byte_level()
KEPT_CHUNKS = 1_000_000


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def splits_at_space(path: str) -> bool:
    """True for a tokenizer file whose ids do not depend on white space around a word."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = steps[0] if steps else {}
    return (
        spec["model"].get("end_of_word_suffix") == "</w>"
        and first.get("behavior") == "Removed"
        and "\\p{L}" in str(first.get("pattern"))
        and not any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", []))
    )


def is_plain(path: str) -> bool:
    """True for a tokenizer file whose steps before the look-up do no more to a lower-case Latin-1 word,
    or a run of marks, than to turn its bytes into the code points of a byte-level vocabulary."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normalizer, pre_tokenizer = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    lowering = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    steps = pre_tokenizer.get("pretokenizers", [])
    return (
        normalizer.get("normalizers") == lowering
        and len(steps) == 2
        and steps[0].get("invert") is True
        and steps[0].get("pattern")
        == {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
        and (steps[1]["type"], steps[1]["add_prefix_space"], steps[1]["use_regex"]) == ("ByteLevel", False, False)
    )


class Places:
    """Where the ids of a byte string lie, by its hash (not 0): a hash table whose lookups and
    additions take whole arrays. At most half of its slots are taken."""

    def __init__(self, slots: int = 1 << 12):
        self.size = 0
        self.keys = np.zeros(slots, np.uint64)
        self.begin, self.length = np.zeros(slots, np.int64), np.zeros(slots, np.int32)
        self.asked = np.zeros(slots, bool)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each hash, and whether it is there."""
        mask = len(self.keys) - 1
        at = (h & np.uint64(mask)).astype(np.int64)
        key = self.keys[at]
        found = key == h
        left = np.flatnonzero(~found & (key != 0))
        while len(left):
            at[left] = (at[left] + 1) & mask
            key = self.keys[at[left]]
            same = key == h[left]
            found[left[same]] = True
            left = left[~same & (key != 0)]
        return at, found

    def add(self, h: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
        """Adds distinct hashes that are not there yet."""
        if 2 * (self.size + len(h)) > len(self.keys):
            old, used = self.keys, np.flatnonzero(self.keys)
            old, asked = (self.keys[used], self.begin[used], self.length[used]), self.asked[used]
            self.__init__(1 << int(2 * (self.size + len(h)) - 1).bit_length())
            self.add(*old)
            self.asked[self.find(old[0][asked])[0]] = True
        self.size += len(h)
        mask = len(self.keys) - 1
        left, at = np.arange(len(h)), (h & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[left[free]]  # of several for one slot one stays
            mine = self.keys[at] == h[left]
            self.begin[at[mine]], self.length[at[mine]] = begin[left[mine]], length[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & mask


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.maximum(hash_spans(data, starts, ends), np.uint64(1))


class Encoder:
    """Ids of texts. Holds at most about ``KEPT_CHUNKS`` distinct chunks and parts, then starts afresh
    with those it was asked for again since they were learnt, unless they are more than half of that.

    Chunks, and the parts they fall into, are found by 64-bit hashes; each is a range of ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_chunk = splits_at_space(path)
        self.plain = self.by_chunk and is_plain(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.ends_word = np.zeros(self.size, bool)
        self.ends_word[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.places = Places()
        self.flat = np.zeros(0, np.uint16 if self.size <= 1 << 16 else np.uint32)

    def _forget(self) -> None:
        old, flat = self.places, self.flat
        kept = np.flatnonzero(old.asked)
        self._clear()
        if 2 * len(kept) <= KEPT_CHUNKS:
            length = old.length[kept].astype(np.int64)
            self._keep(old.keys[kept], flat[ranges(old.begin[kept], length)], length)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _looked_up(self, texts: list[str]) -> list[list[int]]:
        """Ids of words that are in the vocabulary's own code points already, with a space between two."""
        from tokenizers import pre_tokenizers

        t = self.tokenizer
        steps = t.normalizer, t.pre_tokenizer
        try:
            t.normalizer, t.pre_tokenizer = None, pre_tokenizers.CharDelimiterSplit(" ")
            return [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
        finally:
            t.normalizer, t.pre_tokenizer = steps

    def _keep(self, h: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Adds byte strings with their ids, one after the other."""
        self.places.add(h, len(self.flat) + np.cumsum(lengths) - lengths, lengths)
        self.flat = np.concatenate([self.flat, ids.astype(self.flat.dtype)])

    def _keep_each(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        each = [
            np.array(self._whole(data[a:b].tobytes().decode()), np.uint32)
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
        ]
        if each:
            self._keep(h, np.concatenate(each), np.array([len(ids) for ids in each], np.int64))

    def _keep_words(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Adds parts that are one word each to the tokenizer, so that the ids of one end with the
        first that ends a word. They go there joined by spaces."""
        size = ends - starts + 1
        first = np.concatenate([[0], np.cumsum(size)])
        joined = np.append(data, np.uint8(32))[ranges(starts, size)]
        joined[first[1:] - 1] = 32
        cuts = np.append(np.arange(0, len(h), WORDS_A_TEXT), len(h))
        spans = list(zip(first[cuts[:-1]].tolist(), (first[cuts[1:]] - 1).tolist(), strict=True))
        if self.plain:
            points = _POINTS[joined].tobytes().decode("utf-32-le")
            each = self._looked_up([points[a:b] for a, b in spans])
        else:
            texts = [joined[a:b].tobytes().decode() for a, b in spans]
            each = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(ids) for ids in each], np.int64)
        ids = np.fromiter(chain.from_iterable(each), np.uint32, counts.sum())
        # Texts with as many ends of words as words, the last of them at the end.
        at = np.concatenate([[0], np.cumsum(counts)])
        last = self.ends_word[ids]
        good = (segment_sums(last, at) == np.diff(cuts)) & (counts > 0)
        good[good] = last[at[1:][good] - 1]
        kept = np.repeat(good, counts)
        good = np.repeat(good, np.diff(cuts))
        self._keep(h[good], ids[kept], np.diff(np.flatnonzero(last[kept]) + 1, prepend=0))
        self._keep_each(h[~good], data, starts[~good], ends[~good])

    def _learn(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Adds distinct chunks, given with their hashes."""
        size = ends - starts
        data = data[ranges(starts, size)]
        first = np.concatenate([[0], np.cumsum(size)])
        starts, ends = first[:-1], first[1:]
        kind = _KIND[data]
        # Letters À to ÿ: 0xC3, then a byte other than those of × and ÷.
        lead = np.flatnonzero(data == 0xC3)
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        odd = np.zeros(len(data), bool)
        odd[1:] = (kind[1:] == _LETTER) & (kind[:-1] == _MARK)
        odd[starts] = False
        odd |= kind == _OTHER
        odd = segment_sums(odd, first) > 0
        self._keep_each(h[odd], data, starts[odd], ends[odd])

        middle = starts + segment_sums(kind == _LETTER, first)
        h, starts, middle, ends = h[~odd], starts[~odd], middle[~odd], ends[~odd]
        if not len(h):
            return
        capital = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] <= 0x9E)] + 1
        data[(data >= 65) & (data <= 90)] += 32
        data[capital] += 32
        a, b = np.stack([starts, middle], 1).reshape(-1), np.stack([middle, ends], 1).reshape(-1)
        there = a < b  # a chunk of letters alone, or of marks alone, is one part
        part = np.zeros(len(a), np.uint64)
        part[there] = _keys(data, a[there], b[there])
        distinct, place = np.unique(part[there], return_index=True)
        at, found = self.places.find(distinct)
        self.places.asked[at[found]] = True
        new = ~found
        if new.any():
            place = np.flatnonzero(there)[place[new]]
            self._keep_words(distinct[new], data, a[place], b[place])
        # What is a part of its own is there now.
        left = ~self.places.find(h)[1]
        at = self.places.find(part.reshape(-1, 2)[left].reshape(-1))[0]
        begin, length = self.places.begin[at], self.places.length[at].astype(np.int64)
        self._keep(h[left], self.flat[ranges(begin, length)], length[::2] + length[1::2])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin (one entry more than texts)."""
        if not self.by_chunk:
            each = [self._whole(t) for t in column.fill_null("").to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
            return np.array([i for ids in each for i in ids], np.uint32), first
        if self.places.size > KEPT_CHUNKS:
            self._forget()
        texts = texts_of(column)
        chunks = words(texts)
        hashes = _keys(texts.data, chunks.starts, chunks.ends)
        at, found = self.places.find(hashes)
        self.places.asked[at[found]] = True
        missing = np.flatnonzero(~found)
        if len(missing):
            fresh, place = np.unique(hashes[missing], return_index=True)
            place = missing[place]
            self._learn(fresh, texts.data, chunks.starts[place], chunks.ends[place])
            at, _ = self.places.find(hashes)
        counts = self.places.length[at].astype(np.int64)
        ids = self.flat[ranges(self.places.begin[at], counts)].astype(np.uint32)
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[chunks.first]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker, so that what it learnt serves the next task too."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Gives back what this worker's encoders hold, for the steps after the last one that encodes."""
    _encoders.clear()
    release()


def with_end(ids: np.ndarray, first: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after those of each text."""
    n = len(first) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    new_first = first + np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[new_first[1:] - 1] = False
    out[keep] = ids
    return out, new_first


def encoded_slices(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """For slices of (doc_id, text): the document ids, all token ids, and where each one's begin."""
    coder = encoder(path)
    for batch in slices(batches, "text", limit):
        ids, first = coder.encode(batch.column("text"))
        yield batch.column("doc_id"), *with_end(ids, first, end_id)
