import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ordermill.llm import text as X
from ordermill.llm import tokens

ALPHABET = "abcXÉéßſKİΣς'’ \t\n.,!?$|<>0123½ñ́ü漢字😀  #*%@-_"
ODD = ["a <|endoftext|> b", "<|endoftext|>x", "I'll can't", None, "", " ", "\n\n", "x" * 5000, "''s's"]


def odd_texts(n=3000, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60))) for _ in range(n)] + ODD


def test_words_are_those_of_the_pattern():
    texts = odd_texts()
    t = X.texts_of(pa.array(texts))
    s = X.words(t)
    for i, text in enumerate(texts):
        mine = [bytes(t.data[a:b]).decode() for a, b in zip(s.starts[s.first[i] : s.first[i + 1]], s.ends[s.first[i] : s.first[i + 1]])]
        assert mine == re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_hashes_depend_on_the_bytes_alone(monkeypatch):
    t = X.texts_of(pa.array(odd_texts()))
    s = X.words(t)
    h = X.hash_spans(t.data, s.starts, s.ends)
    words = [bytes(t.data[a:b]) for a, b in zip(s.starts, s.ends)]
    assert len(set(h.tolist())) == len(set(words)) == len(set(zip(h.tolist(), words)))
    monkeypatch.setattr(X, "HASH_BYTES", 64)
    assert (X.hash_spans(t.data, s.starts, s.ends) == h).all()


def test_windows_stay_inside_their_text():
    t = X.texts_of(pa.array(["a b c d", "", "a b c", None, "b c d"]))
    s = X.words(t)
    at, h = X.windows(X.hash_spans(t.data, s.starts, s.ends), s.first, 3)
    assert at.tolist() == [0, 1, 4, 7]
    assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1]


def test_slices_cover_all_rows_once():
    batch = pa.RecordBatch.from_pydict({"i": list(range(50)), "text": ["x" * (k * 37 % 400) for k in range(50)]})
    parts = list(X.slices(iter([batch]), "text", 500))
    assert sum((p.column("i").to_pylist() for p in parts), []) == list(range(50)) and len(parts) > 10


def test_ids_equal_the_tokenizer():
    coder = tokens.Encoder(tokens.default_file())
    assert coder.by_chunk
    texts = odd_texts()
    for _ in range(2):  # fresh, then known
        ids, first = coder.encode(pa.array(texts))
        want = coder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert all(ids[a:b].tolist() == e.ids for a, b, e in zip(first[:-1], first[1:], want, strict=True))


def test_a_full_cache_starts_afresh(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 10)
    coder = tokens.Encoder(tokens.default_file())
    a = coder.encode(pa.array(["one two three four five six seven eight nine ten eleven"]))[0]
    b = coder.encode(pa.array(["one two three four five six seven eight nine ten eleven"]))[0]
    assert (a == b).all()


def test_words_that_recur_stay_known(monkeypatch):
    """A full cache drops what was not asked for again; the rest does not go to the tokenizer once more."""
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 20)
    coder = tokens.Encoder(tokens.default_file())
    learnt, learn = [], coder._learn
    monkeypatch.setattr(coder, "_learn", lambda h, *rest: (learnt.append(len(h)), learn(h, *rest)))
    for k in range(10):
        text = "The cat, sat " + " ".join(chr(97 + k) * n for n in range(3, 11))
        ids, _ = coder.encode(pa.array([text]))
        assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert learnt == [11] + [8] * 9


@pytest.mark.parametrize("plain", [True, False])
def test_latin_words_of_all_letters_and_marks(plain):
    coder = tokens.Encoder(tokens.default_file())
    assert coder.plain
    coder.plain = plain
    r = random.Random(2)
    letters = [chr(c) for c in range(0x41, 0x100) if chr(c).isalpha()]
    marks = [chr(c) for c in range(0x21, 0xC0) if not chr(c).isspace()]
    pick = lambda of, n: "".join(r.choice(of) for _ in range(r.randint(0, n)))
    texts = letters + marks + [pick(letters, 9) + pick(marks, 3) + " " * r.randint(0, 1) + pick(letters, 3) for _ in range(4000)]
    ids, first = coder.encode(pa.array(texts))
    want = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [e.ids for e in want]


def test_places_take_hashes_that_share_a_slot():
    places = tokens.Places(4)
    h = np.concatenate([np.arange(1, 60) << 32, np.arange(1, 60)]).astype(np.uint64)  # one slot for half of them
    for part in np.array_split(h, 7):
        places.add(part, part.astype(np.int64), np.full(len(part), 3))
        assert 2 * places.size <= len(places.keys)
    at, found = places.find(np.append(h, np.uint64(999)))
    assert found.tolist() == [True] * len(h) + [False]
    assert (places.begin[at[:-1]] == h.astype(np.int64)).all() and places.size == len(h)


def test_a_file_of_another_kind_is_encoded_text_by_text():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = tokens.Encoder(path)
    assert not coder.by_chunk
    texts = ["two  words", "", None, " lead"]
    ids, first = coder.encode(pa.array(texts))
    want = coder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [e.ids for e in want]


@pytest.mark.parametrize("counts", [[], [0], [2, 0, 3]])
def test_end_ids(counts):
    first = np.concatenate([[0], np.cumsum(counts)]).astype(int)
    ids, new = tokens.with_end(np.arange(sum(counts), dtype=np.uint32), first, 99)
    assert len(ids) == sum(counts) + len(counts)
    assert [ids[b - 1] for b in new[1:]] == [99] * len(counts)
