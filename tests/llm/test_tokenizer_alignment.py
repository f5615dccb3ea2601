import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ordermill.llm import queries, tokenizer_alignment

ODD = [
    "Hello, world! It's 3.14 o'clock.", "naïve café — ünïcödé", "日本語のテキスト and English", "a▁b", "tabs\tand\n\nlines  and   spaces ",
    " leading", "<|endoftext|> and <s> </s> <unk> <0x41>", "😀 emoji 👩‍👩‍👧 family", "x", " ", "\x00\x01 control", "ﬁ ligature ½",
    "don't DON'T we'll", "a" * 300, "end\n", "aeiou" * 20 + " 1234567890", " nbsp　wide", "é combining",
]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def letters():
    """The byte of each letter of the byte-level vocabulary."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def plain(both, texts):
    """The whole contract in plain Python, text by text."""
    a, b = both
    byte_of, rows, links = letters(), [], Counter()
    for text in texts:
        rows.append(([], [], []))
        if not text:
            continue
        encoded = a.encode(" " + text, add_special_tokens=False)
        ids = encoded.ids
        a_bytes = [bytes(byte_of[c] for c in t) for t in encoded.tokens]
        b_ids = b.encode(text)
        b_bytes = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, b.id_to_piece(i)) for i in b_ids)
        ]
        want = (" " + text).encode()
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
        groups, pairs, i, j = [], [], 0, 0
        rank = [{end: k + 1 for k, end in enumerate(side)} for side in ends]
        for end in sorted(set(ends[0]) & set(ends[1])):
            x, y = rank[0][end], rank[1][end]
            groups.append(",".join(map(str, ids[i:x])) + "|" + ",".join(map(str, b_ids[j:y])))
            pairs.append((ids[x - 1], b_ids[y - 1]))
            i, j = x, y
        links.update(pairs)
        rows[-1] = (ids, b_ids, groups, pairs)
    best = Counter()
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    out = []
    for mine, others, groups, *pairs in rows:
        pairs = pairs[0] if pairs else []
        out.append((
            len(mine), len(others), len(groups), len(pairs), sum(links[p] == best[p[1]] for p in pairs),
            sum(links[p] for p in pairs), ";".join(groups),
        ))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def test_equals_plain_python_on_odd_texts(docs, both):
    r = random.Random(1)
    texts = ODD + [None, ""] + [" ".join(r.choice(ODD) for _ in range(5)) for _ in range(40)] + ODD[:3]
    df = docs([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, block int").repartition(4)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in tokenizer_alignment.align(df).collect()}
    want = plain(both, texts)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] == 0 for w in want) >= 3 and max(w[2] for w in want) > 20


def test_chunks_change_nothing(docs, both):
    """Texts of many chunks, one of them far longer than a block."""
    r = random.Random(2)
    long = " ".join(r.choice(ODD[0].split() + ["plain", "words", "übung", "line\nend", "it's", "two\n\nlines"]) for _ in range(30_000))
    pair = tokenizer_alignment.pair_of(*tokenizer_alignment.default_files())
    assert pair.cuts
    for text in [long, *ODD, *("".join(r.choice("ab .'\n\t1é\u00a0\u3000▁日\x1c") for _ in range(60)) for _ in range(600))]:
        assert pair._same(text), text[:80]
    df = docs([(1, long), (2, long), (3, ODD[0]), (4, "x" * 50_000)])
    got = {x["doc_id"]: tuple(x[c] for c in COLUMNS) for x in tokenizer_alignment.align(df).collect()}
    want = plain(both, [long, long, ODD[0], "x" * 50_000])
    assert all(got[i + 1] == w for i, w in enumerate(want))


def test_what_is_known_is_bounded(both, monkeypatch):
    monkeypatch.setattr(tokenizer_alignment, "KEPT_CHUNKS", 5)
    pair = tokenizer_alignment.Pair(*tokenizer_alignment.default_files())
    import pyarrow as pa

    from ordermill.llm import text as X

    for text in ("a b c d e f g", "a b", "h i j"):
        slots, first = pair.chunk_slots(X.texts_of(pa.array([text])))
        assert len(slots) == len(text.split()) and pair.n_a[slots].sum() == len(both[0].encode(" " + text).ids)
    assert len(pair.known) == 5


def test_galloping_finds_all_common_values():
    r = random.Random(3)
    for _ in range(200):
        lists = [[sorted(r.sample(range(200), r.randint(0, 90))) for _ in range(4)] for _ in range(2)]
        flat = [np.array([x for one in side for x in one], np.int64) for side in lists]
        first = [np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64) for side in lists]
        a, b = tokenizer_alignment.common_ends(flat[0], first[0], flat[1], first[1])
        want = [(first[0][t] + x.index(v), first[1][t] + y.index(v)) for t, (x, y) in enumerate(zip(*lists, strict=True)) for v in sorted(set(x) & set(y))]
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_odd_rows(docs):
    df = docs([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_links"], r["n_best"], r["count_sum"]) for r in tokenizer_alignment.align(df).collect())
    assert got == [(0, 2, 2, 6), (1, 2, 2, 6), (1, 2, 2, 6), (2, 0, 0, 0)]
    assert tokenizer_alignment.align(docs([])).count() == 0


def test_the_query_equals_plain_python_on_the_given_tables(spark, both):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r.asDict() for r in queries.op13_tokenizer_alignment(spark, folder).collect()}
    texts = [tuple(r) for r in queries.read(spark, folder, "documents").select("doc_id", "text").collect()]
    assert len(got) == len(texts)
    for (doc_id, _), want in zip(texts, plain(both, [t for _, t in texts]), strict=True):
        mine = got[doc_id]
        assert tuple(mine[c] for c in COLUMNS[:-1]) == want[:-1]
        assert mine["groups_sha256"] == (hashlib.sha256(want[-1].encode()).hexdigest() if want[-1] else "")
        assert re.fullmatch("[0-9a-f]{64}|", mine["groups_sha256"])
