import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ordermill.llm import periodic_runs, queries
from ordermill.llm import text as X


def brute(words, exponent=4, min_words=6):
    """(start, length, period) of all runs, by every period."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i - start >= p:
                out.setdefault((start, i + p), p)
    found = ((a, b - a, p) for (a, b), p in out.items())
    return sorted(r for r in found if r[1] >= max(exponent * r[2], min_words))


def kinds(r, kind, n):
    if kind == 0:
        return [r.randrange(2) for _ in range(n)]
    if kind == 1:
        q = r.randint(1, max(1, n // 4))
        base = [r.randrange(3) for _ in range(q)]
        x = [base[i % q] for i in range(n)]
        for _ in range(r.randint(0, 3) if n else 0):
            x[r.randrange(n)] = r.randrange(3)
        return x
    if kind == 2:
        return [0] * n
    if kind == 3:
        return [i.bit_count() % 2 for i in range(n)]
    if kind == 4:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    x = []
    while len(x) < n:
        x += [r.randrange(3) for _ in range(r.randint(1, 5))] * r.randint(1, 9)
    return x[:n]


def hashes(x):
    return X.mix(np.array(x, np.uint64) + np.uint64(77))


def listed(runs):
    start, end, period = runs
    return list(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True))


@pytest.mark.parametrize("kind", range(6))
@pytest.mark.parametrize("at_once", [1, 3, 50, 1000])
def test_runs_equal_those_of_all_periods_however_the_words_arrive(kind, at_once):
    r = random.Random(kind * 10 + at_once)
    for _ in range(12):
        x = kinds(r, kind, r.randint(0, 110))
        for exponent, at_least, longest in ((2, 2, None), (4, 6, len(x) // 4)):
            catchers = periodic_runs.Catchers(longest)
            for i in range(0, len(x), at_once):
                catchers.append(hashes(x)[i : i + at_once])
            assert listed(catchers.runs(exponent, at_least)) == brute(x, exponent, at_least)


def test_thue_morse_words_have_no_long_runs_and_one_word_has_one():
    n = 1 << 15
    catchers = periodic_runs.Catchers()
    catchers.append(hashes([i.bit_count() % 2 for i in range(n)]))
    assert max(length / period for _, length, period in listed(catchers.runs())) == 2
    catchers = periodic_runs.Catchers()
    catchers.append(hashes([5] * n))
    assert listed(catchers.runs()) == [(0, n, 1)]


def test_appending_in_parts_is_the_same_for_long_texts():
    r = random.Random(3)
    x = kinds(r, 5, 30_000)
    first = np.array([0, 10_000, 10_000, 30_000])
    whole = listed(periodic_runs.runs_of(hashes(x), first, 4, 6))
    assert whole == listed(periodic_runs.runs_of(hashes(x), first, 4, 6, append=997))
    parts = brute(x[:10_000]), brute(x[10_000:])
    assert whole == sorted(parts[0] + [(a + 10_000, n, p) for a, n, p in parts[1]])


def test_find_takes_odd_rows(docs, spark):
    text = "a b  a b\na b a b c"
    rows = [(1, text, 1), (1, text, 2), (2, None, 3), (3, "", 4), (4, " \n\t", 5), (None, "x " * 7, 6), (5, "é é é é é é ø", 7)]
    df = docs(rows, "doc_id long, text string, runs int").repartition(3)
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["text"]) for r in periodic_runs.find(df).collect())
    assert got == [
        (0, 7, [(0, 7, 1)], "x"), (1, 9, [(0, 8, 2)], "a b c"), (1, 9, [(0, 8, 2)], "a b c"),
        (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 7, [(0, 6, 1)], "é ø"),
    ]
    assert periodic_runs.find(docs([])).count() == 0


def expected(doc_id, text):
    """The whole query for one document, in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    one = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(runs), *one, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(kept)


def test_the_query_equals_plain_python_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, folder).collect()}
    texts = queries.read(spark, folder, "documents").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    small = [r for r in texts if len(r["text"] or "") < 12_000]
    assert len(small) > 150
    for r in small:
        assert got[r["doc_id"]] == expected(*r), r["doc_id"]
