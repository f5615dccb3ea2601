import random
import re

import numpy as np
import pytest

from ordermill.llm import bbit_minhash, queries
from ordermill.llm import text as X

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size=4):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(rows):
    """(n_shingles, component_id, kept) of every document, from all pairs that share a shingle."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    at = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(k)
    for k, (_, s) in enumerate(sets):
        shared = {}
        for x in s:
            for j in at[x]:
                if j < k:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                parent[root(j)] = root(k)
    low = {}
    for k, (i, _) in enumerate(sets):
        low[root(k)] = min(low.get(root(k), i), i)
    return {i: (len(s), low[root(k)], i == low[root(k)]) for k, (i, s) in enumerate(sets)}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def word(r):
    return "".join(r.choice("abcdefghIJ") for _ in range(r.randint(2, 6)))


def corpus(seed):
    r = random.Random(seed)
    out = []
    for _ in range(25):
        base = [word(r) for _ in range(r.randint(20, 150))]
        for _ in range(r.randint(1, 8)):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 4])):
                words[r.randrange(len(words))] = word(r)
            out.append(r.choice([" ", "\n", "\t "]).join(words))
    out += [t.upper() for t in out[:5]]
    # A chain in which only neighbours are linked, and texts around a centre that no two of them are linked by.
    chain = [word(r) for _ in range(60)]
    for k in range(12):
        out.append(" ".join(chain[2 * k : 2 * k + 30]))
    centre = [word(r) for _ in range(100)]
    out.append(" ".join(centre))
    for k in range(40):
        words = list(centre)
        for at in r.sample(range(100), 2):
            words[at] = word(r)
        out.append(" ".join(words))
    template = [word(r) for _ in range(60)]
    out += [" ".join(template + [word(r) for _ in range(60)]) for _ in range(60)]
    out += ["", None, " \n\t", "one", "ONE", "one two three four", "one two three four five", "x " * 4000, "x " * 5000, "é É"]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_those_of_all_pairs(docs, seed):
    rows = corpus(seed)
    df = docs([(i, t, 3, "r") for i, t in rows], "doc_id long, text string, id int, root string").repartition(5)
    assert found(bbit_minhash.near_duplicates(df)) == brute(rows)


def test_small_blocks_give_the_same(docs, monkeypatch):
    """Bands and groups dealt over many blocks, one head a group."""
    for name, value in (("BAND_BLOCK", 4), ("BLOCK_SETS", 5), ("BLOCK_SHINGLES", 2_000), ("HEADS", 1)):
        monkeypatch.setattr(bbit_minhash, name, value)
    rows = corpus(7)
    assert found(bbit_minhash.near_duplicates(docs(rows).repartition(5))) == brute(rows)


def test_templates_that_are_not_alike_make_no_group(docs):
    r = random.Random(5)
    template = [word(r) for _ in range(100)]
    rows = [(i, " ".join(template + [word(r) for _ in range(100)])) for i in range(300)]
    prints = bbit_minhash.fingerprints(docs(rows))
    sets = prints.where("id IS NOT NULL").withColumn("low", prints["doc_id"])
    assert bbit_minhash.groups_of(sets, bbit_minhash.agreement_needed()).count() == 0


def test_the_estimate_is_corrected_for_chance(spark):
    r = np.random.default_rng(1)
    errors = []
    for share in (0.0, 0.3, 0.8, 1.0):
        total = 2_000
        both = round(share * total)
        pool = r.integers(0, 1 << 62, 2 * total, dtype=np.uint64)
        own = (total - both) // 2
        a, b = pool[: both + own], np.concatenate([pool[:both], pool[both + own : both + 2 * own]])
        grams, first = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        one, two = bbit_minhash.packed(bbit_minhash.minima(grams, first)).tolist()
        df = spark.createDataFrame([(one, two)], "a array<long>, b array<long>")
        agreed = bbit_minhash.agreement(df["a"], df["b"])
        got, n = df.select(bbit_minhash.estimate(agreed), agreed).first()
        codes = (bbit_minhash.minima(grams, first) & np.uint64(3)).astype(int)
        assert n == (codes[0] == codes[1]).sum()
        errors.append(abs(got - share))
    assert errors[3] == 0 and max(errors) < 0.2


def test_odd_rows(docs):
    rows = [(3, "a b c d e"), (3, "a b c d e"), (None, "A b c d e"), (None, "q r s"), (None, None), (5, None), (5, "z")]
    got = sorted((tuple(r) for r in bbit_minhash.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted(
        [(3, 2, 3, True), (3, 2, 3, True), (None, 2, 3, False), (None, 1, None, True), (None, 0, None, True), (5, 0, 5, True), (5, 1, 5, True)],
        key=str,
    )
    assert bbit_minhash.near_duplicates(docs([])).count() == 0


def test_the_query_equals_all_pairs_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    texts = [tuple(r) for r in queries.read(spark, folder, "documents").select("doc_id", "text").collect()]
    assert found(queries.op12_minhash_near_dedup(spark, folder)) == brute(texts)


def test_agreement_needed_is_far_below_what_the_threshold_makes_expect():
    assert bbit_minhash.agreement_needed(80) == 115
    assert X.lower_ascii(X.texts_of(__import__("pyarrow").array(["ÀBc"]))).data.tobytes().decode() == "Àbc"
