import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordermill.llm import bloom_lm, line_quality, queries, toxicity, url_filter
from ordermill.llm import text as X

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered) + [None]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 1


def lm_brute(rows, order, mass):
    """Scores with quantised counts held in plain dictionaries."""
    grams = Counter()
    for i, t in rows:
        if not held(i):
            w = tokens_of(t)
            for k in range(1, order + 1):
                grams.update(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
    n = sum(c for g, c in grams.items() if len(g) == 1)
    v = sum(len(g) == 1 for g in grams)

    def least(g):
        return 2 ** (grams[g].bit_length() - 1) if grams[g] else 0

    def most(g):
        return grams[g] if len(g) == 1 else 2 ** grams[g].bit_length() - 1

    out = {}
    for i, t in rows:
        w = tokens_of(t)
        base = sum(math.log10((grams[(x,)] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = 0.0
        for j in range(len(w)):
            p = (least((w[j],)) + 0.5) / (n + 0.5 * (v + 1))
            for k in range(2, min(order, j + 1) + 1):
                h = most(tuple(w[j - k + 1 : j]))
                p = (min(least(tuple(w[j - k + 1 : j + 1])), h) + mass * p) / (h + mass)
            score += math.log10(p)
        out[i] = (held(i), len(w), sum(grams[(x,)] > 0 for x in w), n, base, score)
    return out


def lm_rows(seed=1):
    r = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(60)] + ["É", "Straße", "UP"]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "\t "), (103, "a b " * 3000), (104, rows[0][1]), (105, "İ x")]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_equal_exact_dictionaries(docs, order, monkeypatch):
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 2000)
    rows = lm_rows()
    df = docs([(i, t, 1) for i, t in rows], "doc_id long, text string, block int").repartition(3)
    mine = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    got = bloom_lm.score(df, mine, order=order, bits_an_entry=64, tokens_a_segment=500).collect()
    want = lm_brute(rows, order, 4.0)
    assert len(got) == len(rows)
    for r in got:
        a = (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
        assert a == pytest.approx(want[r["doc_id"]], rel=1e-9), r["doc_id"]


@pytest.mark.parametrize("order", [2, 3])
def test_ranges_of_segments_give_the_same_scores(docs, order, monkeypatch):
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 1500)
    rows = lm_rows()
    df = docs(rows).repartition(4)
    mine = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    run = lambda: sorted(map(tuple, bloom_lm.score(df, mine, order=order, tokens_a_segment=700).collect()))
    direct = run()
    monkeypatch.setattr(bloom_lm, "FAN", 5)
    assert run() == direct


def test_messages_grow_with_the_corpus(docs, monkeypatch):
    """Rows sent at three sizes, with as many segments as each size asks for."""
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 400)
    monkeypatch.setattr(bloom_lm, "FAN", 6)
    sent = []
    for n in (80, 160, 320):
        r = random.Random(n)
        rows = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(60))) for i in range(n)]
        blocks = bloom_lm.blocks_of(docs(rows).coalesce(1), F.lit(False))
        segments = n // 10
        width = bloom_lm._width(segments)
        assert segments <= 36 and width > 1
        first = bloom_lm._grouped(bloom_lm._training(blocks, segments, 2), blocks)
        second = bloom_lm._to_segments(first, width, segments)
        count = blocks.count()
        assert first.count() <= 6 * count
        assert first.groupBy("segment", "asker").count().agg(F.max("count")).first()[0] <= 3 * 6
        sent.append((first.count() + second.count()) / count)
    # At most FAN a block to ranges and as many from there on, however many segments there are.
    assert max(sent) <= 12 and sent[2] < 2.2 * sent[0]


def levels_in(model, keys):
    """Levels of n-grams as the stored segments give them."""
    parts = {r["segment"]: r for r in model.segments.collect()}
    out = np.zeros(len(keys), np.int64)
    segment = bloom_lm.segment_of(keys, model.count)
    for k, r in parts.items():
        mine = segment == k
        out[mine] = bloom_lm.found_levels(bloom_lm.short_key(keys[mine]), r["size"], r["probes"], np.frombuffer(r["bits"], np.uint8))
    return out


def test_a_smaller_filter_errs_upwards_only(spark, docs):
    blocks = bloom_lm.blocks_of(docs(lm_rows()), F.lit(False))
    tight, loose = (
        bloom_lm.Model(bloom_lm.filter_segments(blocks, 8, 2, bits), 8, 2, 1000, 60) for bits in (2, 64)
    )
    keys = X.mix(np.arange(20_000, dtype=np.uint64))
    assert (levels_in(loose, keys) > 0).mean() < 0.001 < (levels_in(tight, keys) > 0).mean()
    b = bloom_lm.Block(blocks.limit(1).toArrow().to_pylist()[0])
    _, inside = b.ngrams(2)
    assert (levels_in(tight, inside) >= levels_in(loose, inside)).all() and (levels_in(loose, inside) > 0).all()


def test_the_stored_filter_has_training_texts_only_and_all_counts_come_from_it(spark, docs, monkeypatch):
    """An emptied filter leaves words alone to go by: scores come from the stored segments."""
    rows = [(1, "red fox runs"), (2, "blue owl flies"), (3, "red fox runs")]
    held_out = F.col("doc_id") == 2
    blocks = bloom_lm.blocks_of(docs(rows), held_out)
    model = bloom_lm.Model(bloom_lm.filter_segments(blocks, 8, 3, 64), 8, 3, 8, 4)
    for row in blocks.toArrow().to_pylist():
        b = bloom_lm.Block(row)
        for k in (1, 2, 3):
            last, keys = b.ngrams(k)
            is_held = b.held[b.owner[last]]
            found = levels_in(model, keys)
            assert (found[~is_held] > 0).all()
            # The end token is in training texts too.
            assert (found[is_held] == 0).sum() >= is_held.sum() - 1
    whole = {r["doc_id"]: r["score"] for r in bloom_lm.score(docs(rows), held_out).collect()}
    real = bloom_lm.filter_segments
    monkeypatch.setattr(bloom_lm, "filter_segments", lambda *a: real(*a).where("false"))
    bare = {r["doc_id"]: r["score"] for r in bloom_lm.score(docs(rows), held_out).collect()}
    assert bare[1] < whole[1] - 1 and bare[2] <= whole[2]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_of_all_words_after_a_context_add_up_to_at_most_one(order):
    """For every context of a small corpus, by the scoring code itself."""
    r = random.Random(4)
    words = [np.uint64(k) for k in range(1, 13)]
    texts = [[r.choice(words) for _ in range(r.randint(1, 40))] for _ in range(80)]
    grams = Counter()
    for t in texts:
        t = [*t, bloom_lm.END]
        for k in range(1, order + 1):
            grams.update(tuple(t[j : j + k]) for j in range(len(t) - k + 1))
    n, v = sum(c for g, c in grams.items() if len(g) == 1), 13

    def level(g):
        return grams[g].bit_length()

    sums = []
    for context in {g for g in grams if len(g) == order - 1 and bloom_lm.END not in g} if order > 1 else {()}:
        total = 0.0
        for w in [*words, bloom_lm.END]:
            text = [*context, w]
            p = (bloom_lm.least(np.array(level((w,)))) + 0.5) / (n + 0.5 * (v + 1))
            for k in range(2, order + 1):
                h = tuple(text[-k:-1])
                before = grams[h] if k == 2 else float(bloom_lm.most(np.array(level(h))))
                p = (min(float(bloom_lm.least(np.array(level(tuple(text[-k:]))))), before) + 4.0 * p) / (before + 4.0)
            total += p
        sums.append(total)
    assert max(sums) <= 1 + 1e-9 and np.mean(sums) > 0.6


def test_scoring_neither_caps_nor_broadcasts_the_filter(spark, docs, monkeypatch):
    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value))
    assert bloom_lm.score(docs(lm_rows()), F.lit(False), tokens_a_segment=100).count() == len(lm_rows())
    assert not sent
    for n in (10, 5_000):
        size, probes, _ = bloom_lm._filled(np.arange(n, dtype=np.uint64), np.full(n, 2), 10.0)
        assert size > 20 * n - 64 and probes in (6, 7)


def test_lm_without_training_texts_and_without_rows(docs):
    got = bloom_lm.score(docs([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got} == {
        (1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)
    }
    assert bloom_lm.score(docs([]), F.lit(False)).count() == 0


def test_planes_round_trip():
    v = np.array([0, 1, 255, 256, 2**31, 2**32 - 1], np.uint64)
    assert (bloom_lm.from_planes(bloom_lm.planes(v, 4), 4) == v).all()
    assert (bloom_lm.from_planes(bloom_lm.planes(v * 77, 8), 8) == v * 77).all()


# Toxicity


def test_features_are_the_ngrams_of_the_text_alone():
    texts = ["Abc  DEF", "", None, "abc\ndef", "x", "  ", "abc def ghi"]
    one = {}
    for k, t in enumerate(texts):
        for n, (owner, place) in zip(toxicity.ORDERS, toxicity.features([t])):
            one[k, n] = sorted(place.tolist())
    for n, (owner, place) in zip(toxicity.ORDERS, toxicity.features(texts)):
        for k in range(len(texts)):
            assert sorted(place[owner == k].tolist()) == one.get((k, n), [])
    assert one[0, 4] == one[3, 4] and not one.get((1, 4)) and not one.get((5, 4))


def toxic_rows(n=1200):
    r = random.Random(3)
    plain = ["".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(plain) for _ in range(r.randint(20, 300))]
        bad = r.random() < 0.15
        for _ in range(r.randint(2, 5) if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(["grumpfish", "blarghead", "snotwit"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxic_words_are_learnt_and_found_in_unseen_texts(spark, docs):
    rows, labels = toxic_rows()
    frame = spark.createDataFrame([(*x, 1) for x in labels if x[0] % 3], "doc_id long, toxic int, text int")
    model = toxicity.fit(docs(rows), frame.drop("text"))
    extra = [(9001, None), (9002, ""), (9003, "long words " * 20_000 + "snotwit blarghead grumpfish"), (9004, "long words " * 20_000)]
    got = {r["doc_id"]: r for r in toxicity.score(docs(rows + extra), model).collect()}
    unseen = [(i, y) for i, y in labels if i % 3 == 0]
    assert sum(got[i]["predicted"] == y for i, y in unseen) / len(unseen) > 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert got[9001]["score"] == got[9002]["score"] < 0.5
    assert got[9003]["predicted"] == 1 and got[9004]["predicted"] == 0


def test_the_fit_equals_a_plain_version(spark, docs):
    """Ratios from sets of n-grams of every text, and the steps of the regression text by text."""
    rows, labels = toxic_rows(150)
    model = toxicity.fit(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    sets = [{int(p) for _, place in toxicity.features([t]) for p in place} for _, t in rows]
    y = [label for _, label in labels]
    toxic, clean = Counter(), Counter()
    for s, label in zip(sets, y, strict=True):
        (toxic if label else clean).update(s)
    P, N, r = sum(y), len(y) - sum(y), {}
    for f in toxic.keys() | clean.keys():
        p, n = toxic[f], clean[f]
        ratio = math.log((p + 1) / (P + 1)) - math.log((n + 1) / (N + 1))
        if p + n >= 5 and abs(ratio) / math.sqrt(1 / (p + 1) + 1 / (n + 1)) >= 4:
            r[f] = ratio
    assert len(r) < 20_000 and set(np.flatnonzero(model.weights).tolist()) == set(r)
    w, b = dict.fromkeys(r, 0.0), math.log((P + 1) / (N + 1))
    m, v, mb, vb = dict.fromkeys(r, 0.0), dict.fromkeys(r, 0.0), 0.0, 0.0
    for k in range(1, 151):
        gw, gb = {f: 1e-3 * w[f] for f in r}, 0.0
        for s, label in zip(sets, y, strict=True):
            mine = s & r.keys()
            g = (1 / (1 + math.exp(-(b + sum(r[f] * w[f] for f in mine)))) - label) / len(y)
            gb += g
            for f in mine:
                gw[f] += r[f] * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        for f in r:
            m[f], v[f] = 0.9 * m[f] + 0.1 * gw[f], 0.99 * v[f] + 0.01 * gw[f] ** 2
            w[f] -= 0.02 * (m[f] / (1 - 0.9**k)) / (math.sqrt(v[f] / (1 - 0.99**k)) + 1e-10)
        b -= 0.05 * (mb / (1 - 0.9**k)) / (math.sqrt(vb / (1 - 0.99**k)) + 1e-10)
    assert model.intercept == pytest.approx(b, abs=1e-3)
    for f in r:
        assert model.weights[f] == pytest.approx(w[f] * r[f], abs=1e-3)
    got = {x["doc_id"]: x["score"] for x in toxicity.score(docs(rows), model).collect()}
    for (i, _), s in zip(rows, sets, strict=True):
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(b + sum(w[f] * r[f] for f in s & r.keys())))), abs=1e-3)


@pytest.mark.parametrize("labels, high", [([], None), ([(1, 0), (2, 0)], False), ([(1, 1), (2, 1), (3, None)], True)])
def test_labels_of_one_class(spark, docs, labels, high):
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs([(1, "a text"), (2, "b text")]), frame)
    s = toxicity.score(docs([(1, "a text")]), model).first()["score"]
    assert s == 0.5 if high is None else (s > 0.5) == high


def test_ranges_of_url_segments_give_the_same_verdicts(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(url_filter, "KEYS_A_SEGMENT", 4_000)
    r = random.Random(8)
    urls = ["http://%s/%s/%d" % (r.choice(["a.com", "b.net", "c.org"]), r.choice(["es", "fr", "news"]), r.randrange(10**6)) for _ in range(800)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    run = lambda: {x["page_id"]: (x["verdict"], x["ratio"]) for x in url_filter.judge(pages).collect()}
    direct = run()
    monkeypatch.setattr(url_filter, "FAN", 6)
    blocks = url_filter.blocks_of(pages.selectExpr("page_id", "url", "'r' AS rule", "page_id % 2 = 0 AS allow"))
    segments, _ = url_filter._size(blocks)
    assert segments > 12 and url_filter._width(segments) > 1
    ranged = run()
    assert {k: v[0] for k, v in ranged.items()} == {k: v[0] for k, v in direct.items()}
    assert all(ranged[k][1] == pytest.approx(direct[k][1], rel=1e-12) for k in direct)


def test_the_url_threshold_has_the_least_error_of_all(spark):
    """Against every threshold, with ratios far from zero."""
    r = random.Random(2)
    rows = [(r.gauss(40, 3), True, True) for _ in range(300)] + [(r.gauss(33, 3), False, True) for _ in range(100)]
    df = spark.createDataFrame([*rows, (1e6, True, False)], "ratio double, allow boolean, calibrates boolean")

    def error(threshold):
        lost = sum(x < threshold for x, allow, _ in rows if allow) / 300
        return lost + sum(x >= threshold for x, allow, _ in rows if not allow) / 100

    best = min(error(x) for x, _, _ in rows)
    assert error(url_filter.calibrated(df)) <= best + 0.011
    assert url_filter.calibrated(df.where("false")) == 0.0


def test_held_out_is_never_null(spark, tmp_path):
    spark.createDataFrame([(None, "x"), (1, None), (2, "a b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op3_toxicity(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in (None, 1, 2)}


def test_the_fit_is_bounded(spark, docs):
    rows, labels = toxic_rows(100)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.training_rows(docs(rows), frame, 30).count() == 30


# Lines


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def line_texts():
    r = random.Random(8)
    out = [None, "", " \n \t\n", "one line", "a\na\n a\na", "é漢 😀 #*%", "w " * 9000, "a b c d e f g h " * 2 + "x"]
    for _ in range(300):
        out.append("".join(r.choice(["a ", "b ", "c", "\n", "# ", "é ", "\t", "d e f g h i j k "]) for _ in range(r.randint(1, 60))))
    return out


def test_base_counts_equal_plain_python(docs):
    texts = line_texts()
    got = {r["doc_id"]: r for r in line_quality.judge(docs(list(enumerate(texts))), None).collect()}
    for i, t in enumerate(texts):
        r, want = got[i], base_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed)


def test_viterbi_equals_trying_all_labellings():
    r = np.random.default_rng(4)
    crf = line_quality.Crf(r.normal(size=3), r.normal(size=(2, 2)))
    counts = [0, 1, 5, 3, 8, 0, 2]
    first = np.concatenate([[0], np.cumsum(counts)])
    features = r.normal(size=(first[-1], 3))
    got = crf.decode(features, first)
    for a, b in zip(first[:-1], first[1:]):
        unary = features[a:b] @ crf.weights
        best, labels = -1e9, []
        for code in range(1 << (b - a)):
            y = [(code >> k) & 1 for k in range(b - a)]
            s = sum(u for u, v in zip(unary, y) if v) + sum(crf.pairs[p, q] for p, q in zip(y, y[1:]))
            if s > best:
                best, labels = s, y
        assert got[a:b].tolist() == labels


def test_bad_lines_are_learnt(spark, docs):
    r = random.Random(6)

    def good():
        return "\n".join(" ".join(r.choice("stone river walked quietly along green meadow under morning light".split()) for _ in range(12)).capitalize() + f" {r.random()}." for _ in range(5))

    def bad():
        return "\n".join(" | ".join("MENU%d ###" % r.randint(0, 999) for _ in range(8)) for _ in range(5))

    rows = [(i, bad() if i % 4 == 0 else good()) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)] + [(1, None)], "doc_id long, quality int")
    crf = line_quality.fit(docs(rows), labels)
    mixed = [(900, good() + "\n" + bad().split("\n")[0]), (901, None), (902, bad() + "\n" + good().split("\n")[0])]
    got = {x["doc_id"]: x for x in line_quality.judge(docs(rows + mixed), crf).collect()}
    assert all(got[i]["kept"] == (i % 4 > 0) for i in range(200, 300))
    assert got[900]["kept"] and got[900]["labels"] == "cccccb" and not got[901]["kept"] and not got[902]["kept"]
    assert line_quality.fit(docs(rows), labels.where("quality = 1")) is None
    assert line_quality.judge(docs([]), crf).count() == 0
    kept = line_quality.keep(docs([(*x, "y") for x in rows + mixed], "doc_id long, text string, quality string"), crf)
    assert kept.columns == ["doc_id", "text", "quality"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


def test_marginals_equal_those_of_all_labellings():
    r = np.random.default_rng(9)
    counts = np.array([6, 4, 4, 1])
    chains = line_quality.Chains(counts)
    unary, pairs = r.normal(size=counts.sum()), r.normal(size=(2, 2))
    p, both = chains.marginals(unary, pairs)
    want, want_both = np.zeros(counts.sum()), np.zeros(4)
    for a, z in zip(chains.first[:-1], chains.first[1:], strict=True):
        weights = []
        for labels in itertools.product((0, 1), repeat=z - a):
            score = sum(u for u, y in zip(unary[a:z], labels, strict=True) if y)
            weights.append((labels, math.exp(score + sum(pairs[x, y] for x, y in itertools.pairwise(labels)))))
        total = sum(w for _, w in weights)
        for labels, w in weights:
            want[a:z] += np.array(labels) * w / total
            for x, y in itertools.pairwise(labels):
                want_both[2 * x + y] += w / total
    assert np.allclose(p, want) and np.allclose(both, want_both)


def test_every_line_of_a_document_may_be_learnt_from_up_to_a_bound():
    assert line_quality.stretches(0) == [] and line_quality.stretches(3) == [(0, 3)]
    whole = line_quality.stretches(250)
    assert whole[0] == (0, 64) and whole[-1][1] == 250 and len(whole) == 4
    spread = line_quality.stretches(100_000)
    assert len(spread) == 4 and spread[0][0] == 0 and spread[-1] == (99_936, 100_000)


def test_lines_of_given_documents_get_both_labels_and_held_out_documents_their_verdict(spark):
    """Labels are given for documents; inside bad ones some lines are found to be content."""
    folder = "/root/testdata/sf0.1"
    documents, labels = queries.read(spark, folder, "documents"), queries.read(spark, folder, "labels")
    crf = line_quality.fit(documents, labels.where("crc32(cast(doc_id AS string)) % 5 <> 0"))
    held = labels.where("crc32(cast(doc_id AS string)) % 5 = 0").select("doc_id", "quality")
    rows = line_quality.judge(documents.join(held.select("doc_id"), "doc_id"), crf).join(held, "doc_id").collect()
    good, bad = [r for r in rows if r["quality"]], [r for r in rows if not r["quality"]]
    assert len(good) > 500 and len(bad) > 90
    assert np.mean([r["content_share"] >= 0.5 for r in good]) > 0.99
    assert np.mean([r["kept"] for r in bad]) < 0.05
    several = [r for r in bad if len(r["labels"]) > 1]
    assert np.mean([len(set(r["labels"])) == 2 for r in several]) > 0.2
    assert any(0.05 < r["content_share"] < 0.95 for r in rows)


# URLs


def url_model(ruled):
    """The whole model of a small table of (url, allow), put together here; None without both kinds."""
    rows = ruled.select(F.lit(None).cast("long").alias("page_id"), "url", F.lit(None).cast("string").alias("rule"), "allow")
    blocks = url_filter.blocks_of(rows)
    segments, learnt = url_filter._size(blocks)
    if not learnt:
        return None
    parts = [url_filter._part(r.asDict(True), segments, url_filter._width(segments))[1:] for r in url_filter._with_answers(blocks, segments).collect()]
    keys, first = np.unique(np.concatenate([k for k, _ in parts]), return_index=True)
    counts = np.concatenate([c for _, c in parts], axis=1)[:, first]
    return url_filter.Model.of(keys, counts, url_filter.calibrated(url_filter.scored(blocks, segments, True)))


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "no scheme", "https://EXAMPLE.com/en/x", "http://www.example.com/en/1?q=http://net/es/", "http://a.b.example.com/en",
    "ftp://example.net/es/#x", "http://example.net/fr", "http://x.net/fr/", "http://com", "http://com/", "http://xcom/", "http://a.com?x/",
    "http://a.COM/É", "://net/es/1", "http://ÀB.com/", "http://example.org/en/1", "http://www.example.com/en/", "http://mywww.example.com/en/",
]


def test_rules_and_parts_equal_plain_python(spark):
    rows = list(enumerate(URLS * 30))
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string").repartition(3)
    got = {r["page_id"]: r for r in url_filter.judge(df).collect()}
    for i, url in rows:
        host, path = parts(url)
        rule = rule_of(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule and rule.text)
        if rule:
            assert got[i]["verdict"] == ("allow" if rule.allow else "block")


def test_the_model_is_a_smoothed_distribution_and_tells_kinds_apart(spark):
    r = random.Random(1)
    rows = [("http://good.com/story-%d" % r.randint(0, 999), True) for _ in range(300)]
    rows += [("http://casino.net/es/win-%d" % r.randint(0, 999), False) for _ in range(300)] + [("", True), (None, False)]
    model = url_model(spark.createDataFrame(rows, "url string, allow boolean"))
    seen = model.ratio(X.texts_of(pa.array(["http://good.com/story-77777", "http://casino.org/es/win-55555", ""])))
    assert seen[0] > model.threshold > seen[1]
    for before in ("", "http://g", "zzz"):
        # Every byte after it, and the end of the text.
        alike = [before.encode() + bytes([c]) for c in range(1, 256)] + [before.encode()]
        assert sum(math.exp(x) for x in _next(model, before, alike)) == pytest.approx(1, abs=1e-9)


def test_url_counts_are_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(url_filter, "KEYS_A_SEGMENT", 20_000)
    r = random.Random(2)
    rows = [("http://%s/%d" % (r.choice(["a.com", "b.net"]), r.randint(0, 10**12)), bool(i % 2)) for i in range(20_000)]
    want = Counter()
    for url, allow in rows:
        if zlib.crc32(url.encode()) % 5:
            text = b"\0" * url_filter.ORDER + url.encode() + b"\0"
            want.update((allow, text[j - 5 : j], text[j]) for j in range(5, len(text)))
    model = url_model(spark.createDataFrame(rows, "url string, allow boolean").repartition(3))
    sums, kinds = Counter(), Counter()
    for (allow, context, _), n in want.items():
        sums[allow, context] += n
        kinds[allow, context] += 1
    probe = [u for u, _ in rows[:200]]
    at = url_filter.trace(X.texts_of(pa.array(probe)))
    slot, pair = at.slots(5)
    texts = [b"\0" * 5 + u.encode() + b"\0" for u in probe]
    places = [(t[j - 5 : j], t[j]) for t in texts for j in range(5, len(t))]
    for c in (0, 1):
        assert model.pairs[c, 5, pair].tolist() == [want[bool(c), x, y] for x, y in places]
        assert model.contexts[c, 5, slot].tolist() == [sums[bool(c), x] for x, _ in places]
        assert model.kinds[c, 5, slot].tolist() == [kinds[bool(c), x] for x, _ in places]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(probe)] + [(999, None)], "page_id long, url string")
    assert url_filter.judge(pages).count() == 201


def _next(model, before, texts):
    """Log-probability of the byte after ``before``, for each text."""
    out = []
    for t in texts:
        at = url_filter.trace(X.Texts(np.frombuffer(t, np.uint8), np.array([0, len(t)])))
        p = np.full(len(at.owner), 1 / 256)
        for k in range(url_filter.ORDER + 1):
            slot, pair = at.slots(k)
            n, kinds = model.contexts[1, k, slot], model.kinds[1, k, slot]
            p = np.where(n > 0, (model.pairs[1, k, pair] + kinds * p) / np.where(n > 0, n + kinds, 1), p)
        out.append(math.log(p[len(before)]))
    return out


def test_urls_without_rules_to_learn_from_are_allowed(spark):
    df = spark.createDataFrame([(1, "http://example.org/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge(df).collect()} == {"allow"}
    assert url_filter.judge(df.where("false")).count() == 0
