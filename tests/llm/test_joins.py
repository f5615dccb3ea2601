import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from ordermill.llm import components, decontaminate, jaccard_join, queries, site_lines, store
from ordermill.llm import text as X


def shingle_set(text, size=5):
    words = (text or "").split()
    if not words:
        return None
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, threshold=0.8):
    """class, copies and links of every document, from all pairs of texts."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links, copies = Counter(), Counter()
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and len(x & y) >= threshold * len(x | y):
                links[a] += 1
                links[b] += 1
                copies[a] += x == y
                copies[b] += x == y
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    low = {}
    for k, (i, _) in enumerate(sets):
        low[root(k)] = min(low.get(root(k), i), i)
    return {sets[k][0]: (low[root(k)], copies[k] + 1, links[k]) for k in range(len(sets))}


def word(r):
    return "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))


def changed(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = word(r)
    return words


def corpus(seed, groups=25):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [word(r) for _ in range(r.randint(30, 150))]
        for _ in range(r.randint(1, 7)):
            out.append(" ".join(changed(r, base, r.choice([0, 0, 1, 2, 3]))))
    passage = " ".join(word(r) for _ in range(40))
    out += [passage + " " + " ".join(word(r) for _ in range(r.randint(20, 120))) for _ in range(40)]
    out += ["", None, " \n\t", "one", "one", "one two three four", "one two three four five", "x " * 4000, "x " * 5000]
    r.shuffle(out)
    return list(enumerate(out))


def found(df):
    return {r["doc_id"]: (r["class_id"], r["n_copies"], r["n_links"]) for r in df.collect()}


def templates(seed, n, shared=100, own=100):
    r = random.Random(seed)
    template = [word(r) for _ in range(shared)]
    return [" ".join(template + [word(r) for _ in range(own)]) for _ in range(n)]


def test_templates_make_no_group(docs):
    """Texts that share half their words are far from the threshold: nothing is grouped or compared exactly."""
    df = docs(list(enumerate(templates(11, 900))))
    prints = jaccard_join.fingerprints(df)
    edges = jaccard_join.candidates(prints.where("id IS NOT NULL").select("id", "sketch", "nodes"))
    assert edges.count() == 0


def test_copies_inside_templates_are_found(docs):
    """Near copies that share their buckets with many texts of one template, and chains that leave a leader."""
    r = random.Random(12)
    texts = templates(12, 700, shared=120, own=60)
    near = [" ".join(changed(r, t.split(), r.choice([1, 2]))) for t in texts[:60] for _ in range(2)]
    base = [word(r) for _ in range(150)]
    chain = [" ".join(changed(r, base, r.choice([1, 2, 3]))) for _ in range(700)]
    texts += near + chain
    r.shuffle(texts)
    rows = list(enumerate(texts))
    sets = [shingle_set(t) for t in texts]
    at = {}
    for k, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(k)
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    links = Counter()
    for k, s in enumerate(sets):
        shared = Counter(j for x in s for j in at[x] if j < k)
        for j, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                links[k] += 1
                links[j] += 1
                a, b = sorted((root(k), root(j)))
                parent[b] = a
    low = {}
    for k in range(len(sets)):
        low.setdefault(root(k), k)
    got = found(jaccard_join.join(docs(rows).repartition(4)))
    assert {i: g[0] for i, g in got.items()} == {k: low[root(k)] for k in range(len(sets))}
    assert all(got[k][2] == links[k] for k in range(len(sets)) if texts.count(texts[k]) == 1 and k in got)


def test_all_links_of_the_given_tables_are_found(spark):
    """Recall 1 against all pairs that share an n-gram."""
    df = queries.read(spark, "/root/testdata/sf0.01", "documents")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    sets, at, links = [shingle_set(t) or frozenset() for _, t in rows], {}, Counter()
    for k, s in enumerate(sets):
        shared = Counter(j for x in s for j in at.get(x, ()))
        for j, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                links[rows[k][0]] += 1
                links[rows[j][0]] += 1
        for x in s:
            at.setdefault(x, []).append(k)
    got = found(jaccard_join.join(df))
    assert {i: g[2] for i, g in got.items()} == {i: links[i] for i, _ in rows} and sum(links.values()) > 100


def test_rows_of_one_id_stay_or_go_together(docs):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(3, long, "g"), (5, "another text of its own that is kept", "g"), (5, long, "g"), (None, long, "g"), (None, None, "g")]
    got = jaccard_join.keep_one(docs(rows, "doc_id long, text string, _gone string"))
    assert got.columns == ["doc_id", "text", "_gone"]
    assert sorted((r["doc_id"] or 0 for r in got.collect())) == [0, 0, 3, 5, 5]


@pytest.mark.parametrize("seed", range(2))
def test_links_equal_those_of_all_pairs(docs, seed):
    rows = corpus(seed)
    df = docs([(i, t, 3) for i, t in rows], "doc_id long, text string, id int").repartition(5)
    assert found(jaccard_join.join(df)) == brute(rows)


def test_large_buckets_and_blocks_lose_no_link(docs):
    """A large group of near copies, forced through leaders, splits and pairs of blocks."""
    r = random.Random(9)
    base = [word(r) for _ in range(90)]
    rows = list(enumerate([" ".join(changed(r, base, r.choice([1, 1, 2]))) for _ in range(150)]))
    rows += [(1000 + i, t) for i, t in corpus(4, 5)]
    got = found(jaccard_join.join(docs(rows), small=8, block_sets=20))
    want = brute(rows)
    assert got == want and max(n for _, _, n in want.values()) > 50


def test_repeated_and_null_ids(docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "g h i j k l"), (None, "a b c d e f"), (2, "")]
    got = sorted((r["doc_id"] or 0, r["class_id"], r["n_copies"], r["n_links"]) for r in jaccard_join.join(docs(rows)).collect())
    assert got == [(0, 1, 3, 2), (1, 1, 1, 0), (1, 1, 3, 2), (1, 1, 3, 2), (2, 2, 1, 0)]
    assert jaccard_join.join(docs([])).count() == 0


def test_one_of_each_class_stays(docs):
    rows = corpus(1, 10)
    kept = jaccard_join.keep_one(docs(rows))
    assert kept.columns == ["doc_id", "text"]
    want = {i for i, (low, _, _) in brute(rows).items() if i == low}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_sketches_agree_as_often_as_sets_are_similar():
    r = random.Random(2)
    base = [word(r) for _ in range(2000)]
    pairs = [" ".join(base), " ".join(changed(r, base, 40))]
    grams, first = jaccard_join.shingles(X.texts_of(pa.array(pairs)), 5)
    a, b = jaccard_join.sketches(grams, first)
    x, y = map(shingle_set, pairs)
    assert abs((a == b).mean() - len(x & y) / len(x | y)) < 0.12
    assert np.diff(first).tolist() == [len(x), len(y)]


def test_runs_follow_the_target():
    assert jaccard_join.runs_for(0.9) < jaccard_join.runs_for(0.999)
    assert jaccard_join.runs_for(0.999) == 15


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (9, 8)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)]])
def test_components(spark, edges):
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    label = {}
    for u, v in edges:
        if u != v:
            label.setdefault(u, u)
            label.setdefault(v, v)
    for _ in edges:
        for u, v in edges:
            if u != v:
                label[u] = label[v] = min(label[u], label[v])
    assert {r["id"]: r["root"] for r in got} == label and len(got) == len(label)


# Decontamination


def naive_tiles(item, doc, least):
    """Greedy tiles by comparing all places, longest first, first in the item."""
    a, b, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        for k in range(n):
            a[i + k] = b[j + k] = True
        out.append((i, j, n))


@pytest.mark.parametrize("seed", range(40))
def test_tiles_cover_what_the_naive_search_covers(seed):
    r = random.Random(seed)
    item = [r.randint(1, 9 if seed % 2 else 60) for _ in range(r.randint(1, 60))]
    doc = [r.randint(1, 60) for _ in range(30)]
    for _ in range(3):
        i = r.randrange(len(item))
        doc += item[i : i + r.randint(1, 30)] + [r.randint(1, 60)]
    got, want = decontaminate.greedy_tiles(item, doc, 5), naive_tiles(item, doc, 5)
    assert sorted((n for _, _, n in got), reverse=True) == [n for _, _, n in want]
    assert all(item[i : i + n] == doc[j : j + n] for i, j, n in got)
    for side in (0, 1):
        taken = [k for t in got for k in range(t[side], t[side] + t[2])]
        assert len(taken) == len(set(taken))


ITEM = "the quick brown fox jumps over lazy dogs while seven wise owls watch from their old oak tree at night"


def test_passages_are_found_whole_reordered_and_in_other_case(docs, spark):
    w = ITEM.split()
    texts = {
        1: f"filler one two {ITEM} and more", 2: " ".join(w[10:] + ["zzz"] + w[:10]).upper(),
        3: " ".join(w[:6]) + " something else", 4: None, 5: "", 6: "nothing in common at all here", 7: ITEM, 8: ITEM,
    }
    bench = spark.createDataFrame([(1, ITEM, 0), (2, ITEM, 0), (3, None, 0), (4, "", 0), (5, "Owls Fly", 0)], "item_id long, text string, doc_id int")
    got = decontaminate.matches(docs(list(texts.items())), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(d, i) for d in (1, 2, 7, 8) for i in (1, 2)]
    for r in got:
        words = texts[r["doc_id"]].lower().split()
        assert sum(t["words"] for t in r["tiles"]) == r["covered"]
        for t in r["tiles"]:
            assert words[t["doc_at"] : t["doc_at"] + t["words"]] == w[t["item_at"] : t["item_at"] + t["words"]]
    assert {r["doc_id"]: r["coverage"] for r in got}[1] == 1.0
    clean = decontaminate.clean(docs(list(texts.items())), bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == [3, 4, 5, 6]


def test_short_items_need_their_whole_text(docs, spark):
    bench = spark.createDataFrame([(1, "owls fly")], "item_id long, text string")
    got = decontaminate.matches(docs([(1, "where owls fly high"), (2, "fly owls")]), bench).collect()
    assert [(r["doc_id"], r["coverage"]) for r in got] == [(1, 1.0)]


def test_short_items_are_reported_but_remove_only_their_equals(docs, spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "yes"), (3, "not at all")], "item_id long, text string")
    texts = {1: "we said yes and went on", 2: " Yes\n", 3: "not at all", 4: "this is not at all yes", 5: "yes " + ITEM, 6: None, 7: ""}
    df = docs(list(texts.items()))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(df, bench).collect()}
    assert found == {(1, 2), (2, 2), (3, 3), (4, 2), (4, 3), (5, 1), (5, 2)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(df, bench).collect()) == [1, 4, 6, 7]


def test_runs_of_one_word_are_cut_without_a_change():
    r = random.Random(8)
    for _ in range(300):
        item = [r.choice("abw") for _ in range(r.randint(5, 14))]
        doc = []
        while len(doc) < 60:
            doc += ["w"] * r.randint(0, 50) + [r.choice("abxw") for _ in range(r.randint(1, 8))]
        numbers = {"a": 1, "b": 2, "w": 3, "x": 4}
        a, b = [numbers[c] for c in item], [numbers[c] for c in doc]
        short, where = decontaminate.shortened(b, list(range(len(b))), Counter(a))
        assert len(short) <= len(b) and [b[k] for k in where] == short
        covered = sum(n for _, _, n in decontaminate.greedy_tiles(a, b, 5))
        tiles = decontaminate.greedy_tiles(a, short, 5)
        assert sum(n for _, _, n in tiles) == covered
        for i, j, n in tiles:
            assert a[i : i + n] == b[where[j] : where[j] + n]


def test_a_page_of_one_word_ends_soon(docs, spark):
    bench = spark.createDataFrame([(1, "la " * 400), (2, "la la la la la la la land")], "item_id long, text string")
    df = docs([(1, "la " * 100_000), (2, "oh la la")])
    got = {(r["doc_id"], r["item_id"]): r["covered"] for r in decontaminate.matches(df, bench).collect()}
    assert got == {(1, 1): 400, (1, 2): 7}


def test_seeds_that_many_items_share(docs, spark):
    """Every item has the same beginning; documents hold one whole item each."""
    items = [(k, f"question number of the common test set {' '.join(f'q{k}w{j}' for j in range(12))}") for k in range(120)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [(k, f"before {items[k][1]} after", "t", 0) for k in range(0, 120, 3)]
    df = docs(texts, "doc_id long, text string, seed string, _covered int").repartition(3)
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.matches(df, bench).collect())
    assert got == [(k, k) for k in range(0, 120, 3)]
    left = decontaminate.clean(df.unionByName(docs([(999, "clean", "t", 1)], df.schema)), bench)
    assert left.columns == df.columns and [tuple(r) for r in left.collect()] == [(999, "clean", "t", 1)]


def test_no_benchmark_and_no_documents(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(docs([(1, "a")]), none).count() == 0
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.matches(docs([]), bench).count() == 0


# Site lines


def test_lines_on_many_pages_of_a_host_go(docs):
    rows = [(i, f"line {i} here stands\n menu \nalso {i} is text of the page\n\n", "a") for i in range(20)]
    rows += [(100 + i, f"words of page {i}\nmenu", "b") for i in range(30)]
    rows += [(200, "menu", "a"), (201, None, "a"), (202, "", "a"), (203, "x\nmenu y", None)]
    rows += [(300 + i, "same\ntext", "c") for i in range(40)]
    rows += [(400 + i, f"menu\nown words {i}", "small") for i in range(19)]
    df = docs([(*r, 1) for r in rows], "doc_id long, text string, source string, line int").repartition(4)
    out = site_lines.drop_boilerplate(df, ratio=0.5, dropped="n")
    got = {r["doc_id"]: (r["text"], r["n"]) for r in out.collect()}
    assert out.columns == ["doc_id", "text", "source", "line", "n"] and len(got) == len(rows)
    assert got[3] == ("line 3 here stands\nalso 3 is text of the page\n\n", 1)
    assert got[105] == ("words of page 5", 1)
    # A page that is that line alone is left empty; copies are pages like others; nulls and empty texts stay.
    assert got[200] == ("", 1) and got[300] == ("", 2)
    assert got[201] == (None, 0) and got[202] == ("", 0) and got[203] == ("x\nmenu y", 0)
    # A host of fewer than 20 pages is not judged.
    assert got[405] == ("menu\nown words 5", 0)


def test_short_pages_lose_their_boilerplate(docs):
    rows = [(i, f"Home | News | Contact | Imprint\nown {i}\n(c) all rights reserved by the site", "a") for i in range(100)]
    got = {r["doc_id"]: (r["text"], r["n"]) for r in site_lines.drop_boilerplate(docs(rows, "doc_id long, text string, source string"), dropped="n").collect()}
    assert got == {i: (f"own {i}", 2) for i in range(100)}


def test_copies_are_pages(docs):
    """A line on 1,000 of 1,400 pages is boilerplate although the 1,000 are equal."""
    rows = [(i, "a line\nthat repeats", "a") for i in range(1000)] + [(2000 + i, f"page {i}\nits own {i}", "a") for i in range(399)]
    rows.append((3000, "a line\nof this page", "a"))
    got = {r["doc_id"]: r["text"] for r in site_lines.drop_boilerplate(docs(rows, "doc_id long, text string, source string")).collect()}
    assert got[3000] == "of this page" and got[5] == "" and got[2001] == "page 1\nits own 1"


def test_lists_too_large_to_broadcast_give_the_same(docs, monkeypatch, plan):
    rows = [(i, f"menu\nown {i}\n\n menu ", "a" if i % 3 else None) for i in range(200)]
    df = docs(rows, "doc_id long, text string, source string").repartition(4)
    small = site_lines.drop_boilerplate(df, dropped="n")
    monkeypatch.setattr(site_lines, "BROADCAST_LINES", 0)
    large = site_lines.drop_boilerplate(df, dropped="n")
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)
    assert {r["n"] for r in large.collect()} == {2}
    assert "Exchange hashpartitioning" not in plan(small) and "BroadcastHashJoin" in plan(small)


def test_columns_of_any_name(docs):
    rows = [(i, "menu\nown", "a", "x", i, "h", "k") for i in range(30)]
    df = docs(rows, "doc_id long, text string, source string, _lines string, n_dropped int, _host string, `a.b` string")
    out = site_lines.drop_boilerplate(df, dropped="n_dropped")
    assert out.columns == df.columns
    assert [tuple(r) for r in out.where("doc_id = 7").collect()] == [(7, "", "a", "x", 2, "h", "k")]


def test_site_lines_of_nothing(docs):
    assert site_lines.drop_boilerplate(docs([], "doc_id long, text string, source string")).count() == 0


def test_pairs_of_all_levels_are_compared_at_once(docs, monkeypatch):
    """However many levels the splits go through, each comparison is one step, with the links of all pairs."""
    rows, real, small, steps = corpus(21, groups=15), jaccard_join.held, jaccard_join.compare_small, []
    monkeypatch.setattr(jaccard_join, "held", lambda df, label: steps.append(label) or real(df, label))
    monkeypatch.setattr(jaccard_join, "compare_small", lambda *a: steps.append("small") or small(*a))
    assert found(jaccard_join.join(docs(rows), small=8)) == brute(rows)
    assert steps.count("level") > 1
    assert steps.count("near-leaders") == steps.count("small") == 1 and steps.count("near") <= 1


def test_shuffle_files_go_with_the_step_that_wrote_them(spark):
    """What one step has shuffled does not lie on disk during the next."""
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())
    files = lambda: {p for d in folders for p in Path(str(d)).rglob("shuffle_*.data")}
    before, setting = files(), spark.conf.get(store.CLEANUP)
    got = store.held(spark.range(1000).selectExpr("id % 10 AS k").repartition(4, "k").groupBy("k").count(), "shuffled")
    end = time.monotonic() + 10
    while files() - before and time.monotonic() < end:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(store.CLEANUP) == setting
    assert {tuple(r) for r in got.collect()} == {(k, 100) for k in range(10)}


def test_stars_need_no_round(spark, monkeypatch):
    """Where every node hangs on its root already, nothing is run but the look at the edges."""
    real, steps = components.held, []
    monkeypatch.setattr(components, "held", lambda df, label: steps.append(label) or real(df, label))
    stars = spark.createDataFrame([(5, 1), (1, 7), (9, 2), (9, 2), (3, 3)], "u long, v long")
    roots = lambda df: {tuple(r) for r in df.collect()}
    assert roots(components.components(stars)) == {(1, 1), (5, 1), (7, 1), (2, 2), (9, 2)} and len(steps) == 1
    path = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(30, 31), (30, 32)], "u long, v long")
    assert roots(components.components(path)) == {(k, 0) for k in range(21)} | {(k, 30) for k in (30, 31, 32)}
    assert components.components(stars.where("false")).count() == 0


def test_small_steps_run_in_few_tasks(docs, conf, monkeypatch):
    """A step of few rows starts no task and writes no file for each of many shuffle partitions."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "101")
    rows, files = corpus(22, groups=15), []

    def counted(df, label):
        out = store.held(df, label)
        files.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(jaccard_join, "held", counted)
    monkeypatch.setattr(components, "held", counted)
    got = docs(rows)
    most = 3 * got.sparkSession.sparkContext.defaultParallelism
    assert most < 101
    assert found(jaccard_join.join(got, small=8)) == brute(rows)
    assert {x for x, _ in files} >= {"sets", "buckets", "level", "near-leaders", "edges", "members", "links"}
    # Joined levels read one table each, in a union; that step alone has more.
    assert not [x for x in files if x[0] != "near-leaders" and x[1] > most]
