import random
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from ordermill.llm import packing, rans, token_files, tokens
from ordermill.session import work_folder


def fewest(sizes, capacity):
    """Fewest bins, by trying everything."""
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                bins[k] += sizes[i]
                go(i + 1, bins)
                bins[k] -= sizes[i]
        go(i + 1, bins + [sizes[i]])

    go(0, [])
    return best


def counted(sizes):
    return {s: sizes.count(s) for s in set(sizes)}


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_a_best_packing(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 17, 30])
    sizes = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 9))), reverse=True)
    fixed, left = packing.reduce_dominated(counted(sizes), capacity)
    rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
    bins = sum(n for _, n in fixed)
    assert sorted(rest + [s for g, n in fixed for s in g * n], reverse=True) == sizes
    assert all(sum(g) <= capacity for g, _ in fixed)
    assert bins + (fewest(rest, capacity) if rest else 0) == fewest(sizes, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_plans_hold_all_pieces_and_come_close_to_the_bound(seed):
    r = random.Random(seed)
    capacity = 200
    sizes = [r.randint(1, capacity) for _ in range(r.randint(0, 800))]
    plan = packing.make_plan(counted(sizes), capacity)
    assert sorted(s for g, n in zip(plan.sizes, plan.times) for s in g * n) == sorted(sizes)
    assert all(sum(g) <= capacity for g in plan.sizes)
    assert plan.sequences <= packing.lower_bound(counted(sizes), capacity) * 11 / 9 + 1


def test_three_pieces_are_fixed_where_they_dominate():
    """{w, a, b}: as of any pair beside w one piece is at most as long as a and the other as b."""
    assert packing.reduce_dominated({10: 3, 6: 2, 4: 4}, 20)[0][0] == ([10, 10], 1)
    assert packing.reduce_dominated({11: 2, 6: 2, 3: 2}, 20)[0] == [([11, 6, 3], 2)]
    r, threes = random.Random(5), 0
    for _ in range(600):
        capacity = r.choice([12, 20, 31])
        sizes = sorted((r.randint(2, capacity) for _ in range(r.randint(3, 8))), reverse=True)
        fixed, left = packing.reduce_dominated(counted(sizes), capacity)
        rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
        bins = sum(n for _, n in fixed)
        assert bins + (fewest(rest, capacity) if rest else 0) == fewest(sizes, capacity), sizes
        threes += sum(len(g) == 3 for g, _ in fixed)
    assert threes > 20


def test_best_fit_takes_the_least_room():
    groups = packing.best_fit({6: 1, 5: 1, 4: 1}, 10)
    assert sorted(tuple(sorted(g)) for g, n in groups) == [(4, 6), (5,)]


TEXTS = [None, "", "a", "a", "hello world " * 3000, "the cat sat", "x" * 3000] + [f"word{i} " * (i % 90) for i in range(200)]


def rows(texts):
    return [(i, t) for i, t in enumerate(texts)]


def whole(texts, end):
    coder = tokens.encoder(tokens.default_file()).tokenizer
    return [e.ids + [end] for e in coder.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_end_to_end(spark, docs):
    df = docs([(i, t, 1) for i, t in rows(TEXTS)], "doc_id long, text string, length int").repartition(7)
    got = packing.pack(df, capacity=256).collect()
    want = whole(TEXTS, 0)
    sequences = {}
    for r in got:
        ids = want[r["doc_id"]]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["start"] == 256 * r["piece"] and len(part) == r["length"] and crc(part) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in got) == sum(map(len, want))
    assert len({(r["doc_id"], r["piece"]) for r in got}) == len(got)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= -(-sum(map(len, want)) // 256) * 1.05 + 1


def test_packing_nothing(docs):
    assert packing.pack(docs([])).count() == 0


@pytest.mark.parametrize("n, lanes, every", [(0, 4, 2), (1, 4, 2), (1000, 7, 3), (5000, 256, 4), (300, 1, 50)])
def test_blocks_round_trip_whole_and_from_checkpoints(n, lanes, every):
    r = np.random.default_rng(n)
    ids = np.minimum(r.geometric(0.01, n), 999).astype(np.uint32)
    coder = rans.Coder(rans.table(np.bincount(ids, minlength=1000)))
    block = coder.encode(ids, lanes, every)
    assert rans.length(block) == n and (coder.decode(block) == ids).all()
    step = min(lanes, max(n, 1)) * every
    for k in range(-(-n // step)):
        assert (coder.decode(block, k, k + 1) == ids[k * step : (k + 1) * step]).all()


def test_tables_cover_every_id():
    f = rans.table(np.array([0, 10**12, 1, 0]), 8)
    assert f.sum() == 256 and f.min() >= 1 and f[1] > 240
    assert rans.table(np.zeros(5, int), 4).sum() == 16
    with pytest.raises(ValueError):
        rans.table(np.zeros(100, int), 4)


def test_damage_is_found():
    coder = rans.Coder(rans.table(np.ones(10, int)))
    block = bytearray(coder.encode(np.arange(10)))
    for at in (len(block) - 1, 40, 0):
        bad = bytes(block[:at]) + bytes([block[at] ^ 1]) + bytes(block[at + 1 :])
        with pytest.raises(rans.Corrupt):
            coder.decode(bad)
    with pytest.raises(rans.Corrupt):
        coder.decode(bytes(block[:-3]))


def test_compression_is_near_the_entropy():
    ids = np.random.default_rng(1).geometric(0.05, 200_000) % 500
    counts = np.bincount(ids, minlength=500)
    p = counts[counts > 0] / counts.sum()
    bits = -(p * np.log2(p)).sum() * len(ids)
    assert len(rans.Coder(rans.table(counts)).encode(ids)) * 8 < 1.02 * bits + 8 * 256 * 8


def test_files_round_trip(spark, docs):
    df = docs([(1000 - 3 * i, t, 7) for i, t in rows(TEXTS)], "doc_id long, text string, n_tokens int").repartition(5)
    path = work_folder(spark, "files")
    token_files.write(df, path, tokens_a_block=3000, docs_a_shard=40)
    got = {r["doc_id"]: r for r in token_files.read(spark, path).collect()}
    bare = token_files.read(spark, path, with_ids=False)
    assert bare.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r["doc_id"]: tuple(r) for r in bare.collect()} == {i: tuple(r)[:4] for i, r in got.items()}
    start = 0
    for doc_id, ids in sorted(zip([1000 - 3 * i for i in range(len(TEXTS))], whole(TEXTS, 1))):
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        start += len(ids)
    assert len(got) == len(TEXTS)


def test_files_with_repeated_and_null_ids(spark, docs):
    path = work_folder(spark, "files")
    token_files.write(docs([(5, "a b"), (5, "a b"), (None, "c"), (5, None)]), path)
    got = token_files.read(spark, path).collect()
    assert sorted((r["doc_id"] is not None, r["start"], r["n_tokens"]) for r in got) == [
        (False, 0, 2), (True, 2, 1), (True, 3, 3), (True, 6, 3)
    ]


def test_ids_are_counted_by_the_batch(monkeypatch):
    """Many texts at once: a count over the whole vocabulary for each took longer than their ids."""
    calls, counted = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **b: calls.append(1) or counted(*a, **b))
    monkeypatch.setattr(token_files, "IDS_A_COUNT", 500)
    r = np.random.default_rng(4)
    for kind, size in (("<u2", 700), ("<u4", 70_000)):
        each = [r.integers(0, size, n).astype(kind) for n in r.integers(0, 9, 1000)]
        batch = pa.RecordBatch.from_pydict({"ids": pa.array([e.tobytes() for e in each], pa.binary())})
        calls.clear()
        got = token_files.counted([batch.slice(0, 300), batch.slice(300, 0), batch.slice(300)], size)
        assert len(calls) < 20 and (got == counted(np.concatenate(each), minlength=size)).all()


def test_files_of_nothing(spark, docs):
    path = work_folder(spark, "files")
    token_files.write(docs([]), path)
    assert token_files.read(spark, path).count() == 0


def test_pairs_that_best_pair_finds():
    r = random.Random(3)
    for _ in range(300):
        left = {s: r.randint(1, 2) for s in r.sample(range(1, 20), r.randint(1, 6))}
        w, room = max(left), r.randint(1, 25)
        fit = sorted(s for s, n in left.items() if s <= room and n - (s == w) > 0)
        pool = [s for s in fit for _ in range(left[s] - (s == w))]
        want = max((a + b for a, b in combinations(pool, 2) if a + b <= room), default=0)
        assert packing._best_pair(fit, left, w, room) == want
