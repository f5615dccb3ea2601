"""Similarity join of texts by the Jaccard similarity of their word n-grams, by chosen paths.

A text's set are its runs of ``size`` words (all its words where there are fewer); two texts are linked
if their sets have a Jaccard similarity of at least ``threshold``. Equal sets form one class, which
takes part once.

1. A set becomes a sketch of 128 tokens (minhash values). Two sketches agree in about as many places
   as their similarity says.
2. Chosen paths: in every run a sketch picks each of its tokens with probability 1 / (split * 128), by
   a hash of run and token, and goes to the bucket of each token it picked. Similar sketches pick
   the same tokens. A bucket of at most ``small`` sketches is compared pair by pair. In a larger one
   all are compared with a few leaders. A set that agrees with a leader is linked to it and leaves the
   bucket. By the triangle inequality whatever is similar to such a set is at least within a wider
   distance of its leader: sets at that distance that do not agree with the leader themselves are compared
   with all the leader has taken, in blocks. The rest is split again by newly picked tokens, until no
   large bucket is left. Nothing is cut off. The number of runs follows from the target recall: a pair at
   the threshold survives arbitrarily many splits with probability q, q = 1 - exp(-q * threshold / split).
3. Pairs found, all of them of sketches that agree enough, form groups. Within each group all sets are compared exactly, in blocks of bounded
   size, and only each text's number of links and one link to its component leave a task. So a
   group of thousands of near copies is never written out as pairs.

Rows of a bucket are dealt over ``SALTS`` tasks wherever they are taken one by one, so that a frequent
bucket does not land in one task.

Null and empty texts, and those of white space alone, have no set: each is its own class with no
link. Repeated rows are copies of each other. Sets are told apart by a 64-bit hash. Other columns, whatever
their names, are not looked at (``keep_one`` keeps them).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm import text as X
from ordermill.llm.components import components
from ordermill.llm.store import fewer, fresh, held

TOKENS = 128
THRESHOLD = 0.8
SPLIT = 0.64
SMALL = 512
LEADERS = 16
SALTS = 16
TAKEN_BLOCK = 2_048
RECALL = 0.999
BLOCK_SETS = 1_000
BLOCK_SHINGLES = 1_000_000
_U = np.uint64
_FACTORS = X.mix(np.arange(1, TOKENS + 1, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)
_PLACE = X.mix(np.arange(TOKENS, dtype=_U) + _U(0x2545F4914F6CDD1D))


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD, split: float = SPLIT) -> int:
    """Runs after which a pair at the threshold has been found with probability ``recall``."""
    q = 1.0
    for _ in range(10_000):
        q = 1 - math.exp(-q * threshold / split)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def shingles(texts: X.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, and where those of each text begin."""
    spans = X.words(texts)
    h = X.hash_spans(texts.data, spans.starts, spans.ends)
    at, grams = X.windows(h, spans.first, size)
    owner = spans.owner()
    who = owner[at]
    counts = spans.counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.zeros(len(short), _U)
        for k in range(1, size):
            mine = counts[short] == k
            begin = spans.first[:-1][short[mine]]
            v = np.full(mine.sum(), _U(k))
            for j in range(k):
                v = X.mix(v * _U(0x9E3779B97F4A7C15)) + h[begin + j]
            whole[mine] = X.mix(v)
        grams, who = np.concatenate([grams, whole]), np.concatenate([who, short])
    _, one = np.unique(X.with_owner(grams, who), return_index=True)
    one = one[np.argsort(who[one], kind="stable")]
    grams, who = grams[one], who[one]
    return grams, np.searchsorted(who, np.arange(len(texts) + 1))


def sketches(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of 128 minhash values for each text that has a set."""
    starts = first[:-1][np.diff(first) > 0]
    out = np.empty((len(starts), TOKENS), _U)
    for k in range(TOKENS):
        out[:, k] = np.minimum.reduceat(grams * _FACTORS[k], starts) if len(starts) else 0
    return X.mix(out)


def set_ids(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set that does not depend on order."""
    starts = first[:-1][np.diff(first) > 0]
    if not len(starts):
        return np.zeros(0, np.int64)
    total = np.add.reduceat(X.mix(grams ^ _U(0x5851F42D4C957F2D)), starts)
    return X.signed(X.mix(total + np.diff(first)[np.diff(first) > 0].astype(_U)))


def picks(nodes: np.ndarray, tokens: np.ndarray, split: float = SPLIT) -> tuple[np.ndarray, np.ndarray]:
    """Rows and new buckets: which tokens each row picks in its bucket, by a hash of both."""
    h = X.mix(tokens + (nodes.astype(_U))[:, None] * _U(0x9E3779B97F4A7C15) + _PLACE[None])
    row, place = np.nonzero(h < _U(int(2**64 / (split * TOKENS))))
    return row, X.mix(h[row, place] + _U(7))


PRINTS = "doc_id long, id long, size long, sketch binary, nodes array<long>"


def fingerprints(documents: DataFrame, size: int = 5, recall: float = RECALL, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, id of the set (null without one), its size, the low bytes of the sketch and the
    buckets of the first level in all runs. Written to the shared folder."""
    runs = runs_for(recall, threshold)

    def run(batches):
        for batch in X.slices(batches, "text"):
            grams, first = shingles(X.texts_of(batch.column("text")), size)
            n = batch.num_rows
            sizes = np.diff(first)
            has = sizes > 0
            tokens = sketches(grams, first)
            rows, nodes = [], []
            for r in range(runs):
                row, node = picks(np.full(len(tokens), r, _U), tokens)
                rows.append(row)
                nodes.append(node)
            row, node = np.concatenate(rows), np.concatenate(nodes)
            order = np.argsort(row, kind="stable")
            counts = np.zeros(n, np.int64)
            counts[has] = np.bincount(row, minlength=len(tokens))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            ids, low = np.zeros(n, np.int64), np.zeros((n, TOKENS), np.uint8)
            ids[has], low[has] = set_ids(grams, first), (tokens & _U(0xFF)).astype(np.uint8)
            raw = low.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, mask=~has), pa.array(sizes),
                 pa.array([raw[i : i + TOKENS] for i in range(0, len(raw), TOKENS)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(X.signed(node[order])))],
                names=["doc_id", "id", "size", "sketch", "nodes"],
            )

    return held(documents.select("doc_id", "text").mapInArrow(run, PRINTS), "prints")


def _table(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Parts of rows sorted by ``keys`` that end where a key ends. Freed memory goes back in between."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        X.release()
        last = np.ones(batch.num_rows, bool)
        for k in keys:
            v = np.asarray(batch.column(k))
            last &= v == v[-1]
        cut = int(np.argmax(last))
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        elif rest and any(np.asarray(rest[-1].column(k))[-1] != np.asarray(batch.column(k))[-1] for k in keys):
            yield pa.Table.from_batches(rest)
            rest = [batch]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)
    X.release()


def _sketch_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, TOKENS)


def compare_small(entries: DataFrame, agree: int) -> DataFrame:
    """Edges between all rows of a bucket that agree in at least ``agree`` tokens, each bucket's
    edges reduced to one per row."""

    def run(batches):
        for table in _table(batches, "node"):
            node, ids = np.asarray(table["node"]), np.asarray(table["id"])
            sketch = _sketch_matrix(table["sketch"])
            label = np.arange(len(ids))
            pairs = []
            gap = 1
            while True:
                at = np.flatnonzero(node[gap:] == node[:-gap]) if gap < len(node) else ()
                if not len(at):
                    break
                ok = at[(sketch[at] == sketch[at + gap]).sum(axis=1) >= agree]
                pairs.append(np.stack([ok, ok + gap], axis=1))
                gap += 1
            found = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
            label = lowest(len(ids), found[:, 0], found[:, 1])
            mine = np.flatnonzero(label != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[mine]), pa.array(ids[label[mine]])], names=["u", "v"])

    return entries.mapInArrow(run, "u long, v long")


def lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest index of each one's component, for edges between a and b."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    return label


LEVEL = (
    "node long, id long, sketch binary, leader long, near array<long>, nodes array<long>, "
    "links array<struct<node: long, u: long, v: long>>"
)


def _salt(column: str = "id") -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS))


def _salted(keys: DataFrame) -> DataFrame:
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def compare_leaders(entries: DataFrame, n_entries: int, agree: int, wide: int, split: float) -> DataFrame:
    """For the rows of large buckets: the leader that has taken the row, if it agrees with one; else the
    buckets of the next level; the leaders it is near without agreeing; and, on one row of many, the leaders
    that rows agree with besides their own. Written to the shared folder."""
    w = Window.partitionBy("node").orderBy(F.xxhash64("id"), "id")
    leaders = (
        entries.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= LEADERS)
        # The same order in every bucket, so that a text hangs on the same leader wherever both meet.
        .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "sketch"))).alias("leaders"))
    )

    leaders = fewer(leaders, n_entries)

    def run(batches):
        for batch in batches:
            X.release()
            if not batch.num_rows:
                continue
            node, ids = np.asarray(batch.column("node")), np.asarray(batch.column("id"))
            sketch = _sketch_matrix(batch.column("sketch"))
            n = len(ids)
            taken, leader = np.zeros(n, bool), np.zeros(n, np.int64)
            near_row, near_leader, links = [], [], [np.zeros((0, 3), np.int64)]
            nodes, one, code = np.unique(node, return_index=True, return_inverse=True)
            for k, at in enumerate(one.tolist()):
                mine = np.flatnonzero(code == k)
                heads = batch.column("leaders")[at].as_py()
                head_ids = np.array([h["id"] for h in heads])
                table = _sketch_matrix(pa.array([h["sketch"] for h in heads]))
                same = np.stack([(sketch[mine] == t).sum(axis=1) for t in table], axis=1)
                # The first leader that agrees, so that similar rows hang on the same one.
                agrees = same >= agree
                taken[mine] = agrees.any(axis=1)
                first = agrees.argmax(axis=1)
                leader[mine] = head_ids[first]
                row, other = np.nonzero(agrees)
                pair = np.stack([head_ids[first[row]], head_ids[other]], axis=1)[first[row] != other]
                pair = np.unique(pair, axis=0)
                links.append(np.concatenate([np.full((len(pair), 1), nodes[k]), pair], axis=1))
                row, other = np.nonzero((same >= wide) & ~agrees)
                near_row.append(mine[row])
                near_leader.append(head_ids[other])
            row, head = np.concatenate(near_row), np.concatenate(near_leader)
            order = np.argsort(row, kind="stable")
            near_first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
            left = np.flatnonzero(~taken)
            stays, child = picks(X.mix(node[left].view(_U)), sketch[left].astype(_U), split)
            counts = np.zeros(n, np.int64)
            counts[left] = np.bincount(stays, minlength=len(left))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            pairs = np.unique(np.concatenate(links), axis=0)
            one_row = np.full(n + 1, len(pairs), np.int32)
            one_row[0] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("id"), batch.column("sketch"), pa.array(leader, mask=~taken),
                 pa.ListArray.from_arrays(pa.array(near_first), pa.array(head[order])),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(X.signed(child))),
                 pa.ListArray.from_arrays(pa.array(one_row), pa.StructArray.from_arrays(
                     [pa.array(pairs[:, c]) for c in range(3)], names=["node", "u", "v"]))],
                names=["node", "id", "sketch", "leader", "near", "nodes", "links"],
            )

    joined = entries.withColumn("salt", _salt()).join(_salted(leaders), ["node", "salt"])
    return held(fewer(joined.select("node", "id", "sketch", "leaders"), n_entries).mapInArrow(run, LEVEL), "level")


def _leader_roots(links: DataFrame, n_entries: int) -> DataFrame:
    """(node, leader, leader_root) of the leaders of a bucket that rows of it link with each other."""

    def run(batches):
        for batch in batches:
            rows = [np.zeros((3, 0), np.int64)]
            for r in batch.to_pylist():
                pairs = np.array([(x["u"], x["v"]) for x in r["pairs"]], np.int64)
                leaders, code = np.unique(pairs, return_inverse=True)
                code = code.reshape(-1, 2)
                label = lowest(len(leaders), code[:, 0], code[:, 1])
                rows.append(np.stack([np.full(len(leaders), r["node"]), leaders, leaders[label]]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(rows, axis=1)], names=["node", "leader", "leader_root"])

    # Of 16 leaders a bucket: at most 240 pairs.
    pairs = links.groupBy("node").agg(F.collect_set(F.struct("u", "v")).alias("pairs"))
    return fewer(pairs, n_entries).mapInArrow(run, "node long, leader long, leader_root long")


def compare_taken(parted: DataFrame, n_parted: int, agree: int) -> tuple[DataFrame | None, int]:
    """Edges between rows near a leader and those it has taken, one a row and block, and how many at most; None without such rows.
    A row is not compared if its own leader is linked with that leader in the same bucket. ``parted`` may have
    the buckets of many levels: what is compared stays within a bucket."""
    taken = parted.where("leader IS NOT NULL AND leader <> id").select("node", "leader", "id", "sketch")
    sizes = fewer(taken.groupBy("node", "leader").agg(F.ceil(F.count("*") / TAKEN_BLOCK).alias("blocks")), n_parted)
    roots = _leader_roots(parted.where(F.size("links") > 0).select(F.inline("links")), n_parted)
    sizes = sizes.join(roots, ["node", "leader"], "left").withColumn("leader_root", F.coalesce("leader_root", "leader"))
    # The leaders of a bucket that have taken a row: 16 at most.
    of_node = fewer(sizes.groupBy("node").agg(F.collect_list(F.struct("leader", "leader_root", "blocks")).alias("active")), n_parted)
    near = parted.where(F.size("near") > 0).select("node", "id", "sketch", "near", F.col("leader").alias("own"))
    near = near.withColumn("salt", _salt()).join(_salted(of_node), ["node", "salt"])
    root = F.filter("active", lambda x: x["leader"].eqNullSafe(F.col("own")))["leader_root"]
    near = near.withColumn("root", F.try_element_at(root, F.lit(1)))
    other = F.filter("active", lambda x: F.array_contains("near", x["leader"]) & ~x["leader_root"].eqNullSafe(F.col("root")))
    near = near.withColumn("open", other).where(F.size("open") > 0)
    near = held(near.select("node", "id", "sketch", F.inline("open")).drop("leader_root"), "near-leaders")
    probes = near.agg(F.sum("blocks")).first()[0]
    if not probes:
        return None, 0
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    asked = _salted(near.select("node", "leader", "blocks").distinct())
    homes = taken.withColumn("salt", _salt()).join(asked, ["node", "leader", "salt"])
    rows = homes.select("node", "leader", own, "id", "sketch", F.lit(False).alias("probe")).unionByName(
        near.select("node", "leader", every, "id", "sketch", F.lit(True).alias("probe"))
    )

    def run(batches):
        for table in _table(batches, "node", "leader", "block"):
            keys = np.stack([np.asarray(table[c]) for c in ("node", "leader", "block")])
            cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            ids, probe, sketch = np.asarray(table["id"]), np.asarray(table["probe"]), _sketch_matrix(table["sketch"])
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                home = a + np.flatnonzero(~probe[a:z])
                if not len(home):
                    continue
                for k in a + np.flatnonzero(probe[a:z]):
                    hit = np.flatnonzero((sketch[home] == sketch[k]).sum(axis=1) >= agree)
                    if len(hit):
                        # All that a leader has taken are one group already.
                        us.append(ids[k : k + 1])
                        vs.append(ids[home[hit[:1]]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    dealt = fewer(rows.repartition("node", "leader", "block"), n_parted + probes).sortWithinPartitions("node", "leader", "block")
    return held(dealt.mapInArrow(run, "u long, v long"), "near"), probes


def candidates(sets: DataFrame, threshold: float = THRESHOLD, split: float = SPLIT, small: int = SMALL) -> DataFrame:
    """Edges (u, v) that put similar sets into one group. ``sets``: id, sketch, nodes."""
    return _candidates(sets, threshold, split, small)[0]


def _candidates(
    sets: DataFrame, threshold: float = THRESHOLD, split: float = SPLIT, small: int = SMALL
) -> tuple[DataFrame, int]:
    """The candidates, and how many edges there are at most."""
    spread = math.sqrt(TOKENS * threshold * (1 - threshold))
    agree = math.floor(TOKENS * threshold - 4.5 * spread)
    # How far from a leader a set can be that is similar to one that agrees with it.
    least = max(0.0, agree / TOKENS + threshold - 1)
    wide = max(0, math.floor(TOKENS * least - 4.5 * math.sqrt(TOKENS * least * (1 - least))))
    level, sketch_of = sets.select("id", F.explode("nodes").alias("node")), sets.select("id", "sketch")
    few = parted = None
    n_level, n_few, n_parted = sets.agg(F.sum(F.size("nodes"))).first()[0] or 0, 0, 0
    # Only the splits go level by level. No level waits for the pairs of another, so those of all are compared at once.
    while True:
        counts = fewer(level.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), n_level)
        met = level.withColumn("salt", _salt()).join(_salted(counts), ["node", "salt"])
        # Most sets are alone in their first buckets and leave their sketches where they are.
        met = met if "sketch" in met.columns else met.select("node", "n", "id").join(sketch_of, "id")
        shared = held(fewer(met.select("node", "n", "id", "sketch"), n_level), "buckets")
        n_shared, n_many = shared.agg(F.count("*"), F.count_if(F.col("n") > small)).first()
        n_few += n_shared - n_many
        here = shared.where(F.col("n") <= small).select("node", "id", "sketch")
        few = here if few is None else few.unionByName(here)
        many = shared.where(F.col("n") > small).select("node", "id", "sketch")
        if not n_many:
            break
        split_up = compare_leaders(many, n_many, agree, wide, split)
        n_parted += n_many
        # A row goes to 1 / split buckets on average.
        n_level = math.ceil(n_many / split)
        parted = split_up if parted is None else parted.unionByName(split_up)
        level = split_up.where("leader IS NULL").select("id", "sketch", F.explode("nodes").alias("node"))
    edges = compare_small(fewer(few.repartition("node"), n_few).sortWithinPartitions("node", F.xxhash64("id")), agree)
    if parted is None:
        return edges, n_few
    taken = parted.where("leader IS NOT NULL AND leader <> id").select(F.col("id").alias("u"), F.col("leader").alias("v"))
    links = parted.where(F.size("links") > 0).select(F.inline("links")).select("u", "v")
    near, n_near = compare_taken(parted, n_parted, agree)
    found = [edges, taken, links] if near is None else [edges, taken, links, near]
    # Links of leaders are at most 240 a bucket of over 512 rows, beside those of the rows.
    return functools.reduce(DataFrame.unionByName, found), n_few + 2 * n_parted + n_near


CHECKED = "comp long, one_block boolean, id long, root long, links long"


def exact_links(texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Rows (comp, i, j, block, id, copies, text), each of the blocks i and j of a group: the number
    of documents linked to each set and the lowest set it is connected to, pair of blocks by pair."""

    def run(batches):
        for table in _table(batches, "comp", "i", "j"):
            comp, i, j = (np.asarray(table[c]) for c in ("comp", "i", "j"))
            cuts = np.flatnonzero((np.diff(comp) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            out = []
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(comp)], strict=True):
                out.append(_group(table.slice(a, z - a), size, threshold))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                names=["comp", "one_block", "id", "root", "links"],
            )

    return texts.mapInArrow(run, CHECKED)


def _group(table: pa.Table, size: int, threshold: float) -> tuple[np.ndarray, ...]:
    ids, block, copies = (np.asarray(table[c]) for c in ("id", "block", "copies"))
    grams, first = shingles(X.texts_of(table["text"]), size)
    # A document id may stand for other texts too; keep the text of each set, once.
    has = np.diff(first) > 0
    own = np.zeros(len(ids), np.int64)
    own[has] = set_ids(grams, first)
    keep = np.flatnonzero(has & (own == ids))
    keep = keep[np.unique(ids[keep], return_index=True)[1]]
    ids, block, copies = ids[keep], block[keep], copies[keep]
    n, sizes = len(keep), np.diff(first)[keep]
    flat = grams[X.ranges(first[:-1][keep], sizes)]
    row = np.repeat(np.arange(n), sizes)
    distinct, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(seen > 1)
    number = np.full(len(distinct), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n), np.float32)
    step = max(64, 4_000_000 // max(n, 1))
    for at in range(0, len(shared), step):
        a, z = np.searchsorted(column, [at, at + step])
        part = np.zeros((n, min(step, len(shared) - at)), np.float32)
        part[row[a:z], column[a:z] - at] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None] - common
    linked = common >= threshold * union
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    if i != j:
        linked &= block[:, None] != block[None]
    np.fill_diagonal(linked, False)
    a, b = np.nonzero(linked)
    label = lowest(n, a, b)
    blocks = table["blocks"][0].as_py()
    comp = np.full(n, table["comp"][0].as_py(), np.int64)
    return comp, np.full(n, blocks == 1), ids, ids[label], np.bincount(a, weights=copies[b], minlength=n).astype(np.int64)


def join(
    documents: DataFrame, size: int = 5, threshold: float = THRESHOLD, recall: float = RECALL,
    block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES, small: int = SMALL,
) -> DataFrame:
    """doc_id, class_id (the smallest id of all documents connected by links), n_copies (documents
    with the same set, itself included) and n_links (other documents it is linked to, copies
    included) of every document."""
    prints = fingerprints(documents, size, recall, threshold)
    n_prints = prints.count()
    sets = prints.where("id IS NOT NULL").groupBy("id").agg(
        F.first("size").alias("size"), F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes"),
        F.min("doc_id").alias("low"), F.count("*").alias("copies"),
    )
    sets = held(fewer(sets, n_prints), "sets")
    groups = components(*_candidates(sets, threshold, small=small)).withColumnRenamed("root", "comp")
    members = groups.join(sets.select("id", "size", "low", "copies"), "id")
    blocks = members.groupBy("comp").agg(
        F.greatest(
            F.ceil(F.sum("size") / block_shingles), F.ceil(F.count("*") / block_sets), F.lit(1)
        ).cast("int").alias("blocks")
    )
    placed = members.join(blocks, "comp").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = held(fewer(placed, n_prints), "members")
    n_compared, n_shingles = dealt.agg(F.sum("blocks"), F.sum(F.col("blocks") * F.col("size"))).first()
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j"))))
    texts = _marked(documents.select("doc_id", "text"), dealt)
    texts = texts.join(dealt, texts["doc_id"].eqNullSafe(dealt["low"]))
    spread = texts.select("comp", "blocks", "block", "id", "copies", "text", pair.alias("pair")).select(
        "comp", "blocks", "block", "id", "copies", "text", "pair.i", "pair.j"
    )
    spread = fewer(spread.repartition("comp", "i", "j"), n_shingles or 0, block_shingles).sortWithinPartitions("comp", "i", "j")
    checked = held(exact_links(spread, size, threshold), "links")
    links = checked.groupBy("id").agg(
        F.sum("links").alias("links"), F.min(F.when(F.col("one_block"), F.col("root"))).alias("root")
    )
    parts = checked.where(~F.col("one_block")).select(F.col("id").alias("u"), F.col("root").alias("v"))
    if not parts.isEmpty():
        wide = components(parts, n_compared).withColumnRenamed("root", "wide")
        links = links.join(wide, "id", "left").withColumn("root", F.coalesce("root", "wide", "id"))
    known = sets.select("id", "low", "copies").join(links.select("id", "links", "root"), "id", "left").withColumn(
        "root", F.coalesce("root", "id")
    )
    lowest_doc = known.groupBy("root").agg(F.min("low").alias("class_id"))
    classes = known.join(lowest_doc, "root").select(
        "id", "class_id", F.col("copies").alias("n_copies"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    return fewer(prints.select("doc_id", "id").join(classes, "id", "left"), n_prints).select(
        "doc_id",
        F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def _marked(documents: DataFrame, members: DataFrame) -> DataFrame:
    """The documents whose id may be one of the members' ``low``, so that only texts to be compared
    are shuffled. One bit per hash of an id, 16 MB in all at most; what passes it wrongly is sorted
    out by the join."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 27)) + 1
    bits = members.select(place("low").alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits")
    )
    at = F.bitmap_bit_position(place("doc_id")).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = documents.withColumn("_bucket", F.bitmap_bucket_number(place("doc_id"))).join(F.broadcast(bits), "_bucket")
    return found.where(F.call_function("shiftright", byte, F.pmod(at, F.lit(8))).bitwiseAND(1) == 1).select(*documents.columns)


#: Ids of documents to remove, up to which they are broadcast (8 bytes each).
BROADCAST_IDS = 2_000_000


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """The documents with one of each class, the one with the smallest id. Rows that repeat an id are
    the same document and stay or go together."""
    name = fresh("gone", documents)
    stays = F.max(F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("stays")
    found = join(documents, **options).groupBy("doc_id").agg(stays).where("NOT stays")
    gone = held(found.select(F.col("doc_id").alias(name)), "gone")
    # Few ids are broadcast, so that the texts stay where they are.
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return documents.join(gone, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
