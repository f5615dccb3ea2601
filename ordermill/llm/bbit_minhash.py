"""Near-duplicate documents by b-bit MinHash: bands find candidates, packed low bits of the minima
estimate their similarity, full sets confirm.

A document's set are the distinct runs of ``size`` words of its text in ASCII lower case, or all its words as
one where there are fewer. Documents are linked if their sets have a Jaccard similarity of at least
``percent`` / 100; what links connect is one component. Equal sets take part once.

1. 160 minima a set. Each five of them make the key of a band, of 32 bands. Of every minimum the lowest two
   bits stay, packed into five 64-bit numbers. Two sets agree in a share R = C + (1 - C) * J of their
   codes, where C = 1/4 is the share by chance: J = (R - C) / (1 - C), counted by the bits of an exclusive or.
2. Sets that share a band are candidates: a pair at the threshold shares none with probability 3e-6. All
   sets of a band are first compared with its lowest one, by bits. Those that agree enough form a group.
   In a band whose sets are still in several groups, all sets outside its largest group are compared with
   all sets of the band, dealt over blocks. "Enough" is 4.5 standard deviations below what the
   threshold makes expect (a pair at it is passed over with probability 3e-6), so groups only hold what
   may be linked.
3. Within a group, exact comparisons: a few heads with all members; then, for members that this leaves outside
   the group's largest component, each with all members. Nothing is cut off, and a group of thousands
   of copies of one text costs as many comparisons as it has members.

Rows of a band are dealt over ``SALTS`` tasks by a hash of the set and blocks of a group are of bounded size,
so neither a frequent band nor a large group lands in one task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as X
from ordermill.llm.components import components
from ordermill.llm.jaccard_join import _marked, _table, lowest, set_ids, shingles
from ordermill.llm.store import held

BANDS, ROWS, BITS = 32, 5, 2
HASHES = BANDS * ROWS
LONGS = HASHES * BITS // 64
CHANCE = 1 / 2**BITS
SIZE = 4
PERCENT = 80
SALTS = 16
BAND_BLOCK = 2_048
BLOCK_SETS = 1_000
BLOCK_SHINGLES = 1_000_000
HEADS = 4
_U = np.uint64
_FACTORS = X.mix(np.arange(1, HASHES + 1, dtype=_U) * _U(0xC2B2AE3D27D4EB4F)) | _U(1)


def agreement_needed(percent: int = PERCENT) -> int:
    """Codes in which two sets must agree to be compared exactly."""
    share = CHANCE + (1 - CHANCE) * percent / 100
    return math.floor(HASHES * share - 4.5 * math.sqrt(HASHES * share * (1 - share)))


def minima(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of minhash values for each text that has a set."""
    starts = first[:-1][np.diff(first) > 0]
    out = np.empty((len(starts), HASHES), _U)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(grams * _FACTORS[k], starts) if len(starts) else 0
    return X.mix(out)


def band_keys(values: np.ndarray) -> np.ndarray:
    """A key for each band; equal only for equal minima of the same band."""
    parts = values.reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(X.mix(np.arange(1, BANDS + 1, dtype=_U)), parts.shape[:2])
    for r in range(ROWS):
        key = X.mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return X.signed(key)


def packed(values: np.ndarray) -> np.ndarray:
    """The lowest two bits of each value, in ``LONGS`` numbers a row."""
    codes = (values & _U(2**BITS - 1)).astype(np.uint8)
    bits = np.stack([codes >> b & 1 for b in range(BITS)], axis=2).reshape(len(codes), HASHES * BITS)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def agreement(a: Column, b: Column) -> Column:
    """In how many codes two packed signatures agree."""
    differ = F.lit(0)
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        pairs = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(pairs)
    return HASHES - differ


def estimate(agreed: Column) -> Column:
    """The similarity that so many equal codes stand for, corrected for equality by chance."""
    return (agreed / HASHES - CHANCE) / (1 - CHANCE)


PRINTS = "doc_id long, id long, size long, sig array<long>, bands array<long>"


def fingerprints(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, id of the set (null without one), its size, signature and bands. Written to the shared folder."""

    def run(batches):
        for batch in X.slices(batches, "text"):
            grams, first = shingles(X.lower_ascii(X.texts_of(batch.column("text"))), size)
            n, sizes = batch.num_rows, np.diff(first)
            has = sizes > 0
            values = minima(grams, first)
            ids = np.zeros(n, np.int64)
            ids[has] = set_ids(grams, first)
            lists = []
            for table, width in ((packed(values), LONGS), (band_keys(values), BANDS)):
                offsets = np.concatenate([[0], np.cumsum(has * width)]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.reshape(-1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(ids, mask=~has), pa.array(sizes), *lists],
                names=["doc_id", "id", "size", "sig", "bands"],
            )

    return held(documents.select("doc_id", "text").mapInArrow(run, PRINTS), "signatures")


def _salt(column: str = "id") -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS))


def _salted(keys: DataFrame) -> DataFrame:
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def groups_of(sets: DataFrame, agree: int) -> DataFrame:
    """(id, root) of the sets (id, sig, bands) that agree with others enough to be compared exactly."""
    sig = sets.select("id", "sig")
    level = sets.select("id", F.explode("bands").alias("band"))
    shared = held(
        level.groupBy("band").agg(F.count("*").alias("n"), F.min("id").alias("head"), F.max("id").alias("tail")).where("n > 1"),
        "bands",
    )
    # Bands of two sets are a pair already; only larger ones are joined back to their sets.
    twos = shared.where("n = 2").select(F.col("tail").alias("id"), "head").distinct()
    large = shared.where("n > 2").join(sig.select(F.col("id").alias("head"), F.col("sig").alias("head_sig")), "head")
    entries = held(
        level.withColumn("salt", _salt()).join(_salted(large.select("band", "head", "head_sig")), ["band", "salt"])
        .select("band", "id", "head", "head_sig"),
        "entries",
    )
    near = twos.join(sig.select(F.col("id").alias("head"), F.col("sig").alias("head_sig")), "head").unionByName(
        entries.where("id <> head").select("id", "head", "head_sig").dropDuplicates(["id", "head"])
    )
    close = near.join(sig, "id").where(agreement(F.col("sig"), F.col("head_sig")) >= agree)
    edges = held(close.select(F.col("id").alias("u"), F.col("head").alias("v")).distinct(), "heads")
    placed = entries.select("band", "id").join(components(edges), "id", "left").withColumn("root", F.coalesce("root", "id"))
    in_group = held(placed, "placed")
    sizes = in_group.groupBy("band", "root").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("band").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots")
    ).where("roots > 1").withColumn("blocks", F.ceil(F.col("n") / BAND_BLOCK))
    rest = in_group.withColumn("salt", _salt()).join(_salted(mixed.select("band", "main", "blocks")), ["band", "salt"])
    rest = held(rest.select("band", "id", "root", "main", "blocks").join(sig, "id"), "mixed-bands")
    homes = rest.select(
        "band", F.pmod(F.xxhash64("id"), "blocks").alias("block"), "id", "root", "sig", (F.col("root") == F.col("main")).alias("in_main")
    )
    probes = rest.where("root <> main").select(
        "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.col("id").alias("u"), F.col("root").alias("u_root"), F.col("sig").alias("u_sig"),
    )
    met = homes.join(probes, ["band", "block"]).where(
        (F.col("root") != F.col("u_root")) & (F.col("in_main") | (F.col("u") < F.col("id")))
        & (agreement(F.col("sig"), F.col("u_sig")) >= agree)
    )
    # One edge to each group is enough: its members are together already.
    more = met.groupBy("u", "root").agg(F.min("id").alias("v")).select("u", "v")
    return held(components(edges.unionByName(more)), "groups")


def linked(homes: DataFrame, probes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (u, v) that connect what is linked among ``probes`` and ``homes`` (root, id, size) of the same
    group, by full sets. Both sides are dealt over blocks of a bounded number of sets and shingles."""

    def dealt(rows, name):
        blocks = rows.groupBy("root").agg(
            F.greatest(F.ceil(F.sum("size") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS)).alias(name)
        )
        return blocks

    numbers = held(dealt(homes, "rows").join(dealt(probes, "columns"), "root"), "blocks")
    own = lambda n: F.pmod(F.xxhash64("id"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    home = homes.join(numbers, "root").select("root", "id", own("rows").alias("i"), every("columns").alias("j"), F.lit(False).alias("probe"))
    probe = probes.join(numbers, "root").select("root", "id", every("rows").alias("i"), own("columns").alias("j"), F.lit(True).alias("probe"))
    placed = home.unionByName(probe).groupBy("root", "id", "i", "j").agg(F.max("probe").alias("probe"), F.min("probe").alias("only"))
    rows = placed.join(texts, "id").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")

    def run(batches):
        for table in _table(batches, "root", "i", "j"):
            keys = [np.asarray(table[c]) for c in ("root", "i", "j")]
            cuts = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(table)], strict=True):
                u, v = _linked_block(table.slice(a, z - a), size, percent)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        X.release()

    return held(rows.select("root", "i", "j", "id", "probe", "only", "text").mapInArrow(run, "u long, v long"), "links")


def _linked_block(table: pa.Table, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each set to the lowest it is connected to in this block. ``probe`` marks sets compared with
    all, ``only`` those that are no homes here."""
    ids, probe, only = (np.asarray(table[c]) for c in ("id", "probe", "only"))
    grams, first = shingles(X.lower_ascii(X.texts_of(table["text"])), size)
    sizes = np.diff(first)
    n = len(ids)
    row = np.repeat(np.arange(n), sizes)
    distinct, column, seen = np.unique(grams, return_inverse=True, return_counts=True)
    # Shingles that no probe has, or that one set alone has, decide nothing.
    asked = np.zeros(len(distinct), bool)
    asked[column[probe[row]]] = True
    shared = np.flatnonzero(asked & (seen > 1))
    number = np.full(len(distinct), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    asking, homes = np.flatnonzero(probe), np.flatnonzero(~only)
    common = np.zeros((len(asking), len(homes)), np.float32)
    step = max(64, 4_000_000 // max(n, 1))
    for at in range(0, len(shared), step):
        a, z = np.searchsorted(column, [at, at + step])
        part = np.zeros((n, min(step, len(shared) - at)), np.float32)
        part[row[a:z], column[a:z] - at] = 1
        common += part[asking] @ part[homes].T
    union = sizes[asking][:, None] + sizes[homes][None] - common
    a, b = np.nonzero(100 * common.astype(np.int64) >= percent * union.astype(np.int64))
    label = lowest(n, asking[a], homes[b])
    mine = np.flatnonzero(label != np.arange(n))
    return ids[mine], ids[label[mine]]


def confirmed(documents: DataFrame, sets: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, root) of the components by full sets within the groups (id, root)."""
    members = held(groups.join(sets.select("id", "size", "low"), "id"), "members")
    found = _marked(documents.select("doc_id", "text"), members)
    found = found.join(members.select("id", "low"), found["doc_id"].eqNullSafe(F.col("low"))).select("id", "text")
    texts = held(_own_text(found, size), "texts")
    salted = members.withColumn("at", F.struct(F.xxhash64("id"), "id"))
    # Heads through the lowest of each salt, so that no task sorts a whole group.
    few = salted.withColumn("salt", _salt()).groupBy("root", "salt").agg(F.min("at").alias("at"))
    heads = few.groupBy("root").agg(F.slice(F.sort_array(F.collect_list("at")), 1, HEADS).alias("heads"))
    heads = heads.select(F.explode("heads.id").alias("id")).join(members, "id")
    edges = linked(members, heads, texts, size, percent)
    now = members.join(components(edges).withColumnRenamed("root", "part"), "id", "left").withColumn("part", F.coalesce("part", "id"))
    now = held(now, "parts")
    main = now.groupBy("root", "part").agg(F.count("*").alias("n")).groupBy("root").agg(
        F.max(F.struct("n", "part"))["part"].alias("main")
    )
    rest = held(now.join(main, "root").where("part <> main").select("root", "id", "size", "low"), "rest")
    tested = heads.select("id")
    open_groups = rest.join(tested, "id", "left_anti")
    more = linked(members, open_groups, texts, size, percent)
    return components(edges.unionByName(more))


def _own_text(texts: DataFrame, size: int) -> DataFrame:
    """One text of each set: a document id may stand for other texts too."""

    def run(batches):
        for batch in X.slices(batches, "text"):
            grams, first = shingles(X.lower_ascii(X.texts_of(batch.column("text"))), size)
            own, has = np.zeros(batch.num_rows, np.int64), np.diff(first) > 0
            own[has] = set_ids(grams, first)
            yield batch.filter(pa.array(has & (own == np.asarray(batch.column("id")))))

    # Rows that repeat an id and its text are dropped by the set they make; the first of them serves.
    return texts.mapInArrow(run, "id long, text string").groupBy("id").agg(F.first("text").alias("text"))


def near_duplicates(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles (size of the set), component_id (the smallest doc_id that links connect the document
    to, itself included) and kept (it is that document) of every row given, whatever other columns there are.

    Texts that are null, empty or white space alone have no set: they are linked with nothing and kept.
    Repeated rows are copies of each other and stay or go together. Rows without a doc_id are linked like
    others, never give a component its id unless it has no other (null), and are kept only then. Sets are told
    apart by 64 bits.
    """
    prints = fingerprints(documents, size)
    sets = held(
        prints.where("id IS NOT NULL").groupBy("id").agg(
            F.first("size").alias("size"), F.first("sig").alias("sig"), F.first("bands").alias("bands"),
            F.min("doc_id").alias("low"),
        ),
        "sets",
    )
    groups = groups_of(sets, agreement_needed(percent))
    parts = confirmed(documents, sets, groups, size, percent)
    known = sets.select("id", "low").join(parts, "id", "left").withColumn("root", F.coalesce("root", "id"))
    lowest_doc = known.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = known.join(lowest_doc, "root").select("id", "component_id")
    component = F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return prints.select("doc_id", "id", "size").join(classes, "id", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
