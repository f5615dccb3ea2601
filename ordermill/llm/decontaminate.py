"""Documents that hold benchmark passages, found by greedy string tiling.

Every run of ``min_match`` words (lower case, A-Z) of a document that also occurs in a benchmark item
is a seed. For each document and item with a seed, the longest stretches of words that both have in
common are marked one after the other, so that no word is marked twice (running Karp-Rabin: matches
are found by hashes of a length that shrinks as long matches are used up, and checked word by
word). The share of the item's words that is marked is its coverage. Order does not matter, so a
passage whose sentences were moved about is found as well.

Benchmark and documents meet as Spark rows. The seeds of the items are marked in a bitmap of 16 MB, whatever
their number, which is broadcast; documents are read once, and those with a marked window go on with their
text and windows, few of a clean corpus. A join by seed finds the items (seeds many items share are dealt over
``SALTS`` tasks), and each pair of document and item is tiled in a row of its own. So nothing of the
benchmark but the bitmap passes the driver.

A run of one word far longer than the item can use is shortened before tiling, so that a page of one word
costs no more than one of many. Items shorter than ``min_match`` words have their whole text as the seed, so
every document with that text is reported. ``clean`` removes a document for such an item only if it has no
other words; else an answer like "yes" would remove all documents with the word. Null and empty items match
nothing, null and empty documents have no match and a null doc_id stays null. Equal items, and repeated
documents, get a row each. Other columns, whatever their names, are not looked at (``clean`` keeps them).
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as X
from ordermill.llm.store import fresh, held

MIN_MATCH = 5
MIN_COVERAGE = 0.5
BITMAP_BITS = 27
SALTS = 16
_U = np.uint64
FOUND = "doc_id long, item_id long, item_words long, covered long, coverage double, tiles array<struct<item_at:long,doc_at:long,words:long>>"


def greedy_tiles(item: list[int], doc: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Non-overlapping matches (place in the item, place in the document, length), longest first."""
    used_item, used_doc = [False] * len(item), [False] * len(doc)
    tiles: list[tuple[int, int, int]] = []
    length = max(min_match, min(len(item), 32))
    while True:
        matches = _matches(item, doc, used_item, used_doc, length)
        longest = max((m[0] for m in matches), default=0)
        if longest > 2 * length:
            length = longest
            continue
        # Longest first; what another match has taken in the meantime is cut off.
        by_size = defaultdict(list)
        for size, i, j in matches:
            by_size[size].append((i, j))
        for size in range(longest, length - 1, -1):
            for i, j in sorted(by_size[size]):
                a, n = 0, 0
                for k in range(size + 1):
                    if k < size and not used_item[i + k] and not used_doc[j + k]:
                        n += 1
                        continue
                    if n == size:
                        for x in range(size):
                            used_item[i + x] = used_doc[j + x] = True
                        tiles.append((i, j, size))
                    elif n >= length:
                        by_size[n].append((i + a, j + a))
                    a, n = k + 1, 0
        if length == min_match:
            return tiles
        length = max(min_match, length // 2)


def _stretches(words: list[int], used: list[bool], length: int):
    """Starts and rolling hashes of all windows without a used word."""
    base, mod = 1_000_003, (1 << 61) - 1
    top = pow(base, length - 1, mod)
    h, n = 0, 0
    for k, w in enumerate(words):
        if used[k]:
            h, n = 0, 0
            continue
        if n == length:
            h = (h - words[k - length] * top) % mod
            n -= 1
        h = (h * base + w) % mod
        n += 1
        if n == length:
            yield k - length + 1, h


def _matches(item, doc, used_item, used_doc, length) -> list[tuple[int, int, int]]:
    at: dict[int, list[int]] = defaultdict(list)
    for i, h in _stretches(item, used_item, length):
        at[h].append(i)
    out = []
    for j, h in _stretches(doc, used_doc, length):
        for i in at.get(h, ()):
            # A match that could begin earlier was found from there.
            if i and j and item[i - 1] == doc[j - 1] and not used_item[i - 1] and not used_doc[j - 1]:
                continue
            n = 0
            while (
                i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                and not used_item[i + n] and not used_doc[j + n]
            ):
                n += 1
            if n >= length:
                out.append((n, i, j))
    return out


def shortened(words: list[int], places: list[int], most: dict[int, int]) -> tuple[list[int], list[int]]:
    """The words, and where they stand, with the middle of each run of one word taken out that is longer than
    twice the number of times the item has it: tiles can use no more of it, from either end or within."""
    out, where, k = [], [], 0
    while k < len(words):
        end = k
        while end < len(words) and words[end] == words[k]:
            end += 1
        keep = most.get(words[k], 0) + 1
        if words[k] and end - k > 2 * keep:
            out += words[k : k + keep] + words[end - keep : end]
            where += places[k : k + keep] + places[end - keep : end]
        else:
            out += words[k:end]
            where += places[k:end]
        k = end
    return out, where


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (place in the item, place in the document, words) of two texts given as word hashes."""
    n = min(min_match, len(item))
    if not n:
        return []
    at = np.flatnonzero(np.isin(X.chain(doc, n), X.chain(item, n)))
    numbers: dict[int, int] = {}
    number = lambda w: numbers.setdefault(w, len(numbers) + 1)
    mine = [number(w) for w in item.tolist()]
    # Only the stretches of the document that seeds cover can hold a tile.
    short, where, last = [], [], -1
    for place in at.tolist():
        if place > last and short:
            short.append(0)
            where.append(-1)
        for k in range(max(place, last), place + n):
            short.append(number(int(doc[k])))
            where.append(k)
        last = max(last, place + n)
    short, where = shortened(short, where, Counter(mine))
    return sorted((i, where[j], size) for i, j, size in greedy_tiles(mine, short, n))


def _hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts in lower case, and where those of each begin."""
    texts = X.lower_ascii(X.texts_of(column))
    spans = X.words(texts)
    return X.hash_spans(texts.data, spans.starts, spans.ends), spans.first


def _seed_key(h: np.ndarray, n: int) -> np.ndarray:
    return X.mix(h + _U(n))


def seeds_of(items: DataFrame, min_match: int) -> DataFrame:
    """(item, seed, size) of each distinct seed of the items (item, text)."""

    def run(batches):
        for batch in X.slices(batches, "text"):
            h, first = _hashes(batch.column("text"))
            for n in range(1, min_match + 1):
                # Items of at least min_match words have seeds of that size, shorter ones of their own.
                at, windows = X.windows(h, first, n)
                owner = np.searchsorted(first, at, "right") - 1
                counts = np.diff(first)[owner]
                mine = counts >= n if n == min_match else counts == n
                rows = np.unique(np.stack([owner[mine], X.signed(_seed_key(windows[mine], n))]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(rows[0])), pa.array(rows[1]), pa.array(np.full(rows.shape[1], n))],
                    names=["item", "seed", "size"],
                )

    return items.select("item", "text").mapInArrow(run, "item long, seed long, size long")


def _bits(seeds: DataFrame) -> tuple[np.ndarray, list[int]]:
    """One bit for each seed, by the low bits of its hash, and the sizes of the seeds. 16 MB."""
    place = F.pmod("seed", F.lit(1 << BITMAP_BITS)) + 1
    parts = seeds.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bits = np.zeros(1 << BITMAP_BITS - 3, np.uint8)
    for bucket, part in parts.toLocalIterator():  # of a fixed size in all
        at = (bucket - 1) * len(part)
        bits[at : at + len(part)] = np.frombuffer(part, np.uint8)
    return bits, sorted(r[0] for r in seeds.select("size").distinct().collect())


def suspects(documents: DataFrame, seeds: DataFrame) -> DataFrame:
    """(suspect, doc_id, text, seeds) of the documents with a marked window. Written to the shared folder,
    which settles their numbers."""
    bits, sizes = _bits(seeds)
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in X.slices(batches, "text"):
            h, first = _hashes(batch.column("text"))
            found = [np.zeros((2, 0), np.int64)]
            for n in sizes:
                at, windows = X.windows(h, first, n)
                keys = X.signed(_seed_key(windows, n))
                bit = keys & ((1 << BITMAP_BITS) - 1)
                hit = np.flatnonzero((shared.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                found.append(np.stack([np.searchsorted(first, at[hit], "right") - 1, keys[hit]]))
            rows = np.unique(np.concatenate(found, axis=1), axis=1)
            owner, begin = np.unique(rows[0], return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, rows.shape[1]).astype(np.int32)), pa.array(rows[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)).cast(pa.int64()),
                 batch.column("text").take(pa.array(owner)).cast(pa.string()), lists],
                names=["doc_id", "text", "seeds"],
            )

    found = documents.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, seeds array<long>")
    return held(found.withColumn("suspect", F.monotonically_increasing_id()), "suspects")


def matches(
    documents: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """One row for each document and item whose coverage reaches ``min_coverage``."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    items = held(items.withColumn("item", F.monotonically_increasing_id()), "items")
    seeds = held(seeds_of(items, min_match), "seeds")
    found = suspects(documents, seeds)
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    asked = found.select("suspect", F.explode("seeds").alias("seed")).withColumn(
        "salt", F.pmod(F.xxhash64("suspect"), F.lit(SALTS))
    )
    pairs = asked.join(seeds.select("seed", "item", F.explode(salts).alias("salt")), ["seed", "salt"])
    pairs = pairs.select("suspect", "item").distinct()
    rows = pairs.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item").join(
        found.select("suspect", "doc_id", "text"), "suspect"
    )

    def run(batches):
        schema = pa.schema([
            ("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("covered", pa.int64()),
            ("coverage", pa.float64()),
            ("tiles", pa.list_(pa.struct([("item_at", pa.int64()), ("doc_at", pa.int64()), ("words", pa.int64())]))),
        ])
        for batch in X.slices(batches, "text"):
            (item, item_first), (doc, doc_first) = (_hashes(batch.column(c)) for c in ("item_text", "text"))
            out = []
            for k in range(batch.num_rows):
                mine = item[item_first[k] : item_first[k + 1]]
                tiles = tile(mine, doc[doc_first[k] : doc_first[k + 1]], min_match)
                covered = sum(n for _, _, n in tiles)
                if covered and covered >= min_coverage * len(mine):
                    out.append({
                        "doc_id": batch.column("doc_id")[k].as_py(), "item_id": batch.column("item_id")[k].as_py(),
                        "item_words": len(mine), "covered": covered, "coverage": covered / len(mine),
                        "tiles": [{"item_at": i, "doc_at": j, "words": n} for i, j, n in tiles],
                    })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return rows.select("doc_id", "text", "item_id", "item_text").mapInArrow(run, FOUND)


#: Ids of documents to remove, up to which they are broadcast (8 bytes each).
BROADCAST_IDS = 2_000_000


def clean(documents: DataFrame, benchmark: DataFrame, min_words: int = MIN_MATCH, **options) -> DataFrame:
    """The documents without those that hold a benchmark item in at least ``min_words`` words, or are an item.
    Rows that repeat an id go together if one of them holds an item; a row that is a short item goes alone."""
    gone, covered, short = (fresh(name, documents) for name in ("gone", "covered", "short"))
    found = matches(documents, benchmark, **options).groupBy("doc_id").agg(
        F.max("covered").alias(covered),
        F.collect_set(F.when(F.col("covered") < min_words, F.col("covered"))).alias(short),
    ).withColumnRenamed("doc_id", gone)
    found = held(found, "leaks")
    # Few ids are broadcast, so that the texts stay where they are.
    found = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    words = F.size(F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    removed = (F.col(covered) >= min_words) | F.array_contains(F.col(short), words.cast("long"))
    return documents.join(found, F.col("doc_id").eqNullSafe(F.col(gone)) & removed, "left_anti")
