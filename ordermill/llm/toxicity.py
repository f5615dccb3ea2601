"""Toxicity scores by a linear classifier over character n-grams, scaled by naive Bayes ratios.

Features are the character n-grams (lower case, runs of white space as one space, a space at either
end) present in a text, hashed to 2**20 places. From the labelled rows each feature gets the
log-count ratio r = log((p + 1) / P) - log((n + 1) / N) of its document counts in either class; a
logistic regression is then fitted on presence times r. Features seen too rarely, or whose ratio is
within what chance gives, are left out, so that long texts don't gather noise.

The fit uses at most ``max_rows`` labelled rows (those with the lowest hash of their id), collected
as features only; scores read every whole text. Null and empty texts have no feature and get the
score of the intercept. Rows without a label, or with a null one, are not learnt from; an id
labelled twice counts as toxic if one label says so. With one class only the score is that class's
smoothed share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as X
from ordermill.llm.store import held

ORDERS = (4, 5, 6)
HASH_BITS = 20
MAX_ROWS = 12_000
#: Text taken at once: its n-grams take a hundred times as much.
SLICE_BYTES = 1 << 20
_U = np.uint64
_SPACES = re.compile(r"\s+")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        total = np.full(len(texts), self.intercept)
        for owner, place in features(texts):
            w = self.weights[place]
            hit = np.flatnonzero(w)
            pairs = X.distinct((owner[hit].astype(np.int64) << HASH_BITS) | place[hit])
            total += np.bincount(
                pairs >> HASH_BITS, weights=self.weights[pairs & ((1 << HASH_BITS) - 1)], minlength=len(texts)
            )
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def features(texts: list[str | None], orders: tuple[int, ...] = ORDERS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the text and the hashed place of every n-gram. Texts stand apart by zeros, so
    that n-grams at a text's end are its own whatever follows."""
    clean = [f" {_SPACES.sub(' ', t.lower()).strip()} " if t and not t.isspace() else "" for t in texts]
    most = max(orders)
    gap = "\0" * (most - 1)
    points = np.frombuffer(gap.join([*clean, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
    lengths = np.array([len(t) for t in clean], np.int64)
    begins = np.cumsum(lengths + most - 1) - (lengths + most - 1)
    at = X.ranges(begins, lengths)
    owner = np.repeat(np.arange(len(clean)), lengths)
    h = np.zeros(len(points), _U)
    for k in range(1, most + 1):
        n = len(points) - k + 1
        if n <= 0:
            return
        h = h[:n] * _U(0x100000001B3) + points[k - 1 :] + _U(1)
        if k in orders:
            place = ((h[at] ^ (h[at] >> _U(29))) * _U(0x9E3779B97F4A7C15)) >> _U(64 - HASH_BITS)
            yield owner, place.astype(np.int64)


def present(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place) pairs."""
    keys = [(owner.astype(np.int64) << HASH_BITS) | place for owner, place in features(texts)]
    pairs = X.distinct(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return pairs >> HASH_BITS, pairs & ((1 << HASH_BITS) - 1)


def training_rows(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """toxic and text of at most ``max_rows`` labelled documents, the lowest hashes first."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = 20_000) -> Model:
    """Learns from the labelled documents. Two passes over them: document counts of each place,
    then the chosen features of each document, which is all the driver holds."""
    spark = documents.sparkSession
    rows = held(training_rows(documents, labels, max_rows), "toxic-rows")
    size = 1 << HASH_BITS

    def count(batches):
        total = np.zeros((2, size), np.int32)
        for batch in batches:
            for part in X.slices(iter([batch]), "text", SLICE_BYTES):
                toxic = np.asarray(part.column("toxic")).astype(np.int64) > 0
                owner, place = present(part.column("text").to_pylist())
                for k in (0, 1):
                    total[k] += np.bincount(place[toxic[owner] == k], minlength=size).astype(np.int32)
        some = np.flatnonzero(total.sum(axis=0) > 0)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])],
                                         names=["place", "clean", "toxic"])

    classes = {bool(r[0]): r[1] for r in rows.groupBy(F.col("toxic") > 0).count().collect()}
    clean_rows, toxic_rows = classes.get(False, 0), classes.get(True, 0)
    if not clean_rows or not toxic_rows:
        return Model(np.zeros(size, np.float32), float(np.log((toxic_rows + 1) / (clean_rows + 1))))
    counts = rows.mapInArrow(count, "place long, clean int, toxic int").groupBy("place").agg(
        F.sum("clean").alias("n"), F.sum("toxic").alias("p")
    )
    ratio = F.log((F.col("p") + 1) / F.lit(float(toxic_rows + 1))) - F.log((F.col("n") + 1) / F.lit(float(clean_rows + 1)))
    spread = F.sqrt(1 / (F.col("p") + 1) + 1 / (F.col("n") + 1))
    best = (
        counts.where("p + n >= 5").withColumn("r", ratio).withColumn("z", F.abs(ratio) / spread)
        .where("z >= 4").orderBy(F.desc("z"), "place").limit(max_features).select("place", "r").collect()
    )
    r = np.zeros(size, np.float32)
    for place, value in best:
        r[place] = value
    shared = spark.sparkContext.broadcast(r)

    def chosen(batches):
        r = shared.value
        for batch in batches:
            for part in X.slices(iter([batch]), "text", SLICE_BYTES):
                owner, place = present(part.column("text").to_pylist())
                mine = r[place] != 0
                owner, place = owner[mine], place[mine]
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
                blobs = [place[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic").cast(pa.int32()), pa.array(blobs, pa.binary())],
                    names=["doc_id", "toxic", "places"],
                )

    found = rows.mapInArrow(chosen, "doc_id long, toxic int, places binary").orderBy("doc_id").collect()
    places = [np.frombuffer(x["places"], "<i4") for x in found]
    owner = np.repeat(np.arange(len(found)), [len(p) for p in places])
    weights, intercept = logistic(owner, np.concatenate(places), r, np.array([x["toxic"] > 0 for x in found], float))
    return Model((weights * r).astype(np.float32), intercept)


def logistic(
    owner: np.ndarray, place: np.ndarray, r: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 150
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on presence times r, by Adam steps."""
    used, column = np.unique(place, return_inverse=True)
    value = r[place].astype(np.float64)
    w, n = np.zeros(len(used)), len(y)
    b = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = b + np.bincount(owner, weights=value * w[column], minlength=n)
        g = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / n
        gw = np.bincount(column, weights=value * g[owner], minlength=len(used)) + penalty * w
        gb = g.sum()
        m, mb = 0.9 * m + 0.1 * gw, 0.9 * mb + 0.1 * gb
        v, vb = 0.99 * v + 0.01 * gw * gw, 0.99 * vb + 0.01 * gb * gb
        a, c = 1 - 0.9**t, 1 - 0.99**t
        w = w - 0.02 * (m / a) / (np.sqrt(v / c) + 1e-10)
        b = b - 0.05 * (mb / a) / (np.sqrt(vb / c) + 1e-10)
    full = np.zeros(len(r))
    full[used] = w
    return full, float(b)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in X.slices(batches, "text", SLICE_BYTES):
            X.release()
            s = shared.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
