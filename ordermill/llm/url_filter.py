"""URL verdicts by rules, and by a character language-model ratio where no rule fits.

A rule names a host and the beginning of a path; it fits the host and its subdomains, and the
longest rule wins. URLs with a rule train two variable-order Markov models of their bytes, one for
accepted and one for rejected URLs. A model mixes contexts of 0 to ``ORDER`` bytes by Witten-Bell
smoothing: contexts seen often decide, others lean on shorter ones. A URL without a rule is allowed
if log P(url | accepted) - log P(url | rejected), divided by its length, reaches a threshold. The
threshold is calibrated on a fifth of the ruled URLs (by hash), which the models don't learn from,
to give both kinds of error the same weight.

Counts are exact: a context and the byte after it are one number of 51 bits. URLs become blocks, stored
once; the distinct numbers of each block move to the segment of their context, where the counts add
up, and the counts go back to the blocks that asked. Nothing of the model is broadcast, and segments
follow the data. A block sends at most ``FAN`` messages; if there are more segments, they go to ranges of
segments, where those of up to ``FAN`` blocks are added up first, so that messages grow with the input and a
context that all blocks have arrives from each ``FAN`` of them once.

A null URL, or one without ``://``, has empty host and path, fits no rule and is scored as it is (null
as empty text). Repeated URLs count each. Without ruled URLs of both kinds the verdict is allow. Other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as X
from ordermill.llm.bloom_lm import from_planes, planes
from ordermill.llm.store import held

ORDER = 5
BLOCK_BYTES = 1 << 18
KEYS_A_SEGMENT = 1 << 21
FAN = 8_192
BINS = 4_000
_U = np.uint64


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


#: The production rules.
RULES = (
    Rule("com", "/", True),
    Rule("example.com", "/en/", False),
    Rule("www.example.com", "/en/", True),
    Rule("net", "/es/", False),
    Rule("net", "/fr/", False),
)


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``."""
    has = F.coalesce(F.instr("url", "://") > 0, F.lit(False))
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.when(has, host).otherwise(""), "path": F.when(has, path).otherwise("")})


def matched(rules: tuple[Rule, ...]) -> Column:
    """The text of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = (
            ((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host)))
            & F.startswith(F.col("path"), F.lit(r.path))
        )
        out = F.when(fits, F.lit(r.text)).otherwise(out)
    return out


@dataclass(frozen=True)
class Table:
    """Numbers by class for keys in order; 0 for other keys."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' columns in ``values``, of which the last is for keys that are missing."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == keys, at, len(self.keys)) if len(self.keys) else at

    def __getitem__(self, which: tuple) -> np.ndarray:
        kind, _, keys = which
        return self.values[kind, self.find(keys)]


@dataclass(frozen=True)
class Model:
    """Counts of (context, byte), of contexts, and how many different bytes followed a context, by
    class, order and key; the calibrated threshold."""

    pairs: Table
    contexts: Table
    kinds: Table
    threshold: float

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, threshold: float = 0.0) -> Model:
        """From distinct pairs in order and, for each, the counts of the pair in either class, those
        of its context, and the kinds of bytes after that."""
        full = np.concatenate([counts.astype(np.float64), np.zeros((6, 1))], axis=1)
        context, first = np.unique(keys >> _U(8), return_index=True)
        first = np.append(first, len(keys))
        return cls(Table(keys, full[:2]), Table(context, full[2:4, first]), Table(context, full[4:, first]), threshold)

    def log_probabilities(self, texts: X.Texts) -> np.ndarray:
        """Natural log of the probability of each text and its end, in either class."""
        at = trace(texts)
        p = np.full((2, len(at.owner)), 1 / 256)
        for k in range(ORDER + 1):
            slot, pair = at.slots(k)
            place, found = self.contexts.find(slot), self.pairs.find(pair)
            n, t = self.contexts.values[:, place], self.kinds.values[:, place]
            seen = n > 0
            mixed = (self.pairs.values[:, found] + t * p) / np.where(seen, n + t, 1)
            p = np.where(seen, mixed, p)
        return np.stack([np.bincount(at.owner, weights=np.log(x), minlength=len(texts)) for x in p])

    def ratio(self, texts: X.Texts) -> np.ndarray:
        """Difference of the log-likelihoods per byte (the end counts as one)."""
        rejected, accepted = self.log_probabilities(texts)
        return (accepted - rejected) / (np.diff(texts.offsets) + 1)


@dataclass(frozen=True)
class Trace:
    """Every byte of some texts and each text's end (0), with what stands before it."""

    points: np.ndarray
    at: np.ndarray
    owner: np.ndarray

    def slots(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The order and the ``order`` bytes before each byte as one number, and that with the byte."""
        h = np.full(len(self.at), _U(order))
        for j in range(ORDER, 0, -1):
            h = (h << _U(8)) | (self.points[self.at - j] if j <= order else _U(0))
        return h, (h << _U(8)) | self.points[self.at]


def trace(texts: X.Texts) -> Trace:
    n, sizes = len(texts), np.diff(texts.offsets)
    begin = np.cumsum(sizes + ORDER + 1) - sizes - 1
    points = np.zeros(int(sizes.sum()) + n * (ORDER + 1) + ORDER, _U)
    points[X.ranges(begin, sizes)] = texts.data
    return Trace(points, X.ranges(begin, sizes + 1), np.repeat(np.arange(n), sizes + 1))


BLOCKS = (
    "block long, page_ids array<long>, urls array<string>, rules array<string>, allow array<boolean>, "
    "learns array<boolean>, calibrates array<boolean>, points long, accepted long, rejected long"
)


def blocks_of(rows: DataFrame) -> DataFrame:
    """Stored rows of about ``BLOCK_BYTES`` of URLs, of (page_id, url, rule, allow); without a rule, allow is null."""
    ruled = F.col("allow").isNotNull() & F.col("url").isNotNull()
    fifth = F.pmod(F.crc32("url"), F.lit(5)) == 0
    rows = rows.withColumns({"learns": F.coalesce(ruled & ~fifth, F.lit(False)), "calibrates": F.coalesce(ruled & fifth, F.lit(False))})

    def run(batches):
        import pyspark

        block = pyspark.TaskContext.get().partitionId() << 24
        for batch in X.slices(batches, "url", BLOCK_BYTES):
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "rule", "allow", "learns", "calibrates")]
            learnt = [a for a, learns in zip(columns[3], columns[4], strict=True) if learns]
            points = int(X.texts_of(batch.column("url")).offsets[-1]) + batch.num_rows
            kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), *(pa.array([c], pa.list_(kind)) for c, kind in zip(columns, kinds, strict=True)),
                 pa.array([points]), pa.array([sum(learnt)], pa.int64()), pa.array([len(learnt) - sum(learnt)], pa.int64())],
                names=["block", "page_ids", "urls", "rules", "allow", "learns", "calibrates", "points", "accepted", "rejected"],
            )
            block += 1

    return held(rows.select("page_id", "url", "rule", "allow", "learns", "calibrates").mapInArrow(run, BLOCKS), "url-blocks")


def _width(segments: int) -> int:
    """Segments in one range that blocks send to."""
    return -(-segments // FAN)


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    """The segment of a pair, by its context."""
    return (X.mix(keys >> _U(8)) % _U(segments)).astype(np.int64)


def _asked(at: Trace, segments: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of all orders in order, their order by range, and where ranges begin there."""
    keys = np.concatenate([X.distinct(at.slots(k)[1]) for k in range(ORDER + 1)])
    range_ = _segment(keys, segments) // width
    order = np.argsort(range_, kind="stable")
    return keys, order, np.searchsorted(range_[order], np.arange(-(-segments // width) + 1))


def _messages(sender: int, keys: np.ndarray, counts: np.ndarray, order: np.ndarray, cuts: np.ndarray, first: int = 0):
    """Range or segment, sender, keys there and their counts in either class."""
    some = np.flatnonzero(np.diff(cuts))
    parts = [order[cuts[s] : cuts[s + 1]] for s in some]
    return pa.RecordBatch.from_arrays(
        [pa.array(some + first), pa.array([sender] * len(some), pa.int64()),
         pa.array([planes(np.diff(keys[p], prepend=_U(0)), 8) for p in parts], pa.binary()),
         pa.array([planes(counts[:, p].ravel(), 4) for p in parts], pa.binary())],
        names=["segment", "block", "keys", "counts"],
    )


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of several messages, their counts, the place among them of each pair of each message,
    and where those of each message begin."""
    each = [np.cumsum(from_planes(k, 8)) for k in table["keys"].to_pylist()]
    sums = np.concatenate([from_planes(c, 4).reshape(2, -1) for c in table["counts"].to_pylist()], axis=1)
    keys, code = np.unique(np.concatenate(each), return_inverse=True)
    pairs = np.stack([np.bincount(code, weights=x, minlength=len(keys)) for x in sums]).astype(np.int64)
    return keys, pairs, code, np.cumsum([0] + [len(k) for k in each])


def counted(blocks: DataFrame, segments: int) -> DataFrame:
    """Stored answers: for each block and range the six counts (see ``Model.of``) of the block's
    distinct pairs there, in their order."""
    width = _width(segments)
    sent_schema, schema = "segment long, block long, keys binary, counts binary", "block long, segment long, counts binary"

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = trace(X.texts_of(pa.array(row["urls"], pa.string())))
                keys, order, cuts = _asked(at, segments, width)
                kind = np.array([2 if not learns else int(a) for a, learns in zip(row["allow"], row["learns"], strict=True)])[at.owner]
                counts = np.zeros((2, len(keys)), np.int64)
                for k in range(ORDER + 1):
                    pair = at.slots(k)[1]
                    for c in (0, 1):
                        seen, n = np.unique(pair[kind == c], return_counts=True)
                        counts[c, np.searchsorted(keys, seen)] += n
                yield _messages(row["block"], keys, counts, order, cuts)

    def split(table: pa.Table) -> pa.Table:
        keys, pairs, _, _ = _added(table)
        first = table["segment"][0].as_py() * width
        segment = _segment(keys, segments) - first
        order = np.argsort(segment, kind="stable")
        cuts = np.searchsorted(segment[order], np.arange(width + 1))
        return pa.Table.from_batches([_messages(table["asker"][0].as_py(), keys, pairs, order, cuts, first)])

    def answer(table: pa.Table) -> pa.Table:
        keys, pairs, code, at = _added(table)
        first = np.flatnonzero(np.diff(keys >> _U(8), prepend=_U(0xFFFFFFFFFFFFFFFF)))
        size = np.diff(np.append(first, len(keys)))
        contexts = [np.repeat(np.add.reduceat(x, first, axis=1), size, axis=1) for x in (pairs, (pairs > 0).astype(np.int64))]
        full = np.concatenate([pairs, *contexts])[:, code]
        return pa.table({
            "block": table["block"], "segment": table["segment"],
            "counts": pa.array([planes(full[:, a:z].ravel(), 8) for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary()),
        })

    def dealt(table: pa.Table, answers: pa.Table) -> pa.Table:
        keys, _, code, at = _added(table)
        order = np.argsort(_segment(keys, segments), kind="stable")
        parts = sorted(zip(answers["part"].to_pylist(), answers["counts"].to_pylist(), strict=True))
        full = np.empty((6, len(keys)), np.uint64)
        full[:, order] = np.concatenate([from_planes(c, 8).reshape(6, -1) for _, c in parts], axis=1)
        full = full[:, code]
        return pa.table({
            "block": table["block"], "segment": table["segment"],
            "counts": pa.array([planes(full[:, a:z].ravel(), 8) for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary()),
        })

    asked = blocks.mapInArrow(ask, sent_schema)
    if width == 1:
        return held(asked.groupBy("segment").applyInArrow(answer, schema), "url-counts")
    askers = max(1, -(-blocks.count() // FAN))
    asked = held(asked.withColumn("asker", F.pmod(F.xxhash64("block"), F.lit(askers))), "url-asked")
    merged = asked.groupBy("segment", "asker").applyInArrow(split, sent_schema)
    answers = merged.groupBy("segment").applyInArrow(answer, schema).select(
        F.col("block").alias("to"), F.floor(F.col("segment") / width).alias("range"), F.col("segment").alias("part"), "counts"
    )
    return held(
        asked.groupBy("segment", "asker").cogroup(answers.groupBy("range", "to")).applyInArrow(dealt, schema), "url-counts"
    )


def _with_answers(blocks: DataFrame, segments: int) -> DataFrame:
    got = counted(blocks, segments).groupBy("block").agg(F.collect_list(F.struct("segment", "counts")).alias("answers"))
    return blocks.join(got, "block")


def _part(row: dict, segments: int, width: int) -> tuple[X.Texts, np.ndarray, np.ndarray]:
    """The URLs of a block with its answers, their distinct pairs and the counts of these."""
    texts = X.texts_of(pa.array(row["urls"], pa.string()))
    keys, order, _ = _asked(trace(texts), segments, width)
    counts = np.empty((6, len(keys)), np.int64)
    got = sorted(row["answers"], key=lambda a: a["segment"])
    counts[:, order] = np.concatenate([from_planes(a["counts"], 8).reshape(6, -1) for a in got], axis=1)
    return texts, keys, counts


def _size(blocks: DataFrame) -> tuple[int, bool]:
    """Segments to use, and whether URLs of both kinds are there to learn from."""
    points, accepted, rejected = (x or 0 for x in blocks.agg(F.sum("points"), F.sum("accepted"), F.sum("rejected")).first())
    return max(8, points * (ORDER + 1) // KEYS_A_SEGMENT), accepted > 0 and rejected > 0


SCORED = "page_id long, url string, rule string, allow boolean, calibrates boolean, ratio double"


def scored(blocks: DataFrame, segments: int, learnt: bool) -> DataFrame:
    """The rows of the blocks with their ratio, stored."""
    width = _width(segments)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if learnt:
                    texts, keys, counts = _part(row, segments, width)
                    ratio = Model.of(keys, counts).ratio(texts)
                else:
                    ratio = np.zeros(len(row["urls"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["page_ids"], pa.int64()), pa.array(row["urls"], pa.string()), pa.array(row["rules"], pa.string()),
                     pa.array(row["allow"], pa.bool_()), pa.array(row["calibrates"], pa.bool_()), pa.array(ratio)],
                    names=["page_id", "url", "rule", "allow", "calibrates", "ratio"],
                )

    return held((_with_answers(blocks, segments) if learnt else blocks).mapInArrow(run, SCORED), "url-scored")


def calibrated(rows: DataFrame) -> float:
    """The threshold that gives both kinds of error the same weight, to the width of one of ``BINS`` equal
    bins between the least and the greatest ratio of the URLs it is calibrated on."""
    known = rows.where("calibrates")
    low, high = known.agg(F.min("ratio"), F.max("ratio")).first()
    if low is None or low == high:
        return low or 0.0
    width = (high - low) / BINS
    bin_ = F.least(F.lit(BINS - 1), F.floor((F.col("ratio") - low) / width)).cast("int")
    found = np.zeros((2, BINS))
    for r in known.groupBy("allow", bin_.alias("bin")).agg(F.count("*").alias("n")).collect():
        found[int(r["allow"]), r["bin"]] = r["n"]
    share = np.cumsum(found, axis=1) / np.maximum(found.sum(axis=1, keepdims=True), 1)
    # Below the start of bin b: accepted URLs lost, and rejected ones caught.
    below = np.concatenate([[[0.0], [0.0]], share], axis=1)
    errors = below[1] + 1 - below[0]
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(low + best[len(best) // 2] * width)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the ratio of every page."""
    known = with_parts(pages.select("page_id", "url")).withColumn("rule", matched(rules))
    allows = F.lit(False)
    for r in rules:
        if r.allow:
            allows = allows | (F.col("rule") == r.text)
    blocks = blocks_of(known.select("page_id", "url", "rule", F.when(F.col("rule").isNotNull(), allows).alias("allow")))
    segments, learnt = _size(blocks)
    rows = scored(blocks, segments, learnt)
    fits = F.col("ratio") >= (calibrated(rows) if learnt else 0.0)
    return with_parts(rows).select(
        "page_id", "host", "path", "rule",
        F.when(F.coalesce("allow", fits), "allow").otherwise("block").alias("verdict"),
        "ratio",
    )
