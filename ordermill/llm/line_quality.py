"""Quality by line: a linear-chain CRF marks each line as content or boilerplate.

Each line with a word is described by a few numbers (length, case, marks, repeated words, …). The
conditional random field has one weight vector per label and one weight per pair of neighbouring
labels; Viterbi decoding finds the best labelling of a text as a whole. A document is kept if at
least ``share`` of its words lie in content lines and it passes two plain rules on its words.

Training: labels are given for documents only, so those of lines are latent. The weights start from the
documents' labels, line by line. Then expectation and maximisation take turns, a gradient step each: the lines
of a text get the probabilities the model gives them under a constraint on the text, that lines of a good
document hold at least ``LEAST`` of its words as content and those of a bad one at most ``MOST``, with lines
that repeat in their document leaning to boilerplate; the weights, pairs included, then follow these
probabilities. So a clean line of a bad document is learnt as content and a bad line of a good one as
boilerplate. At most ``max_rows`` labelled documents are used (the lowest hashes of the id), of each at most
``WINDOWS`` stretches of ``WINDOW`` lines, spread evenly over it; decoding covers every line of every text.

Null and empty texts have no word, so they are not kept. Repeated rows are judged alike, and other columns,
whatever their names, are kept as they are. Labels that are null are not learnt from; without both kinds of
label every line is content.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import text as X

MAX_ROWS = 4_000
WINDOW, WINDOWS = 64, 4
LEAST, MOST = 0.9, 0.3
FEATURES = 16
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_MARK = np.isin(_BYTE, list(b"!?.,;:"))
_END = np.isin(_BYTE, list(b".!?:\"'"))


@dataclass(frozen=True)
class Crf:
    """Scores of label 1 (content) against label 0, and of each pair of neighbouring labels."""

    weights: np.ndarray
    pairs: np.ndarray

    def decode(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best labels of every line; the texts advance together, longest first."""
        unary = features @ self.weights
        counts = np.diff(first)
        order = np.argsort(-counts, kind="stable")
        begin = first[:-1][order]
        alive = np.searchsorted(-counts[order], -np.arange(1, counts.max(initial=0) + 1), "right")
        best = np.zeros((len(order), 2))
        back = np.zeros((len(unary), 2), np.int8)
        for t, n in enumerate(alive):
            at = begin[:n] + t
            if t:
                step = best[:n, :, None] + self.pairs[None]
                back[at] = step.argmax(axis=1)
                best[:n] = step.max(axis=1)
            best[:n, 1] += unary[at]
        labels = np.zeros(len(unary), np.int8)
        state = best.argmax(axis=1)
        for t in range(len(alive) - 1, -1, -1):
            n = alive[t]
            at = begin[:n] + t
            ends = counts[order[:n]] == t + 1
            state[:n] = np.where(ends, best[:n].argmax(axis=1), state[:n])
            labels[at] = state[:n]
            state[:n] = back[at, state[:n]]
        return labels


@dataclass
class Described:
    """What is known of each text and each of its lines with a word."""

    lines: X.Spans
    features: np.ndarray
    line_words: np.ndarray
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def describe(texts: X.Texts) -> Described:
    data = texts.data
    words = X.words(texts)
    lines = X.lines(texts)
    w_first = np.searchsorted(words.starts, lines.starts)
    w_last = np.searchsorted(words.starts, lines.ends)
    some = w_last > w_first
    owner = lines.owner()[some]
    lines = X.Spans(lines.starts[some], lines.ends[some], np.searchsorted(owner, np.arange(len(texts) + 1)))
    w_first, w_last = w_first[some], w_last[some]
    hashes = X.hash_spans(data, words.starts, words.ends)
    line_hash = X.with_owner(X.hash_spans(data, lines.starts, lines.ends), owner)
    repeated = _later(line_hash)

    def total(kind: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(kind)])

    def inside(kind: np.ndarray) -> np.ndarray:
        c = total(kind)
        return (c[lines.ends] - c[lines.starts]).astype(float)

    n_words = (w_last - w_first).astype(float)
    size = np.maximum(inside(X.LEAD[data] & ~X.SPACE[data]), 1.0)
    upper, lower = inside(_UPPER[data]), inside(_LOWER[data])
    line_of_word = np.repeat(np.arange(len(n_words)), (w_last - w_first))
    in_line = X.with_owner(hashes[X.ranges(w_first, w_last - w_first)], line_of_word)
    distinct = n_words - np.bincount(line_of_word, weights=_later(in_line), minlength=len(n_words))
    symbols, marks = inside(_SYMBOL[data]), inside(_MARK[data])
    nth = np.arange(len(n_words)) - lines.first[owner]
    left = np.diff(lines.first)[owner] - 1 - nth
    features = np.stack(
        [
            np.ones(len(n_words)), np.log1p(n_words), np.minimum(size / n_words, 20) / 10,
            upper / np.maximum(upper + lower, 1), inside(_DIGIT[data]) / size, np.minimum(symbols / n_words, 3),
            symbols / size, np.minimum(marks / n_words, 3), inside(data == 33) / n_words,
            inside(data == 124) / n_words, distinct / n_words, (distinct / n_words < 0.5) * 1.0,
            _END[data[lines.ends - 1]] * 1.0, repeated * 1.0, (nth == 0) * 1.0, (left == 0) * 1.0,
        ],
        axis=1,
    )
    at, windows = X.windows(hashes, words.first, 8)
    word_owner = words.owner()
    _, code, count = np.unique(
        X.with_owner(windows, word_owner[at]), return_inverse=True, return_counts=True
    )
    twice = at[count[code] > 1] if len(at) else at
    cover = np.zeros(len(hashes) + 9, np.int64)
    cover[twice] += 1
    cover[twice + 8] -= 1
    n_texts = len(texts)
    return Described(
        lines, features, n_words, words.counts.astype(np.int64),
        np.diff(total(X.LEAD[data] & ~X.SPACE[data])[texts.offsets]), np.diff(total(_SYMBOL[data])[texts.offsets]),
        np.bincount(owner, weights=repeated, minlength=n_texts).astype(np.int64),
        X.segment_sums(np.cumsum(cover)[: len(hashes)] > 0, words.first),
    )


def _later(keys: np.ndarray) -> np.ndarray:
    """True where an earlier entry has the same key."""
    out = np.ones(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = False
    return out


def stretches(n: int, window: int = WINDOW, windows: int = WINDOWS) -> list[tuple[int, int]]:
    """The stretches of ``n`` lines that are learnt from: all lines where they fit, else spread evenly."""
    if n <= window * windows:
        return [(a, min(a + window, n)) for a in range(0, n, window)]
    return [(a, a + window) for a in np.linspace(0, n - window, windows).astype(int).tolist()]


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Crf | None:
    """Learns the weights from labelled documents; None without both kinds of label."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    # As many of either kind, so that the weights say how lines differ and not how rare one kind is.
    lowest = lambda good: chosen.where(F.col("quality") > 0 if good else F.col("quality") <= 0).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2)
    sample = lowest(True).unionByName(lowest(False))
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches):
        for batch in X.slices(batches, "text"):
            d = describe(X.texts_of(batch.column("text")))
            at, blobs = [], []
            for i, n in enumerate(d.lines.counts.tolist()):
                for a, z in stretches(n):
                    at.append(i)
                    blobs.append(d.features[d.lines.first[i] + a : d.lines.first[i] + z].astype("<f4").tobytes())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at).cast(pa.int64()), batch.column("quality").take(at).cast(pa.int32()),
                 pa.array(blobs, pa.binary())],
                names=["doc_id", "quality", "features"],
            )

    found = rows.mapInArrow(run, "doc_id long, quality int, features binary").orderBy("doc_id", "features").collect()
    good = np.array([r["quality"] > 0 for r in found], bool)
    if not good.any() or good.all():
        return None
    return train([np.frombuffer(r["features"], "<f4").reshape(-1, FEATURES) for r in found], good)


class Chains:
    """Texts of given numbers of lines, longest first, that advance together line by line."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.alive = np.searchsorted(-counts, -np.arange(1, int(counts.max()) + 1), "right")

    def marginals(self, unary: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probability of label 1 for each line, and how often each pair of labels is expected."""
        forward, backward = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
        for k, n in enumerate(self.alive):
            at = self.first[:-1][:n] + k
            if k:
                forward[at] = _soft(forward[at - 1][:, :, None] + pairs[None], 1)
            forward[at, 1] += unary[at]
        z = _soft(forward[self.first[1:] - 1], 1)
        both = np.zeros(4)
        for k in range(len(self.alive) - 2, -1, -1):
            n = self.alive[k + 1]
            at = self.first[:-1][:n] + k
            ahead = backward[at + 1].copy()
            ahead[:, 1] += unary[at + 1]
            path = pairs[None] + ahead[:, None, :]
            backward[at] = _soft(path, 2)
            both += np.exp(forward[at][:, :, None] + path - z[:n, None, None]).sum(axis=0).reshape(-1)
        return np.exp(forward[:, 1] + backward[:, 1] - np.repeat(z, self.counts)), both


def train(
    features: list[np.ndarray], good: np.ndarray, rounds: int = 100, warm: int = 30, penalty: float = 1e-3,
    least: float = LEAST, most: float = MOST,
) -> Crf:
    """Weights by Adam steps. For ``warm`` rounds every line has its text's label and neighbours do not
    count; then lines have the probabilities of the constrained model."""
    counts = np.array([len(f) for f in features])
    order = np.argsort(-counts, kind="stable")
    features, good, counts = [features[i] for i in order], good[order], counts[order]
    flat = np.concatenate(features).astype(float)
    chains = Chains(counts)
    words = np.expm1(flat[:, 1])
    seeds = np.where(flat[:, 13] > 0, -2.0, 0.0)
    total = X.segment_sums(words, chains.first)
    given = np.repeat(good.astype(float), counts)
    # How much each text leans to one label so as to meet its constraint.
    lean = np.zeros(len(counts))
    theta = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        unary, pairs = flat @ theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
        p, both = chains.marginals(unary, pairs)
        if t <= warm:
            wanted, wanted_both = given, both
        else:
            wanted, wanted_both = chains.marginals(unary + seeds + np.repeat(lean, counts), pairs)
            share = X.segment_sums(wanted * words, chains.first) / total
            lean = np.clip(lean + 2 * (np.where(good, least, most) - share), -5, 5)
            lean = np.where(good, np.maximum(lean, 0), np.minimum(lean, 0))
        grad = np.concatenate([flat.T @ (p - wanted), both - wanted_both]) / len(flat) + penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-10)
    return Crf(theta[:FEATURES], theta[FEATURES:].reshape(2, 2))


def _soft(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double, labels string"
)


def judge(documents: DataFrame, crf: Crf | None, share: float = 0.5) -> DataFrame:
    """One row per document: the counts, both verdicts, the share of words in content lines and the
    label of each line with a word, ``c`` or ``b``, in order."""

    def run(batches):
        for batch in X.slices(batches, "text"):
            d, label, part, failed = _verdicts(batch, crf)
            text = np.where(label == 1, ord("c"), ord("b")).astype(np.uint8).tobytes().decode()
            labels = [text[a:b] for a, b in zip(d.lines.first[:-1], d.lines.first[1:], strict=True)]
            columns = [d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words, failed,
                       ~failed & (part >= share), part]
            names = [f.split()[0] for f in JUDGED.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c) for c in columns] + [pa.array(labels, pa.string())],
                names=names,
            )

    return documents.select("doc_id", "text").mapInArrow(run, JUDGED)


def _verdicts(batch: pa.RecordBatch, crf: Crf | None) -> tuple[Described, np.ndarray, np.ndarray, np.ndarray]:
    """What is known of the texts, the labels of their lines, the share of content words, and which
    of them fail the plain rules."""
    texts = X.texts_of(batch.column("text"))
    d = describe(texts)
    label = np.ones(len(d.line_words), np.int8) if crf is None else crf.decode(d.features, d.lines.first)
    content = np.bincount(d.lines.owner(), weights=label * d.line_words, minlength=len(texts))
    failed = (d.n_words < 20) | (100 * d.n_repeat_words > 30 * d.n_words)
    return d, label, content / np.maximum(d.n_words, 1), failed


def keep(documents: DataFrame, crf: Crf | None, share: float = 0.5) -> DataFrame:
    """The rows whose text is kept, with all their columns. Rows are filtered where they are read."""

    def run(batches):
        for batch in X.slices(batches, "text", 1 << 20):
            _, _, part, failed = _verdicts(batch, crf)
            X.release()
            yield batch.filter(pa.array(~failed & (part >= share)))

    return documents.mapInArrow(run, documents.schema)
