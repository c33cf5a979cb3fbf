"""Toxic passages by maximum-scoring segment search.

``fit`` counts words in a bounded sample of labelled documents and gives each
the log-odds of its rate in toxic against clean documents, with a Dirichlet
prior in proportion to its overall rate, and pulled towards zero by its
standard error. Every word also pays ``DRIFT``, so clean text has a negative
expected score. A linear-time scan finds all maximal-scoring segments of a
document, and extreme-value statistics (the lambda and K of segment scores in
clean text) say which are significant for its length. Their summed normalised
scores are calibrated to a probability on the same sample.

Defined cases: null, empty and wordless texts have no segment and get the
probability of a text without evidence. Whole texts are read, of any length.
Repeated labels of an id count once, as 1 where they contradict each other.
Labels other than 0 and 1 are ignored. Extra columns are kept; one that is named
like a result column (in any case) gives way to it. Where only one class or none has a labelled document
there is nothing to tell apart, and all texts get the share of label 1 with one
clean document added. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import class_counts, hash_spans, labelled_sample, lowered, renamed, slices, utf8, words

#: About this many labelled documents of each class are read by ``fit``.
PER_CLASS = 12_000
#: Words are hashed into this many bins: bounds the model.
BITS = 18
#: Words of prior weight, and the standard errors by which log-odds are pulled to zero.
PRIOR, ERRORS = 2_000.0, 2.0
DRIFT = 0.12
#: A segment counts if fewer than this many as good are expected in a clean text of that length.
EXPECT = 0.05


def _word_bins(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bin, start, end, row) of each word."""
    data, off = utf8(text)
    data = lowered(data)
    start, end, row = words(data, off)
    return (hash_spans(data, start, end) >> np.uint64(64 - BITS)).astype(np.int64), start, end, row


def segments(before: list[float], after: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) in linear time.

    ``before`` and ``after`` are the running totals around each positive score."""
    found: list[tuple[float, float, int, int, int]] = []  # total before, total after, first, last, link
    for k, (low, high) in enumerate(zip(before, after, strict=True)):
        first, j = k, len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= low:  # nearest to the left that begins lower
                j = found[j][4]
            if j < 0 or found[j][1] >= high:
                found.append((low, high, first, k, j))
                break
            low, _, first, _, link = found[j]
            del found[j:]
            j = link
    return [(first, last, high - low) for low, high, first, last, _ in found]


@dataclass
class Model:
    weight: np.ndarray
    scale: float  # lambda
    k: float
    slope: float = 1.0
    level: float = 0.0

    def normalised(self, score, n_words):
        return self.scale * score - np.log(self.k * np.maximum(n_words, 1))


def _batch_segments(text: pa.Array, m: Model):
    """Per row: (words, [(start byte, end byte, score)]) with bytes counted in the row."""
    bins, start, end, row = _word_bins(text)
    score = m.weight[bins]
    total = np.concatenate([[0.0], np.cumsum(score, dtype=np.float64)])
    hot = np.flatnonzero(score > 0)
    n = len(text)
    count = np.bincount(row, minlength=n)
    cuts = np.searchsorted(row[hot], np.arange(n + 1))
    _, off = utf8(text)
    before, after = total[hot].tolist(), total[hot + 1].tolist()
    out = []
    for r in range(n):
        a, b = cuts[r], cuts[r + 1]
        own = [(int(start[hot[a + i]] - off[r]), int(end[hot[a + j]] - off[r]), s) for i, j, s in segments(before[a:b], after[a:b])] if b > a else []
        out.append((int(count[r]), own))
    return out


def _evidence(n_words: int, own: list, m: Model) -> tuple[float, list]:
    """Summed normalised scores of the significant segments, and those segments."""
    kept = [(a, b, s, e) for a, b, s in own if (e := float(m.normalised(s, n_words))) > -np.log(EXPECT)]
    return sum(e for *_, e in kept), kept


def _log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    both = toxic + clean
    prior = PRIOR * (both + 0.01) / (both + 0.01).sum()
    t, c = toxic + prior, clean + prior
    odds = np.log(t / (t.sum() - t)) - np.log(c / (c.sum() - c))
    error = np.sqrt(1 / t + 1 / c)
    return np.sign(odds) * np.maximum(np.abs(odds) - ERRORS * error, 0)


def _lambda(score: np.ndarray, rate: np.ndarray) -> float:
    """The positive root of sum(rate * exp(x * score)) = 1."""
    if not (score[rate > 0] > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    value = lambda x: float((rate * np.exp(np.minimum(x * score, 500))).sum())
    while value(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and level of a weighted logistic fit, by Newton's method."""
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = weight * (y - p)
        h = weight * p * (1 - p) + 1e-9
        m = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum()]])
        step = np.linalg.solve(m, [(g * x).sum() - 1e-3 * a, g.sum()])
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _squash(evidence: np.ndarray) -> np.ndarray:
    return np.log1p(evidence)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from about ``per_class`` labelled documents of each class."""
    sample = labelled_sample(docs, labels, label, per_class, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for batch in slices(batches, "text"):
            bins, _, _, row = _word_bins(batch.column("text"))
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            # a word counts once per document: one text that repeats it says no more
            key = np.unique(row * (1 << BITS) + bins)
            np.add.at(total, (y[key >> BITS], key & ((1 << BITS) - 1)), 1)
            seen += np.bincount(y, minlength=2)
        for y in (0, 1):
            k = np.flatnonzero(total[y])
            yield pa.record_batch([pa.array(np.full(len(k) + 1, y, np.int32)), pa.array(np.r_[k, -1].astype(np.int32)), pa.array(np.r_[total[y][k], seen[y]])], names=["y", "bin", "n"])

    counts = sample.mapInArrow(count, "y int, bin int, n long").groupBy("y", "bin").agg(F.sum("n").alias("n")).toPandas()  # 2 x 2^BITS rows at most
    table, seen = np.zeros((2, 1 << BITS)), np.zeros(2)
    for y in (0, 1):
        own = counts[counts["y"] == y]
        seen[y] = own.loc[own["bin"] < 0, "n"].sum()
        own = own[own["bin"] >= 0]
        table[y][own["bin"].to_numpy()] = own["n"].to_numpy()
    if not seen.all():
        share = seen[1] / (seen.sum() + 1)
        return Model(np.full(1 << BITS, -DRIFT, np.float32), 1.0, 1.0, 0.0, float(np.log(share / (1 - share)) if share else -40.0))
    weight = _log_odds(table[1], table[0]) - DRIFT
    model = Model(weight.astype(np.float32), _lambda(weight, table[0] / max(table[0].sum(), 1)), 1.0)
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = _batch_segments(batch.column("text"), shared.value)
            top = [max((s for *_, s in own), default=0.0) for _, own in found]
            yield pa.record_batch([batch.column("y"), pa.array([n for n, _ in found], pa.int64()), pa.array(top, pa.float64())], names=["y", "n", "top"])

    # two numbers a document of the bounded sample, however long it is: first to calibrate, then the evidence
    rows = sample.mapInArrow(best, "y int, n long, top double").toPandas()
    clean = rows[rows["y"] == 0]
    model.k = float(len(clean) / np.maximum((np.maximum(clean["n"].to_numpy(), 1) * np.exp(-model.scale * clean["top"].to_numpy())).sum(), 1e-9))
    calibrated = sample.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = _batch_segments(batch.column("text"), calibrated.value)
            yield pa.record_batch([batch.column("y"), pa.array([_evidence(max(n, 1), own, calibrated.value)[0] for n, own in found], pa.float64())], names=["y", "evidence"])

    rows = sample.mapInArrow(weigh, "y int, evidence double").toPandas().sort_values(["y", "evidence"])
    y, evidence = rows["y"].to_numpy(), rows["evidence"].to_numpy()
    # weigh the sampled classes back to their share among all labelled rows
    share = class_counts(labels, label, id_col)
    weight = np.where(y == 1, share[1] / max((y == 1).sum(), 1), share[0] / max((y == 0).sum(), 1))
    model.slope, model.level = _logistic(_squash(evidence), y, weight / weight.mean())
    return model


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: tuple[str, str] = ("score", "passages")) -> DataFrame:
    """All columns of ``docs`` with the probability and the significant
    passages: byte range in the text's UTF-8, score, and log of the expected
    number of as good ones in clean text, negated."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("evidence", pa.float64())]))
    names = [*plain.columns, "p", "passages"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, f"c{at}"):
            found = [_evidence(n, own, m) for n, own in _batch_segments(batch.column(at), m)]
            x = m.slope * _squash(np.array([e for e, _ in found])) + m.level
            passages = [[{"start": a, "end": b, "score": s, "evidence": e} for a, b, s, e in kept] for _, kept in found]
            yield pa.record_batch([*batch.columns, pa.array(1 / (1 + np.exp(-x))), pa.array(passages, kind)], names=names)

    added = T.StructType.fromDDL("p double, passages array<struct<start:long,end:long,score:double,evidence:double>>").fields
    return renamed(plain.mapInArrow(run, T.StructType([*plain.schema.fields, *added])), docs.columns, out)
