"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of a whole text is encoded
(byte classes, hashed byte pairs, word statistics), a gated attention network
weighs the passages, and the weighted passage representation is scored. All
weights are learned from document labels alone, on a bounded sample, by
stochastic gradient steps over whole bags.

Defined cases: a null, empty or blank text is one passage without content, and
is scored like any other. Whole texts are read, of any length. Repeated labels
of an id count once, as 1 where they contradict each other; labels other than 0
and 1 are ignored. Extra columns are kept; one that is named like a result column
(in any case) gives way to it. Where only one class or none has a labelled document there is nothing to
tell apart, and all texts get the share of label 1 with one good document
added. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import class_counts, hash_spans, labelled_sample, renamed, slices, utf8, words

#: About this many labelled documents of each class are read by ``fit``.
PER_CLASS = 4_000
PASSAGE_WORDS = 64
PAIRS, CLASSES = 192, 16
#: Byte classes, byte pairs, and five word statistics.
FEATURES = CLASSES + PAIRS + 5
HIDDEN, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY = 20, 64, 4e-3, 1e-4

_CLASS = np.full(256, 0, np.int64)
for _bytes, _k in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (range(128, 256), 4), ((32,), 5), ((10, 13), 6), ((9, 11, 12), 7)):
    _CLASS[list(_bytes)] = _k
for _k, _mark in enumerate((".,;:", "!", "?", "|", "#*", "$%&", "<>/=", "@_-"), 8):
    _CLASS[list(_mark.encode())] = _k
_SPACELESS = np.ones(256, bool)
_SPACELESS[[9, 10, 11, 12, 13, 32]] = False


def passages(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(passages x FEATURES, row of each passage); every row has one at least."""
    data, off = utf8(text)
    rows = len(off) - 1
    start, end, row = words(data, off, _SPACELESS)
    nth = np.arange(len(row)) - np.searchsorted(row, np.arange(rows))[row]
    opens = nth % PASSAGE_WORDS == 0  # words that open a passage
    count = np.maximum(np.bincount(row[opens], minlength=rows), 1)
    first = np.cumsum(count) - count  # of each row
    n = int(count.sum())
    of_passage = np.repeat(np.arange(rows), count)
    mine = first[row] + nth // PASSAGE_WORDS
    begin = off[:-1][of_passage].copy()  # first byte of each passage: that of its row, or its first word
    later = opens & (nth > 0)
    begin[mine[later]] = start[later]
    size = np.diff([*begin, len(data)])
    # rows without bytes have passages of size 0
    at = np.repeat(np.arange(n), size)
    out = np.zeros((n, FEATURES), np.float32)
    per = np.maximum(size, 1)[:, None]
    out[:, :CLASSES] = np.bincount(at * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES) / per
    if len(data) > 1:
        pair = (data[:-1].astype(np.uint32) << 8 | data[1:]) * np.uint32(2654435761) >> np.uint32(8)
        same = at[:-1] == at[1:]
        key = at[:-1][same] * PAIRS + (pair[same] % PAIRS).astype(np.int64)
        out[:, CLASSES : CLASSES + PAIRS] = np.sqrt(np.bincount(key, minlength=n * PAIRS).reshape(n, PAIRS) / per)
    if len(row):
        length = (end - start).astype(np.float64)
        m = np.maximum(np.bincount(mine, minlength=n), 1)
        h = hash_spans(data, start, end)
        both = np.unique(mine.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24))
        again = np.zeros(len(row), bool)
        again[1:] = (h[1:] == h[:-1]) & (mine[1:] == mine[:-1])
        mean = np.bincount(mine, length, n) / m
        spread = np.sqrt(np.maximum(np.bincount(mine, length * length, n) / m - mean * mean, 0))
        stats = (np.bincount((both >> np.uint64(40)).astype(np.int64), minlength=n) / m, np.bincount(mine, again, n) / m, np.log1p(mean) / 3, np.log1p(spread) / 3, np.log1p(np.bincount(mine, minlength=n)) / 5)
        out[:, CLASSES + PAIRS :] = np.stack(stats, axis=1)
    return out, of_passage


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    prior: float  # log-odds that undo the sample's class balance

    def forward(self, x: np.ndarray, bag: np.ndarray, n: int):
        """Probabilities of ``n`` bags, and what the gradient needs."""
        w = self.weights
        z = (x - self.mean) / self.spread
        h = np.tanh(z @ w["E"] + w["e"])
        a, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        s = (a * g) @ w["w"]
        top = np.full(n, -np.inf, np.float32)
        np.maximum.at(top, bag, s)
        s = np.exp(s - top[bag])
        s /= np.bincount(bag, s, n)[bag]
        pooled = np.zeros((n, HIDDEN), np.float32)
        np.add.at(pooled, bag, h * s[:, None].astype(np.float32))
        logit = pooled @ w["c"] + w["b"]
        return logit[:, 0], (z, h, a, g, s.astype(np.float32), pooled)

    def score(self, x: np.ndarray, bag: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        logit, (*_, attention, _) = self.forward(x, bag, n)
        return 1 / (1 + np.exp(-(logit.astype(float) + self.prior))), attention


def _start(rnd: np.random.Generator) -> dict[str, np.ndarray]:
    shape = {"E": (FEATURES, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN, 1), "b": (1,)}
    return {k: (rnd.standard_normal(s) / np.sqrt(s[0]) * (len(s) > 1 or k == "w")).astype(np.float32) for k, s in shape.items()}


def _train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Adam on the log loss of bags; x: passages in order of ``bag`` 0..len(y)-1."""
    rnd = np.random.default_rng(seed)
    weights = _start(rnd)
    model = Model(x.mean(0), x.std(0) + 1e-3, weights, 0.0)
    first = np.searchsorted(bag, np.arange(len(y) + 1))
    m, v, step = {k: np.zeros_like(w) for k, w in weights.items()}, {k: np.zeros_like(w) for k, w in weights.items()}, 0
    steps = EPOCHS * -(-len(y) // BATCH)
    for _ in range(EPOCHS):
        order = rnd.permutation(len(y))
        for a in range(0, len(y), BATCH):
            own = order[a : a + BATCH]
            size = first[own + 1] - first[own]
            at = np.repeat(first[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            small = np.repeat(np.arange(len(own)), size)
            logit, (z, h, t, g, s, pooled) = model.forward(x[at], small, len(own))
            d = ((1 / (1 + np.exp(-logit)) - y[own]) / len(own)).astype(np.float32)
            grad = {"c": pooled.T @ d[:, None], "b": d.sum(keepdims=True)}
            back = d[:, None] * weights["c"].T  # on the pooled passage
            along = (h * back[small]).sum(1)
            ds = s * (along - np.bincount(small, s * along, len(own))[small]).astype(np.float32)
            grad["w"] = (t * g).T @ ds
            dt, dg = ds[:, None] * weights["w"] * g * (1 - t * t), ds[:, None] * weights["w"] * t * g * (1 - g)
            grad["V"], grad["U"] = h.T @ dt, h.T @ dg
            dh = (s[:, None] * back[small] + dt @ weights["V"].T + dg @ weights["U"].T) * (1 - h * h)
            grad["E"], grad["e"] = z.T @ dh, dh.sum(0)
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for k in weights:
                gk = grad[k] + DECAY * weights[k]
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.999 * v[k] + 0.001 * gk * gk
                weights[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    model.prior = prior
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from about ``per_class`` labelled documents of each class."""
    sample = labelled_sample(docs, labels, label, per_class, id_col, text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x, row = passages(batch.column("text"))
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            packed = [x[a:b].astype(np.float16).tobytes() for a, b in zip(cut, cut[1:], strict=False)]
            yield pa.record_batch([batch.column("y"), pa.array(packed, pa.binary())], names=["y", "x"])

    # the sample's passages; sorted so that a fit does not depend on how the input is dealt
    rows = sorted(sample.mapInArrow(encode, "y int, x binary").toLocalIterator(), key=lambda r: (r.y, r.x))
    y = np.array([r.y for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        shapes = _start(np.random.default_rng(0))
        model = Model(np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32), {k: np.zeros_like(w) for k, w in shapes.items()}, 0.0)
        good, n = float(y.sum()) + 1, len(y) + 1
        model.prior = float(np.log(good / (n - good))) if good < n else 40.0
        return model
    bags = [np.frombuffer(r.x, np.float16).reshape(-1, FEATURES) for r in rows]
    share = class_counts(labels, label, id_col)
    prior = float(np.log(share[1] / share[0]) - np.log((y == 1).sum() / (y == 0).sum()))
    return _train(np.concatenate(bags).astype(np.float32), np.repeat(np.arange(len(bags)), [len(b) for b in bags]), y, prior)


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: tuple[str, str] = ("score", "attention")) -> DataFrame:
    """All columns of ``docs`` with the probability of label 1 and each
    passage's attention weight, in the order of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    names = [*plain.columns, "p", "attention"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, f"c{at}"):
            x, row = passages(batch.column(at))
            p, attention = m.score(x, row, batch.num_rows)
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.record_batch([*batch.columns, pa.array(p), pa.ListArray.from_arrays(pa.array(cut), pa.array(attention, pa.float32()))], names=names)

    added = T.StructType.fromDDL("p double, attention array<float>").fields
    return renamed(plain.mapInArrow(run, T.StructType([*plain.schema.fields, *added])), docs.columns, out)
