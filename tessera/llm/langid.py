"""Language identification by multilingual mixture inference.

``fit`` counts hashed byte trigrams per language over all given rows in Spark.
``predict`` treats a document as a mixture of languages: expectation-
maximisation estimates each language's share from the trigrams' likelihoods,
and the language set is chosen by penalised likelihood: starting from all
languages, the one with the smallest share goes as long as the log-likelihood
lost by that is below its penalty.

Only lower-case letters count; all other ASCII bytes are one space.

Defined cases: a null, empty or letterless text is ``und`` with score 0.
Texts without any trigram that a language knows tie; ties go to the language
that sorts first. Whole texts are read, of any length. Rows with null text or
language teach nothing. Repeated rows count each. Extra columns
are kept and not read; one that is named like a result column (in any case)
gives way to it.
Where no row has text and language ``fit`` knows no language and all texts are
``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_fold, renamed, slices, utf8

#: Trigrams are hashed into this many bins: bounds the model to bins x languages numbers.
BINS = 1 << 16
SMOOTHING = 0.5
#: Log-likelihood a language must add, times the log of the number of trigrams
#: (they overlap by two thirds, so three times the half of BIC, doubled for safety).
PENALTY = 3.0
ROUNDS, TOLERANCE = 30, 1e-3
UNKNOWN = "und"

_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def _trigrams(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bin) of each byte trigram that has no two spaces next to each other."""
    data, off = utf8(pc.utf8_lower(col.cast(pa.large_string())))
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    d = _KEEP[data].astype(np.uint32)
    space = d == 32
    ok = ~((space[:-2] & space[1:-1]) | (space[1:-1] & space[2:]))
    for shift in (1, 2):  # not over the end of a row
        cut = off[1:-1] - shift
        ok[cut[(cut >= 0) & (cut < n - 2)]] = False
    at = np.flatnonzero(ok)
    gram = d[at] | d[at + 1] << np.uint32(8) | d[at + 2] << np.uint32(16)
    return np.searchsorted(off, at, "right") - 1, ((gram * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray  # BINS x languages


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram likelihoods of each language from all rows of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            row, gram = _trigrams(batch.column("text"))
            lang = batch.column("lang").dictionary_encode()
            code = lang.indices.to_numpy(zero_copy_only=False)[row]
            both = np.bincount(code * BINS + gram, minlength=BINS * len(lang.dictionary)).reshape(-1, BINS)
            for name, n in zip(lang.dictionary.to_pylist(), both, strict=True):
                total[name] = total.get(name, 0) + n
        for name, n in total.items():
            k = np.flatnonzero(n)
            yield pa.record_batch([pa.array([name] * len(k)), pa.array(k.astype(np.int32)), pa.array(n[k].astype(np.int64))], names=["lang", "bin", "n"])

    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    counts = rows.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()  # languages x BINS at most
    languages = sorted(counts["lang"].unique())
    table = np.zeros((BINS, len(languages)))
    table[counts["bin"], np.searchsorted(languages, counts["lang"])] = counts["n"]
    table += SMOOTHING
    return Model(languages, (table / table.sum(0)).astype(np.float32))


def _mixture(p: np.ndarray, count: np.ndarray, doc: np.ndarray, starts: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of every document at once: (shares, log-likelihood).

    p: likelihood of each (document, trigram) by language; starts: where each
    document begins; share: where to start from, zero for languages left out."""
    total = np.add.reduceat(count, starts)
    share = share.copy()
    active = np.arange(len(starts))
    rows, own, begin = np.arange(len(doc)), doc, starts
    for _ in range(ROUNDS):
        w = p[rows] * share[own]
        w *= (count[rows] / np.maximum(w.sum(1), 1e-30))[:, None]
        new = np.add.reduceat(w, begin, axis=0) / total[active][:, None]
        moved = np.abs(new - share[active]).max(1) > TOLERANCE
        share[active] = new
        if not moved.any():
            break
        if moved.mean() < 0.7:  # leave out the documents that have settled
            sizes = np.diff([*begin, len(rows)])
            rows, active = rows[np.repeat(moved, sizes)], active[moved]
            own = doc[rows]
            begin = np.cumsum(sizes[moved]) - sizes[moved]
    score = np.log(np.maximum(np.einsum("ij,ij->i", p, share[doc]), 1e-30)) * count
    return share, np.add.reduceat(score, starts)


def infer(row: np.ndarray, gram: np.ndarray, n_rows: int, likelihood: np.ndarray) -> np.ndarray:
    """Shares (rows x languages) of the chosen language set; zero rows have no trigram."""
    out = np.zeros((n_rows, likelihood.shape[1]), np.float32)
    if not out.shape[1] or not len(row):
        return out
    key, count = np.unique(row * BINS + gram, return_counts=True)
    doc, gram, count = key // BINS, key % BINS, count.astype(np.float32)
    present, starts, doc = np.unique(doc, return_index=True, return_inverse=True)
    p, k = likelihood[gram], likelihood.shape[1]
    share, fit_now = _mixture(p, count, doc, starts, np.full((len(present), k), 1 / k, np.float32))
    penalty = PENALTY * np.log(np.add.reduceat(count, starts) + 1)
    open_ = np.flatnonzero((share > 0).sum(1) > 1)
    while len(open_):
        least = np.where(share[open_] > 0, share[open_], np.inf).argmin(1)
        trial = share[open_]
        trial[np.arange(len(open_)), least] = 0
        trial /= np.maximum(trial.sum(1, keepdims=True), 1e-30)
        sizes = np.diff([*starts, len(doc)])
        chosen = np.zeros(len(present), bool)
        chosen[open_] = True
        rows = np.flatnonzero(chosen[doc])
        begin = np.cumsum(sizes[open_]) - sizes[open_]
        trial, fit_less = _mixture(p[rows], count[rows], np.repeat(np.arange(len(open_)), sizes[open_]), begin, trial)
        goes = fit_now[open_] - fit_less < penalty[open_]
        share[open_[goes]], fit_now[open_[goes]] = trial[goes], fit_less[goes]
        open_ = open_[goes]
        open_ = open_[(share[open_] > 0).sum(1) > 1]
    out[present] = share
    return out


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: tuple[str, str, str] = ("lang_pred", "score", "languages")) -> DataFrame:
    """All columns of ``docs`` with the main language, its share, and the
    chosen languages with their shares (largest first)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, batch_text):
            text = batch.column(at)
            row, gram = _trigrams(text)
            if not m.languages:
                none = [pa.array([UNKNOWN] * batch.num_rows), pa.array(np.zeros(batch.num_rows)), pa.array([[]] * batch.num_rows, kind)]
                yield pa.record_batch([*batch.columns, *none], names=names)
                continue
            share = infer(row, gram, batch.num_rows, m.likelihood)
            letter = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
            best = share.argmax(1)
            score = np.where(letter, share[np.arange(len(best)), best], 0).astype(float).clip(0, 1)
            name = [m.languages[b] if x else UNKNOWN for b, x in zip(best, letter, strict=True)]
            mix = [[{"lang": m.languages[k], "share": float(s[k])} for k in np.argsort(-s, kind="stable") if s[k] > 0] if x else [] for s, x in zip(share, letter, strict=True)]
            yield pa.record_batch([*batch.columns, pa.array(name), pa.array(score), pa.array(mix, kind)], names=names)

    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    batch_text = f"c{at}"
    names = [*plain.columns, "pred", "score", "mix"]
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    schema = T.StructType([*plain.schema.fields, *T.StructType.fromDDL("pred string, score double, mix array<struct<lang:string,share:double>>").fields])
    return renamed(plain.mapInArrow(run, schema), docs.columns, out)


def held_out(id_col: str, mod: int = 5, rest: int = 0) -> Column:
    """Rows that the contract keeps out of the fit."""
    return crc_fold(id_col, mod) == rest
