"""Alignment of two tokenizers' tokens over whole texts.

``align`` encodes every text with both tokenizers and joins the token spans. Per
batch of texts, ``pandas.merge_asof`` keyed by document finds for each token
start the other side's covering token, in both directions; the union of the two
is every overlapping pair of tokens. A pair that ends at the same byte ends a
group, so the groups are the shortest spans that both sides tokenise on their
own, and all A and B tokens of a group are linked. ``with_counts`` counts over
the corpus in how many documents an id pair is linked, and gives each document
the sums over its own links.

A group's links are counted from its distinct ids with their multiplicities, so
a long run of one character does not emit all pairs. Pair counts are added up
in the task that made them before they are shuffled; the frequent pairs meet the
documents' links by a broadcast of bounded size, only the rest is shuffled.

A side is described by (kind, path): ``byte_bpe`` is a byte-level BPE file of
``tokenizers`` and encodes a space and the text; ``piece`` is a sentencepiece
model with byte fallback, which adds the space itself. Special tokens' strings in
a text are ordinary text.

Defined cases: texts that are null or empty, or that a side does not give back
byte for byte (characters that a model replaces), have no tokens: zeros and an
empty ``groups``. Null and repeated ids are rows of their own. Extra columns are
not read, whatever their names. Without documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import FREQUENT_ROWS, split_join
from .common import per_process, slices, stored
from .packing import load_tokenizer

#: Bytes of text whose tokens are joined together; a longer text is joined by itself.
JOIN_BYTES = 1 << 20


class Side(NamedTuple):
    """``encode`` gives a list of ids for each of many texts; ``token[id]`` are
    an id's bytes, ``size[id]`` their number."""

    encode: object
    token: list[bytes]
    size: np.ndarray


def load_side(kind: str, path: str) -> Side:
    """One tokenizer, loaded once per Python process."""

    def byte_bpe():
        from tokenizers import Tokenizer

        one = load_tokenizer(path)
        vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        token = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            token[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        return (lambda texts: [one(" " + t) for t in texts]), token

    def piece():
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        token = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]
        return (lambda texts: model.encode(texts, num_threads=1)), token

    def make():
        encode, token = {"byte_bpe": byte_bpe, "piece": piece}[kind]()
        return Side(encode, token, np.array([len(t) for t in token], np.int64))

    return per_process(("align", kind, path), make)


class Tokens(NamedTuple):
    """Tokens of many documents in order: document number, first byte and end
    in the joined texts, id."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    id: np.ndarray


def tokenise(texts: list[str | None], sides: tuple[Side, Side]) -> tuple[Tokens, Tokens]:
    """Both sides' tokens of the texts that both give back byte for byte."""
    live = [k for k, t in enumerate(texts) if t]
    encoded = [side.encode([texts[k] for k in live]) for side in sides]
    good = []
    for n, k in enumerate(live):
        whole = b" " + texts[k].encode()
        good.append(all(b"".join(map(side.token.__getitem__, ids[n])) == whole for side, ids in zip(sides, encoded, strict=True)))
    out = []
    for side, ids in zip(sides, encoded, strict=True):
        kept = [(k, x) for k, x, ok in zip(live, ids, good, strict=True) if ok]
        doc = np.repeat(np.array([k for k, _ in kept], np.int64), [len(x) for _, x in kept])
        flat = np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for _, x in kept)])
        end = np.cumsum(side.size[flat])
        out.append(Tokens(doc, end - side.size[flat], end, flat))
    return out[0], out[1]


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping pairs as (index in a, index in b), by position."""
    left = pd.DataFrame({"at": a.start, "doc": a.doc, "a": np.arange(len(a.doc))})
    right = pd.DataFrame({"at": b.start, "doc": b.doc, "b": np.arange(len(b.doc))})
    under_a = pd.merge_asof(left, right, on="at", by="doc")  # the b token over each a token's start
    under_b = pd.merge_asof(right, left, on="at", by="doc")
    # equal starts are found from both directions
    i, j = under_b["a"].to_numpy(np.int64), under_b["b"].to_numpy(np.int64)
    fresh = a.start[i] != b.start[j]
    i, j = np.concatenate([under_a["a"].to_numpy(np.int64), i[fresh]]), np.concatenate([under_a["b"].to_numpy(np.int64), j[fresh]])
    order = np.argsort(i + j, kind="stable")  # from pair to pair one side moves on by one token, or both do
    return i[order], j[order]


def _distinct(key: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (sorted) and the sum of weights of each (of ones by default)."""
    if not len(key):
        return key, np.zeros(0, np.int64)
    if weight is None:
        key = np.sort(key)
    else:
        order = np.argsort(key)
        key, weight = key[order], weight[order]
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return key[first], np.diff(first, append=len(key)) if weight is None else np.add.reduceat(weight, first)


class Groups(NamedTuple):
    """``a`` and ``b``: each token's group; ``doc``: each group's document;
    ``links``: (doc, a id, b id, links) of each id pair of a document."""

    a: np.ndarray
    b: np.ndarray
    doc: np.ndarray
    links: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def groups(a: Tokens, b: Tokens) -> Groups:
    i, j = overlaps(a, b)
    shared = a.end[i][a.end[i] == b.end[j]]  # ascending, one for each group
    ga, gb = np.searchsorted(shared, a.end), np.searchsorted(shared, b.end)
    doc = a.doc[np.searchsorted(a.end, shared)]
    wide_a, wide_b = 1 + a.id.max(initial=0), 1 + b.id.max(initial=0)
    key_a, na = _distinct(ga * wide_a + a.id)
    key_b, nb = _distinct(gb * wide_b + b.id)
    g1, ida = np.divmod(key_a, wide_a)
    g2, idb = np.divmod(key_b, wide_b)
    # within a group, its distinct a ids meet its distinct b ids
    width = np.bincount(g2, minlength=len(shared))
    begin, width = (np.cumsum(width) - width)[g1], width[g1]
    left = np.repeat(np.arange(len(g1)), width)
    right = np.arange(len(left)) + np.repeat(begin - np.cumsum(width) + width, width)
    key, n = _distinct((doc[g1[left]] * wide_a + ida[left]) * wide_b + idb[right], na[left] * nb[right])
    key, y = np.divmod(key, wide_b)
    d, x = np.divmod(key, wide_a)
    return Groups(ga, gb, doc, (d, x, y, n))


def _number_texts(n: int) -> list[str]:
    """Each number below n followed by each of four signs."""
    return per_process(("numbers", n), lambda: [f"{i}{sign}" for i in range(n) for sign in (",", "|", ";", "")])


def _shown(a: Tokens, b: Tokens, g: Groups, n_docs: int, vocabulary: int) -> list[str]:
    """Per document its groups as ``a1,a2|b1;a3|b2,b3``."""
    order = np.argsort(np.concatenate([g.a * 2, g.b * 2 + 1]), kind="stable")
    place = np.concatenate([g.a * 2, g.b * 2 + 1])[order]
    doc = np.concatenate([a.doc, b.doc])[order]
    after = np.full(len(order), 3)  # the sign after each id
    if len(order):
        step = place[1:] != place[:-1]
        after[:-1] = np.where(doc[1:] != doc[:-1], 3, np.where(step, 1 + place[:-1] % 2, 0))
    texts = _number_texts(vocabulary)
    part = list(map(texts.__getitem__, (np.concatenate([a.id, b.id])[order] * 4 + after).tolist()))
    ends = np.searchsorted(doc, np.arange(n_docs + 1)).tolist()
    return ["".join(part[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]


def align(docs: DataFrame, side_a: tuple[str, str], side_b: tuple[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row, doc_id, n_a, n_b, n_groups, n_links, groups
    (string), links (id pairs with their number of links)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = load_side(*side_a), load_side(*side_b)
        for batch in slices(batches, "text", JOIN_BYTES):
            n = batch.num_rows
            a, b = tokenise(batch.column("text").to_pylist(), sides)
            g = groups(a, b)
            d, x, y, links = g.links
            per_doc = np.zeros(n, np.int64)
            np.add.at(per_doc, d, links)
            pairs = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)), pa.array(y.astype(np.int32)), pa.array(links)], names=["a", "b", "n"])
            cells = [np.bincount(t, minlength=n) for t in (a.doc, b.doc, g.doc)]
            yield pa.record_batch(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    *(pa.array(c.astype(np.int64)) for c in (*cells, per_doc)),
                    pa.array(_shown(a, b, g, n, max(len(s.token) for s in sides)), pa.string()),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(d, np.arange(n + 1)).astype(np.int32)), pairs),
                ],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<a:int,b:int,n:long>>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, documents): how many documents hold an id pair linked."""
    return aligned.select(F.inline("links")).groupBy("a", "b").agg(F.count("*").alias("documents"))


def with_counts(aligned: DataFrame, frequent: int = FREQUENT_ROWS) -> DataFrame:
    """``aligned`` (stored) without links, with n_best and count_sum: links to
    an A id's most frequent partners, and the sum of pair counts over links."""
    counted = stored(pair_counts(aligned), "pair-counts")
    top = counted.groupBy("a").agg(F.max("documents").alias("top"))  # a row per id of the vocabulary
    known = counted.join(F.broadcast(top), "a").select("a", "b", "documents", F.col("documents").alias("count"), (F.col("documents") == F.col("top")).alias("best"))
    links = aligned.select("row", F.inline("links"))
    met = split_join(links, stored(known, "pairs"), ["a", "b"], "documents", frequent)
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    plain = aligned.drop("links")
    return plain.join(sums, "row", "left").select(*plain.columns, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")))
