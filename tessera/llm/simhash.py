"""SimHash near-dedup by multi-index hashing.

A text's fingerprint has a bit set where over half the hashes of its word
shingles have it. Fingerprints link when they differ in ``max_bits`` bits or
fewer. They are cut into ``max_bits // 2 + 1`` segments; two that link agree in
some segment but for one bit at most, so each distinct fingerprint looks up a
Hamming ball of radius one in each segment's table, and every match is verified
on all 64 bits. Of two segments that differ in a bit, only the one with the bit
clear looks up the other, which halves the look-ups and finds every pair.

Equal fingerprints are one entry from the start: copies never make pairs.
Groups are the connected components of the links.

Defined cases: words are runs of bytes other than ASCII white space, A-Z lower
case. A text of fewer words than a shingle is one shingle; a null, empty or
blank text has fingerprint zero, which links like any other. A group's id is
the smallest non-null id in it (null where all are null). Repeated rows are one
group. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_small, slices, stored

SEED = 42
#: Fingerprints that may share an entry of a segment's table before it is split.
HOT = 512
#: Fingerprints of so many rows, at most, that their names are broadcast.
MANY = 100_000


def _fingerprint(text: str | None, shingle: int) -> int:
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), 0
    hashes = np.fromiter((digest(p, SEED) for p in parts), np.uint64)
    for k in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        block = hashes[k : k + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(block)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, fp long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = [_fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(fp, pa.int64())], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("fp", T.LongType())])).withColumnRenamed("id", id_col)


def _ball(own: Column, width: int) -> Column:
    """``own`` and the values that set one more of its ``width`` bits."""
    bits = F.array(*(F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(width)))
    clear = F.filter(bits, lambda bit: own.bitwiseAND(bit) == 0)
    return F.concat(F.array(own), F.transform(clear, lambda bit: own.bitwiseOR(bit)))


def _cut(lo: int, hi: int, parts: int) -> list[tuple[int, int]]:
    at = [lo + (hi - lo) * k // parts for k in range(parts + 1)]
    return list(zip(at, at[1:], strict=False))


def _bits(lo: int, hi: int) -> Column:
    """Bits lo..hi-1 of ``fp``."""
    return F.col("fp") if hi - lo == 64 else F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def _keys(segments: list[tuple[int, int]], ball: bool) -> Column:
    """The tables and values to look up, one struct each."""
    each = []
    for k, (lo, hi) in enumerate(segments):
        values = _ball(_bits(lo, hi), hi - lo) if ball else F.array(_bits(lo, hi))
        each.append(_tagged(values, k))
    return F.explode(F.concat(*each))


def _tagged(values: Column, k: int) -> Column:
    return F.transform(values, lambda x: F.struct(F.lit(k).alias("segment"), x.alias("value")))


def links(distinct: DataFrame, max_bits: int = 3, hot: int = HOT) -> DataFrame:
    """Pairs (a, b) of different fingerprints (column ``fp``, distinct rows) at
    ``max_bits`` bits or fewer.

    Entries of a segment's table that more than ``hot`` fingerprints share are
    split once more, by the same rule on the bits outside that segment, so a
    dense group of near copies does not meet as a whole."""
    segments = _cut(0, 64, max_bits // 2 + 1)
    table, probe = (distinct.select("fp", _keys(segments, ball).alias("key")).select("fp", "key.*") for ball in (False, True))
    on = ["segment", "value"]
    if len(segments) == 1:  # an entry is one fingerprint
        pairs = _meet(probe, table, on)
    else:
        crowded = stored(table.groupBy(on).agg(F.count("*").alias("n")).where(F.col("n") > hot).select(on), "crowded")
        pairs = _meet(join_small(probe, crowded, on, "left_anti"), join_small(table, crowded, on, "left_anti"), on)
        if crowded.limit(1).count():
            for k in range(len(segments)):
                rest = [x for j, (lo, hi) in enumerate(segments) if j != k for x in _cut(lo, hi, 2)]

                def finer(df: DataFrame, ball: bool, k: int = k, rest: list = rest) -> DataFrame:
                    own = join_small(df.where(F.col("segment") == k), crowded, on, "left_semi").select("fp", *on, _keys(rest, ball).alias("key"))
                    return own.select("fp", *on, F.col("key.segment").alias("segment2"), F.col("key.value").alias("value2"))

                # in the finer segment, either side may be the one with the bit clear
                for ball in (True, False):
                    pairs = pairs.unionByName(_meet(finer(probe, ball), finer(table, not ball), [*on, "segment2", "value2"]))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return pairs.where((F.col("a") != F.col("b")) & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _meet(probe: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    return probe.withColumnRenamed("fp", "b").join(table.withColumnRenamed("fp", "a"), on).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node it reaches.

    Each round takes the smallest root among the neighbours and then the root
    of that root, so paths shorten geometrically; each round's result is a
    written table."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    state = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        near = both.join(state.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = state.join(near, "node").select("node", "root", F.least("root", "near").alias("best"))
        up = state.select(F.col("node").alias("best"), F.col("root").alias("over"))
        moved = stored(step.join(up, "best").select("node", F.least("best", "over").alias("new"), (F.least("best", "over") < F.col("root")).alias("moved")), "roots")
        state = moved.select("node", F.col("new").alias("root"))
        if moved.where("moved").limit(1).count() == 0:
            return state


def groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, fingerprint (16 hex digits), component_id."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min(id_col).alias("first_id"), F.count("*").alias("n")), "distinct")
    member = components(links(distinct.select("fp"), max_bits))
    first = distinct.join(member.select(F.col("node").alias("fp"), "root"), "fp").select("fp", "root", "first_id")
    group = first.groupBy("root").agg(F.min("first_id").alias("group_id"))
    moved = first.join(group, "root").select("fp", "group_id")
    named = distinct.join(moved, "fp", "left").select("fp", "n", F.when(F.col("group_id").isNull(), F.col("first_id")).otherwise(F.col("group_id")).alias("component_id"))
    named = stored(named, "named")
    # a fingerprint of many rows meets them by broadcast (at most MANY of those), the others by a shuffle
    many = F.col("n") > max(1_000, rows.count() // MANY)
    hot, cold = F.broadcast(named.where(many).drop("n")), named.where(~many).drop("n")
    joined = rows.join(hot, "fp").unionByName(rows.join(F.broadcast(named.where(many).select("fp")), "fp", "left_anti").join(cold, "fp"))
    return joined.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group, all columns unchanged: the row of the
    smallest id, and of the smallest text hash where ids repeat."""
    rows = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    at = dict(zip(docs.columns, rows.columns, strict=True))
    key = F.struct(
        F.col(at[id_col]).isNull().alias("none"),
        F.coalesce(F.col(at[id_col]).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.coalesce(F.col(at[text_col]).cast("string"), F.lit(""))).alias("h"),
    )
    found = groups(rows.select(key.alias("key"), F.col(at[text_col]).alias("text")), shingle, max_bits, "key", "text")
    stay = found.where("key = component_id").select("key.none", "key.id", "key.h").distinct()
    kept = rows.select("*", key.alias("key")).select(*rows.columns, "key.none", "key.id", "key.h").join(stay, ["none", "id", "h"], "left_semi")
    one = Window.partitionBy("none", "id", "h").orderBy(F.lit(0))  # dealt as the join is
    return kept.withColumn("nth", F.row_number().over(one)).where("nth = 1").select(*(F.col(c).alias(name) for name, c in at.items()))
