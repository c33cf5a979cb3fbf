"""Mixing sources to target weights with a low-discrepancy schedule.

``recipe`` turns source sizes and weights into target words per source.
``schedule`` makes the mixture itself, a table of runs of words in the order in
which training reads them:

* Every source's documents are shuffled (by a hash of id and pass) and laid end
  to end, one pass after the other, and that stream is cut into blocks of
  ``block`` words. A running total over a range-sorted table gives each document
  its place, so a source that holds a third of all rows is spread over tasks.
* Slot i of the schedule is the i-th point of the golden-ratio sequence, i times
  2**64 / phi modulo 2**64, mapped through the cumulative numbers of blocks. Any
  stretch of the schedule therefore has nearly the target shares.
* A slot's rank within its source is the number of earlier points in the
  source's interval. A sum of floors (Euclid's algorithm) gives it for the first
  slot of a chunk, counting goes on from there: no shuffle and no window. The
  few slots by which a source exceeds its number of blocks go to sources that
  fall short, so that every source gives exactly its blocks.
* Slots and blocks meet in a join on (source, rank), which no hot key can skew.

The table of sources (one row each) is held by the driver and the tasks, as the
recipe of weights is; everything else is distributed.

Defined cases: null text has no words. Documents without words are kept with
nothing taken. Null sources are a source of their own, the last. Null ids and
repeated rows are rows of their own. Extra columns are not read, whatever their
names. An empty table, or one without words, gives an empty schedule.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stored, utf8, words

#: 2**64 / golden ratio, made odd.
GOLDEN = 0x9E3779B97F4A7C15
_TURN = 1 << 64
#: Slots made by one call.
CHUNK = 1 << 16

_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


class Source(NamedTuple):
    source: str | None
    size: int
    target: float


class Mixture(NamedTuple):
    """``documents``: row, doc_id, source_no, size. ``schedule``: slot,
    source_no, pass, row, doc_id, start, words. ``sources``: by source_no."""

    documents: DataFrame
    schedule: DataFrame
    sources: list[Source]


def targets(sizes: Sequence[int], weights: Sequence[int], most: int) -> list[float]:
    """Shares of all words by weight; a target stops at ``most`` times its
    source's size and the excess is reshared by weight until none is above."""
    left, weight = sum(sizes), sum(weights)
    out = [0.0] * len(sizes)
    # the sources that stop are those whose limit per unit of weight is least
    for k in sorted(range(len(sizes)), key=lambda k: (most * sizes[k] / weights[k], k)):
        out[k] = float(min(most * sizes[k], weights[k] * (left / weight)))
        if out[k] == most * sizes[k]:
            left, weight = left - most * sizes[k], weight - weights[k]
    return out


def floor_sum(n: int, m: int, a: int, b: int) -> int:
    """The sum of (a * i + b) // m over 0 <= i < n."""
    total = 0
    while n > 0:
        total += n * (n - 1) // 2 * (a // m) + n * (b // m)
        a, b = a % m, b % m
        top = a * n + b
        n, b, m, a = top // m, top % m, a, m
    return total


def points_below(n: int, edge: int) -> int:
    """How many of the first ``n`` points are less than ``edge``."""
    return n - floor_sum(n, _TURN, GOLDEN, _TURN - edge) + floor_sum(n, _TURN, GOLDEN, 0)


def slots(spark: SparkSession, blocks: Sequence[int], chunk: int = CHUNK) -> DataFrame:
    """(slot, source_no, rank): sum(blocks) slots in which source k has
    ranks 0 .. blocks[k] - 1."""
    total = sum(blocks)
    ends = np.cumsum([0, *blocks], dtype=object)
    edges = [int(e) * _TURN // total if total else 0 for e in ends]
    count = [points_below(total, b) - points_below(total, a) for a, b in zip(edges, edges[1:])]
    over = np.cumsum([0, *(max(0, c - b) for c, b in zip(count, blocks))])
    short = np.cumsum([0, *(max(0, b - c) for c, b in zip(count, blocks))])
    upper = np.array(edges[1:-1], dtype=np.uint64)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit, begun = np.array(blocks, np.int64), np.array(count, np.int64)
        for batch in batches:
            for c in batch.column(0).to_pylist():
                slot = np.arange(c * chunk, min((c + 1) * chunk, total), dtype=np.int64)
                source = np.searchsorted(upper, slot.astype(np.uint64) * np.uint64(GOLDEN), "right")
                order = np.argsort(source, kind="stable")
                found, first = np.unique(source[order], return_index=True)
                at = np.empty(len(slot), np.int64)
                at[order] = np.arange(len(slot)) - np.repeat(first, np.diff([*first, len(slot)]))
                before = np.zeros(len(blocks), np.int64)
                for k in found.tolist():
                    before[k] = points_below(c * chunk, edges[k + 1]) - points_below(c * chunk, edges[k])
                rank = before[source] + at
                spare = np.flatnonzero(rank >= limit[source])
                nth = over[source[spare]] + rank[spare] - limit[source[spare]]
                taker = np.searchsorted(short, nth, "right") - 1
                source[spare], rank[spare] = taker, begun[taker] + nth - short[taker]
                yield pa.record_batch([pa.array(slot), pa.array(source.astype(np.int32)), pa.array(rank)], names=["slot", "source_no", "rank"])

    chunks = -(-total // chunk)
    parts = max(1, min(chunks, max(spark.sparkContext.defaultParallelism, chunks // 64)))
    return spark.range(0, chunks, 1, parts).mapInArrow(make, "slot long, source_no int, rank long")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, doc_id, source, size) with the words ``[^\\x20\\x09-\\x0D]+`` of whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, off = utf8(batch.column("text"))
            of = words(data, off, _NOT_SPACE)[2]
            size = np.bincount(of, minlength=batch.num_rows).astype(np.int64)
            yield pa.record_batch([*(batch.column(c) for c in ("row", "doc_id", "source")), pa.array(size)], names=["row", "doc_id", "source", "size"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(count, "row long, doc_id long, source string, size long")


def running_total(df: DataFrame, order: list, size_col: str, out: str) -> DataFrame:
    """``df`` with the sum of ``size_col`` over all rows before, in ``order``.

    The rows are range-partitioned, sorted and written once; a task adds up its
    own rows, and one total per partition is added on the driver."""
    names = df.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            size = batch.column(size_col).to_numpy(zero_copy_only=False).astype(np.int64)
            before = done + np.cumsum(size) - size
            done += int(size.sum())
            yield pa.record_batch([*batch.columns, pa.array(before)], names=[*batch.schema.names, out])

    split = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    summed = stored(split.mapInArrow(add, T.StructType([*split.schema.fields, T.StructField(out, T.LongType())])), "running")
    totals = sorted(summed.groupBy("__part").agg(F.sum(size_col)).collect())
    begin, offsets = 0, []
    for part, total in totals:
        offsets.append((part, begin))
        begin += total
    spark = df.sparkSession
    offset = spark.createDataFrame(offsets, "__part int, __begin long")  # a row per partition
    return summed.join(F.broadcast(offset), "__part").select(*names, (F.col(out) + F.col("__begin")).alias(out))


def mix(docs: DataFrame, weights: Sequence[int], most: int, block: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mixture:
    """Mix all rows: sources in code point order (null last) take ``weights`` in
    turn, and no source is read more than ``most`` times."""
    spark = docs.sparkSession
    counted = stored(word_counts(docs, id_col, text_col, source_col), "words")
    sizes = sorted(((r[0], r[1]) for r in counted.groupBy("source").agg(F.sum("size")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    wanted = targets([n for _, n in sizes], [weights[k % len(weights)] for k in range(len(sizes))], most)
    sources = [Source(s, n, t) for (s, n), t in zip(sizes, wanted)]
    take = [int(s.target + 0.5) for s in sources]  # words
    recipe = spark.createDataFrame(
        [(k, s.source, take[k], -(-take[k] // s.size) if s.size else 0, sum(-(-t // max(x.size, 1)) * x.size for t, x in zip(take[:k], sources))) for k, s in enumerate(sources)],
        "source_no int, source string, take long, passes int, begin long",
    )
    documents = counted.join(F.broadcast(recipe), counted["source"].eqNullSafe(recipe["source"])).drop("source")
    streams = documents.where("size > 0 AND passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("pass").cast("string")).cast("binary"))
    streams = streams.withColumn("key", F.conv(F.substring(key, 1, 15), 16, 10).cast("long"))
    placed = running_total(streams, ["source_no", "pass", "key", "doc_id", "size", "row"], "size", "at").withColumn("at", F.col("at") - F.col("begin"))
    end = F.least(F.col("at") + F.col("size"), F.col("take"))
    runs = (
        placed.withColumn("end", end)
        .where("at < end")
        .withColumn("rank", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block))))
        .select(
            "source_no", "pass", "row", "doc_id", "rank",
            (F.greatest(F.col("at"), F.col("rank") * block) - F.col("at")).alias("start"),
            (F.least(F.col("end"), (F.col("rank") + 1) * block) - F.greatest(F.col("at"), F.col("rank") * block)).alias("words"),
        )
    )
    plan = slots(spark, [-(-t // block) for t in take])
    schedule = plan.join(runs, ["source_no", "rank"]).select("slot", "source_no", "pass", "row", "doc_id", "start", "words")
    return Mixture(documents.select("row", "doc_id", "source_no", "size"), schedule, sources)


def taken(mixture: Mixture) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    spark = mixture.documents.sparkSession
    about = spark.createDataFrame([(k, s.size, s.target) for k, s in enumerate(mixture.sources)], "source_no int, source_size long, target double")
    read = mixture.schedule.groupBy("row").agg(F.sum("words").alias("taken"))
    return (
        mixture.documents.join(F.broadcast(about), "source_no")
        .join(read, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )
