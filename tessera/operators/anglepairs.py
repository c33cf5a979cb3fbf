"""Exact threshold pairs with pruning (C5): blocks that cannot reach the threshold never meet.

Rows are ordered by their nearest pivot and their angle to it, and cut into
blocks. A block records the smallest and the largest angle of its rows to every
pivot. By the triangle inequality the rows of two blocks are at least as far
apart as the gap between their ranges at any pivot, so pairs of blocks whose
widest gap is above the threshold's angle are left out before any row moves. A
block that does meet another is cut into tiles, which are skipped by the
same rule. What is left is compared in full, so the result is exact; how much is
skipped depends on the data (vectors without clusters skip nothing, and the work
is then that of ``similarity.pairwise_similarity``).

Pivots are k-means centres of a sample (``invlists``); they decide how much is
skipped, never what is found. Equal vectors are one row of the comparison: the
result is the pairs between classes, named by their smallest ids, and the table
of members, so a group of copies is never expanded into its pairs.

Sizes: a block holds at most ``similarity.BLOCK_BYTES`` of vectors and a row
travels once per block that its own meets. The driver and each task hold two
angles per block and pivot, for at most ``SPAN_BYTES`` (fewer pivots beyond).

Defined cases: rows with a NULL id or a vector that is NULL, empty, zero, or has
components that are NULL or not finite have no angle and are in neither result; of
repeated ids the smallest vector counts; columns other than the two are not
read; an empty table gives empty results. Vectors have one length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import invlists
from . import similarity as S
from .nndescent import clean
from .skew import split_join

# Fixed parameters.
PIVOTS = 64
SPAN_BYTES = 128 << 20            # angle ranges of all blocks
BLOCKS_A_CORE = 4                 # blocks of a small table, as a multiple of the root of twice the cores
BINS = 1024                       # of the histogram of angles per pivot
MEMBER_KEYS = 500_000             # names of large classes broadcast to their rows (24 bytes each)


def _gap(lo_a, hi_a, lo_b, hi_b) -> np.ndarray:
    """The least angle between rows of each pair of ranges, by the pivot that tells most."""
    out = np.zeros((len(lo_a), len(lo_b)))
    for p in range(lo_a.shape[1]):
        np.maximum(out, lo_a[:, None, p] - hi_b[None, :, p], out=out)
        np.maximum(out, lo_b[None, :, p] - hi_a[:, None, p], out=out)
    return out


def _blocks(nodes: DataFrame, n: int, pivots: np.ndarray, blocks: int) -> tuple[DataFrame, DataFrame]:
    """(block, id, vec) and (block, span): rows in order of pivot and angle, in
    blocks of about n / ``blocks``, whatever the partitions. The order is that of a histogram
    of angles per pivot; rows of one crowded bin are dealt by a hash of the id."""
    per_block, k = math.ceil(n / blocks), len(pivots)

    def near(batches):
        for b in batches:
            angle = invlists._angles(S.unit_rows(S.matrix(b.column(1)))[0], pivots)
            at = angle.argmin(axis=1)
            cell = at * BINS + np.minimum((angle[np.arange(len(at)), at] * (BINS / math.pi)).astype(np.int64), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *b.columns], names=["cell", "id", "vec"])

    placed = cut_lineage(nodes.select("id", "vec").mapInArrow(near, "cell long, id long, vec array<double>"))
    first, shares, block, room = np.zeros(k * BINS, np.int64), np.ones(k * BINS, np.int64), -1, 0
    for cell, count in placed.groupBy("cell").count().orderBy("cell").collect():  # at most pivots x BINS
        if count > room:
            block, room = block + 1, per_block
        first[cell], shares[cell] = block, max(1, math.ceil(count / per_block))
        block, room = block + shares[cell] - 1, 0 if shares[cell] > 1 else room - count
    shared = nodes.sparkSession.sparkContext.broadcast((first, shares))

    def deal(batches):
        first, shares = shared.value
        for b in batches:
            cell, mixed = b.column(0).to_numpy(), b.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(first[cell] + mixed % shares[cell]), b.column(1), b.column(2)], names=["block", "id", "vec"])

    dealt = placed.withColumn("mixed", F.xxhash64("id")).mapInArrow(deal, "block long, id long, vec array<double>")

    def ranges(batches):
        for b in batches:
            block, angle = b.column(0).to_numpy(), invlists._angles(S.unit_rows(S.matrix(b.column(2)))[0], pivots)
            order = np.argsort(block, kind="stable")
            cuts = np.unique(block[order], return_index=True)[1]
            lo, hi = np.minimum.reduceat(angle[order], cuts), np.maximum.reduceat(angle[order], cuts)
            columns = np.repeat(block[order][cuts], k), np.tile(np.arange(k), len(cuts)), lo.ravel(), hi.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "pivot", "lo", "hi"])

    dealt = cut_lineage(dealt)
    known = dealt.mapInArrow(ranges, "block long, pivot long, lo double, hi double").groupBy("block", "pivot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    both = F.sort_array(F.collect_list(F.struct("pivot", "lo", "hi")))
    spans = known.groupBy("block").agg(both.alias("r")).select("block", F.concat(F.col("r.lo"), F.col("r.hi")).alias("span"))
    return dealt, cut_lineage(spans)


def _compare(ida, a, idb, b, same: bool, pivots, limit: float, threshold: float, digits: int):
    """Pairs of rows of two blocks that reach the threshold, tile by tile."""

    def tiles(ids, units):
        angle = invlists._angles(units, pivots)
        near = angle.argmin(axis=1)
        order = np.lexsort((angle[np.arange(len(near)), near], near))
        cuts = np.arange(0, len(ids), S.TILE_ROWS)
        angle = angle[order]
        return ids[order], units[order], cuts, np.minimum.reduceat(angle, cuts), np.maximum.reduceat(angle, cuts)

    ida, a, cut_a, *span_a = tiles(ida, a)
    idb, b, cut_b, *span_b = (ida, a, cut_a, *span_a) if same else tiles(idb, b)
    for i, j in zip(*np.nonzero(_gap(*span_a, *span_b) <= limit)):
        if same and j < i:
            continue
        rows, columns = slice(cut_a[i], cut_a[i] + S.TILE_ROWS), slice(cut_b[j], cut_b[j] + S.TILE_ROWS)
        s = np.round(a[rows] @ b[columns].T, digits) + 0.0
        ok = s >= threshold
        r, c = np.nonzero(np.triu(ok, 1) if same and i == j else ok)
        x, y = ida[rows][r], idb[columns][c]
        yield np.minimum(x, y), np.maximum(x, y), s[r, c]


def threshold_pairs(
    df: DataFrame, id_col: str, vec_col: str, threshold: float, digits: int = 6, blocks: int | None = None, n_pivots: int = PIVOTS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pairs with cosine >= ``threshold`` (rounded to ``digits``), exactly.

    Returns (id_a, id_b, similarity) between classes of equal vectors, id_a < id_b;
    (id, class_id), whose equal class_ids are pairs too; and one row
    (blocks, met, skipped) that counts pairs of blocks."""
    spark = df.sparkSession
    directed = invlists._searchable("vec")
    rows = cut_lineage(clean(df, id_col, vec_col).filter(directed))
    nodes = cut_lineage(rows.groupBy("key").agg(F.min("id").alias("id"), F.any_value("vec").alias("vec"), F.count("*").alias("n")))
    members = split_join(rows.select("key", "id"), nodes.select("key", F.col("id").alias("class_id"), "n"), ["key"], "n", MEMBER_KEYS).select("id", "class_id")
    n = nodes.count()
    if n == 0:
        pairs = spark.createDataFrame([], "id_a long, id_b long, similarity double")
        return pairs, members, spark.createDataFrame([(0, 0, 0)], "blocks long, met long, skipped long")
    dim, cores = S.dimension(nodes, "vec"), spark.sparkContext.defaultParallelism
    wanted = blocks or max(math.ceil(n * dim * 8 / S.BLOCK_BYTES), min(BLOCKS_A_CORE * math.ceil(math.sqrt(2 * cores)), n // 64), 1)
    n_pivots = max(1, min(n_pivots, math.ceil(math.sqrt(n)), SPAN_BYTES // (16 * wanted)))
    pivots = invlists._fit(nodes.select("id", "vec"), n, n_pivots)
    placed, spans = _blocks(nodes, n, pivots, wanted)
    held = spans.orderBy("block").collect()  # at most SPAN_BYTES
    names, ranges = np.array([r["block"] for r in held]), np.array([r["span"] for r in held])
    limit = math.acos(max(-1.0, min(1.0, threshold - 10.0**-digits))) + 2 * invlists.ANGLE_SLACK
    shared, k = spark.sparkContext.broadcast((names, ranges)), len(pivots)

    def partners(batches):
        names, ranges = shared.value
        for b in batches:
            own, mine = b.column(0).to_numpy(), S.matrix(b.column(1))
            for lo, hi in S._tiles(len(own), 64):
                near = _gap(mine[lo:hi, :k], mine[lo:hi, k:], ranges[:, :k], ranges[:, k:]) <= limit
                i, j = np.nonzero(near & (own[lo:hi, None] <= names[None, :]))
                yield pa.RecordBatch.from_arrays([pa.array(own[lo:hi][i]), pa.array(names[j])], names=["bi", "bj"])

    meetings = cut_lineage(spans.mapInArrow(partners, "bi long, bj long"))
    every = len(held) * (len(held) + 1) // 2
    report = meetings.agg(F.lit(len(held)).cast("long").alias("blocks"), F.count("*").alias("met"), (F.lit(every) - F.count("*")).alias("skipped"))

    def run(lt, rt):
        found = []
        if lt.num_rows and rt.num_rows:
            same = lt.column("bi")[0].as_py() == lt.column("bj")[0].as_py()
            a, b = (S.unit_rows(S.matrix(t.column("vec")))[0] for t in (lt, rt))
            found = list(_compare(lt.column("id").to_numpy(), a, rt.column("id").to_numpy(), b, same, pivots, limit, threshold, digits))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table([pa.array(c) for c in columns], names=["id_a", "id_b", "similarity"])

    # each side has columns of its own, as both come from one table
    left, right = (placed.withColumnRenamed("block", side).join(meetings, side).select(*(F.col(c).alias(c) for c in ("id", "vec", "bi", "bj"))) for side in ("bi", "bj"))
    pairs = left.groupBy("bi", "bj").cogroup(right.groupBy("bi", "bj")).applyInArrow(run, "id_a long, id_b long, similarity double")
    return cut_lineage(pairs), members, report  # links reads them twice


def links(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(id, class_id, links): to how many other rows each row is similar, copies of its own vector
    included. Counted from classes; no pair of rows is formed."""
    sizes = cut_lineage(members.groupBy("class_id").agg(F.count("*").alias("n")))
    ends = pairs.select(F.col("id_a").alias("c"), F.col("id_b").alias("class_id")).unionByName(pairs.select(F.col("id_b").alias("c"), F.col("id_a").alias("class_id")))
    others = ends.join(sizes, "class_id").groupBy(F.col("c").alias("class_id")).agg(F.sum("n").alias("others"))
    total = sizes.join(others, "class_id", "left").select("class_id", "n", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    return split_join(members, cut_lineage(total), ["class_id"], "n", MEMBER_KEYS).select("id", "class_id", "links")
