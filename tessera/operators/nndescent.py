"""Neighbours without quadratic work (C6, E3): NN-descent on a written graph.

Two neighbours of one row are likely to be neighbours of each other. The graph
starts from rows that are near each other in a few orders, and each round lets
the members of every row's list (its neighbours and the rows that name it) meet
pair by pair; whoever is nearer than the farthest in a list takes its place.
Only pairs with a new member meet. The rounds end when at most ``SETTLED`` of
the edges change.

Work and shuffles grow with rows x pool, not with pairs. Lists are bounded: a
row's own by ``pool``, the rows that name it by ``REVERSE`` x pool, drawn by a
hash (a bound of the method: an edge left out there still counts in the list of
the row that names it). Each round's graph is a written table.

Equal vectors are one node of the graph, so large groups of copies
neither fill the lists nor make hubs; rows get their neighbours from the nodes'
members at the end. Other hubs are split by
``skew.split_join``.

The result is approximate (``recall`` measures it against all rows), but every
row has k neighbours if the table has so many others: rows that the descent
leaves short are completed exactly.

Defined cases: rows with a NULL id, a NULL or empty vector or components that are
NULL or not finite are left out; of repeated ids the smallest vector counts; ties are
ranked by id; an empty table gives an empty result; columns other than
the two are not read. Vectors have one length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage, shuffled
from . import similarity as S
from .skew import split_join

# Fixed parameters.
POOL = 6                          # neighbours kept while searching, as a multiple of k
LEAST_POOL = 60
ORDERS = 4                        # orders the graph starts from; the first is by a hash
CHUNK = 256                       # rows that meet in one place of an order
RATE = 0.6                        # share of the edges drawn in a round
REVERSE = 1                       # rows naming a row that are listed, as a multiple of pool
SETTLED = 0.002                   # share of changed edges that ends the rounds
ROUNDS = 12
HUB_BYTES = 2 << 20               # vectors of frequent nodes broadcast to their edges
MEETING = 4096                    # pairs whose exact distances are taken at a time


def clean(df: DataFrame, id_col: str, vec_col: str, keep_floats: bool = False) -> DataFrame:
    """(id, vec, key): one row per id with a usable vector, of doubles (of floats if the
    column has floats and they are to be kept); ``key`` names the vector."""
    kind = "float" if keep_floats and df.schema[vec_col].dataType.simpleString() == "array<float>" else "double"
    finite = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # Spark orders NaN above infinity
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda v: v.cast(kind)).alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & (F.size("vec") > 0)).filter(finite)
    one = rows.groupBy("id").agg(F.min("vec").alias("vec"))

    def name(batches):
        for b in batches:
            keys = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in S.matrix(b.column(1)) + 0.0]  # no negative zero
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], names=["id", "vec", "key"])

    return one.mapInArrow(name, f"id long, vec array<{kind}>, key binary")


def _whole_lists(batches):
    """Batches sorted by their first column, cut where its value changes: the
    columns as arrays (of vectors a matrix), each list whole."""
    held = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [S.matrix(c) if pa.types.is_list(c.type) else c.to_numpy() for c in b.columns]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last list may go on
        if held and cut == 0 and cols[0][0] == held[-1][0][0]:
            held.append(cols)
            continue
        if held or cut:
            yield [np.concatenate(x) for x in zip(*held, [c[:cut] for c in cols])]
        held = [[c[cut:] for c in cols]]
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _best(src, dst, d, pool: int):
    """Distinct edges, the ``pool`` nearest of each src."""
    order = np.lexsort((dst, d, src))
    src, dst, d = src[order], dst[order], d[order]
    same = np.zeros(len(src), bool)  # one pair has one distance, so its repeats are adjacent
    same[1:] = (src[1:] == src[:-1]) & (dst[1:] == dst[:-1])
    src, dst, d = src[~same], dst[~same], d[~same]
    keep = np.arange(len(src)) - np.searchsorted(src, src) < pool
    return src[keep], dst[keep], d[keep]


def _edges(parts, pool):
    s, t, d = (np.concatenate(x) for x in zip(*parts))
    s, t, d = _best(s, t, d, pool)
    return pa.RecordBatch.from_arrays([pa.array(s), pa.array(t), pa.array(d)], names=["src", "dst", "distance"])


def _start(nodes: DataFrame, n: int, dim: int, mean: np.ndarray, pool: int, seed: int) -> DataFrame:
    """Edges between rows that are near each other in one of the orders."""
    axes = np.random.default_rng(seed).standard_normal((ORDERS - 1, dim))

    def place(batches):
        for b in batches:
            ids, m = b.column(0).to_numpy(), S.matrix(b.column(1)) - mean
            at = np.column_stack([np.zeros(len(ids)), m @ axes.T]).ravel()
            take = pa.array(np.repeat(np.arange(len(ids)), ORDERS))
            o = pa.array(np.tile(np.arange(ORDERS, dtype=np.int32), len(ids)))
            yield pa.RecordBatch.from_arrays([o, pa.array(at), b.column(0).take(take), b.column(1).take(take)], names=["o", "at", "id", "vec"])

    total = n * ORDERS
    cores = nodes.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(total // (8 * CHUNK), max(2 * cores, total // 100_000)))
    placed = nodes.select("id", "vec").mapInArrow(place, f"o int, at double, id long, vec {nodes.schema['vec'].dataType.simpleString()}")
    mixed = F.xxhash64("id", F.lit(seed))
    ordered = placed.repartitionByRange(parts, "o", "at", mixed, "id").sortWithinPartitions("o", "at", mixed, "id")

    def near(batches):
        held, order = None, None
        for b in batches:
            o = b.column(0).to_numpy()
            cuts = [0, *(np.nonzero(o[1:] != o[:-1])[0] + 1), len(o)] if len(o) else []
            for lo, hi in zip(cuts, cuts[1:]):
                piece = pa.Table.from_batches([b.slice(lo, hi - lo)])
                if held is not None and order != o[lo]:
                    yield from settle(held)
                    held = None
                held, order = piece if held is None else pa.concat_tables([held, piece]), o[lo]
                while held.num_rows >= 2 * CHUNK:
                    yield from settle(held.slice(0, CHUNK))
                    held = held.slice(CHUNK)
        if held is not None:
            yield from settle(held)

    def settle(t):
        ids, m = t.column("id").to_numpy(), S.matrix(t.column("vec")) - mean
        if len(ids) > 1:
            yield _edges(list(S._nearest(m, ids, m, ids, pool, False)), pool)

    return ordered.mapInArrow(near, "src long, dst long, distance double")


def _nearest_of_each(edges: DataFrame, pool: int) -> DataFrame:
    """The ``pool`` nearest of each src; an edge of the graph before keeps its marks.
    The edges are shuffled once, by src, for both steps."""
    one = edges.repartition("src").groupBy("src", "dst").agg(F.min("distance").alias("distance"), F.min("new").alias("new"), F.min("fresh").alias("fresh"))
    w = Window.partitionBy("src").orderBy("distance", "dst")
    return one.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= pool).drop("r")


def _round(graph: DataFrame, nodes: DataFrame, mean: np.ndarray, pool: int, number: int) -> DataFrame:
    dim = len(mean)
    drawn = F.pmod(F.xxhash64("src", "dst", F.lit(number)), F.lit(1000)) < int(RATE * 1000)
    chosen = graph.filter(drawn)
    by_chance = Window.partitionBy("v", "new").orderBy(F.xxhash64("u", F.lit(number)), "u")
    named = chosen.select(F.col("dst").alias("v"), F.col("src").alias("u"), "new").withColumn("r", F.row_number().over(by_chance))
    members = chosen.select(F.col("src").alias("v"), F.col("dst").alias("u"), "new").unionByName(named.filter(F.col("r") <= REVERSE * pool).drop("r"))
    ends = graph.select(F.col("src").alias("u"), "distance", F.lit(0).alias("named")).unionByName(
        graph.select(F.col("dst").alias("u"), F.lit(None).cast("double").alias("distance"), F.lit(1).alias("named"))
    )
    full = F.count("distance") >= pool
    stats = ends.groupBy("u").agg(F.when(full, F.max("distance")).otherwise(float("inf")).alias("worst"), F.sum("named").alias("weight"))
    known = cut_lineage(nodes.select(F.col("id").alias("u"), "vec").join(shuffled(stats), "u"))
    lists = split_join(members, known, ["u"], "weight", max(1, HUB_BYTES // (8 * dim)))
    ready = lists.select("v", "u", "new", "worst", "vec").repartition("v").sortWithinPartitions("v")

    def meet(batches):
        parts, held = [], 0
        for v, u, new, worst, m in _whole_lists(batches):
            order = np.lexsort((-new, u, v))
            first = np.ones(len(u), bool)
            first[1:] = (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])
            at = order[first]  # a member named both ways is new if either edge is
            v, u, new, worst, m = v[at], u[at], new[at] > 0, worst[at], m[at] - mean
            sq = np.einsum("ij,ij->i", m, m)
            cuts = [0, *(np.flatnonzero(v[1:] != v[:-1]) + 1), len(v)]
            pairs = []  # each pair once, as places of the batch
            for lo, hi in zip(cuts, cuts[1:]):
                n = hi - lo
                x, s2, fresh = m[lo:hi], sq[lo:hi], new[lo:hi]
                at = np.flatnonzero(fresh)
                if n < 2 or not len(at):
                    continue
                reach = worst[lo:hi] ** 2 * (1 + 1e-6) + 1e-10 * (s2 + s2.max()) + 1e-12
                ok = (s2[at, None] + s2 - 2.0 * (x[at] @ x.T)) <= np.maximum(reach[at, None], reach)
                ok &= ~fresh | (np.arange(n) > at[:, None])  # of two new members the first one meets the other
                row, col = np.divmod(np.flatnonzero(ok), n)
                pairs.append((at[row] + lo, col + lo))
            if not pairs:
                continue
            r, c = (np.concatenate(x) for x in zip(*pairs))
            for lo in range(0, len(r), MEETING):
                i, j = r[lo : lo + MEETING], c[lo : lo + MEETING]
                diff = m[i] - m[j]
                d = np.round(np.sqrt(np.einsum("ij,ij->i", diff, diff)), S.DIST_DIGITS)
                for one, other in ((i, j), (j, i)):
                    near = d <= worst[one]
                    parts.append((u[one[near]], u[other[near]], d[near]))
                    held += int(near.sum())
                if held > 200_000:
                    yield _edges(parts, pool)
                    parts, held = [], 0
        if parts:
            yield _edges(parts, pool)

    found = ready.mapInArrow(meet, "src long, dst long, distance double").withColumn("new", F.lit(1)).withColumn("fresh", F.lit(1))
    before = graph.select("src", "dst", "distance", F.when(drawn, 0).otherwise(F.col("new")).alias("new"), F.lit(0).alias("fresh"))
    return _nearest_of_each(before.unionByName(found), pool)


def nearest_of(df: DataFrame, id_col: str, vec_col: str, asked_col: str, k: int, nb: int | None = None) -> DataFrame:
    """Exact (src, dst, distance, rank) of the rows whose ``asked_col`` is true, among all rows (self excluded)."""
    shared = df.sparkSession.sparkContext.broadcast(np.array(S.mean_vector(df, vec_col)))

    def kernel(lt, rt, same):
        a, b = (S.matrix(t.column("vec")) - shared.value for t in (lt, rt))
        ida, idb = lt.column("id").to_numpy(), rt.column("id").to_numpy()
        qa, qb = (t.column(asked_col).to_numpy(zero_copy_only=False).astype(bool) for t in (lt, rt))
        yield from S._nearest(a[qa], ida[qa], b, idb, k, False)
        if not same:
            yield from S._nearest(b[qb], idb[qb], a, ida, k, False)

    found = S._run_blocks(df, id_col, vec_col, [asked_col], kernel, "src long, dst long, distance double", nb)
    return _ranked(found, k)


def _ranked(edges: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("src").orderBy("distance", "dst")
    return edges.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def node_graph(nodes: DataFrame, n: int, mean: np.ndarray, pool: int, rounds: int = ROUNDS, seed: int = 7) -> DataFrame:
    """(src, dst, distance): the written graph of distinct vectors (id, vec) after the rounds."""
    start = _start(nodes, n, len(mean), mean, pool, seed)
    graph = cut_lineage(_nearest_of_each(start.withColumn("new", F.lit(1)).withColumn("fresh", F.lit(1)), pool))
    for number in range(rounds if n > pool + 1 else 0):
        graph = cut_lineage(_round(graph, nodes, mean, pool, number))
        if graph.agg(F.sum("fresh")).first()[0] <= SETTLED * n * pool:
            break
    return graph.select("src", "dst", "distance")


def knn(df: DataFrame, id_col: str, vec_col: str, k: int = 10, pool: int | None = None, rounds: int = ROUNDS, seed: int = 7) -> DataFrame:
    """(src, dst, distance, rank), the k nearest other rows by Euclidean
    distance, approximately; distances themselves are exact (rounded to 8 places)."""
    pool = max(pool or max(POOL * k, LEAST_POOL), k)
    rows = cut_lineage(clean(df, id_col, vec_col, True))
    nodes = cut_lineage(rows.groupBy("key").agg(F.min("id").alias("id"), F.any_value("vec").alias("vec"), F.count("*").alias("n")))
    n = nodes.count()
    if n == 0:
        return df.sparkSession.createDataFrame([], "src long, dst long, distance double, rank int")
    graph = node_graph(nodes, n, np.array(S.mean_vector(nodes, "vec")), pool, rounds, seed)

    # the nodes' members: k + 1 of each are enough, as a row leaves out itself alone
    by_id = Window.partitionBy("key").orderBy("id")
    first = rows.select("key", "id").withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= k + 1)
    ids = first.join(shuffled(nodes.select("key", F.col("id").alias("node"))), "key").groupBy("node").agg(F.collect_list("id").alias("ids"))
    reached = graph.withColumnRenamed("dst", "node").unionByName(nodes.select(F.col("id").alias("src"), F.col("id").alias("node"), F.lit(0.0).alias("distance")))
    members = cut_lineage(ids.join(shuffled(reached.groupBy("node").agg(F.count("*").alias("weight"))), "node"))
    offered = split_join(reached, members, ["node"], "weight", max(1, HUB_BYTES // (8 * (k + 2)))).select("src", F.explode("ids").alias("dst"), "distance")
    best = _ranked(offered, k + 1).groupBy("src").agg(F.sort_array(F.collect_list(F.struct("distance", "dst"))).alias("near"))
    keyed = nodes.join(shuffled(best.withColumnRenamed("src", "id")), "id").select("key", "near", F.col("n").alias("weight"))
    rows_near = split_join(rows.select("key", "id"), cut_lineage(keyed), ["key"], "weight", max(1, HUB_BYTES // (16 * (k + 2))))
    others = F.slice(F.filter("near", lambda e: e["dst"] != F.col("id")), 1, k)
    found = rows_near.select(F.col("id").alias("src"), F.posexplode_outer(others).alias("p", "e"))
    found = cut_lineage(found.select("src", F.col("e.dst").alias("dst"), F.col("e.distance").alias("distance"), (F.col("p") + 1).alias("rank")))
    return _completed(rows, found, k)


def _completed(rows: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``found`` with the rows that have fewer than k neighbours asked exactly, if the table has k others."""
    have = found.groupBy("src").agg(F.count("dst").alias("n"))
    want = min(k, rows.count() - 1)
    short = have.filter(F.col("n") < want).select(F.col("src").alias("id"), F.lit(True).alias("asked"))
    if want <= 0 or short.isEmpty():
        return found.filter("dst is not null")
    asked = cut_lineage(rows.select("id", "vec").join(shuffled(short), "id", "left").select("id", "vec", F.coalesce("asked", F.lit(False)).alias("asked")))
    exact = nearest_of(asked, "id", "vec", "asked", k)
    return found.join(shuffled(have.filter(F.col("n") >= want).select("src")), "src", "left_semi").unionByName(exact)


def recall(df: DataFrame, id_col: str, vec_col: str, found: DataFrame, asked, k: int) -> DataFrame:
    """One row (asked, wanted, hits): how many of the exact k nearest of the rows for which
    ``asked`` holds are in ``found``; one as near as the k-th counts as a hit."""
    rows = clean(df, id_col, vec_col, True).select("id", "vec").withColumn("asked", asked)
    exact = nearest_of(cut_lineage(rows), "id", "vec", "asked", k)
    kth = cut_lineage(exact.groupBy("src").agg(F.max("distance").alias("kth"), F.count("*").alias("wanted")))  # read twice
    near = found.join(shuffled(kth), "src", "left").groupBy("src").agg(F.sum(F.when(F.col("distance") <= F.col("kth"), 1).otherwise(0)).alias("hits"))
    per = kth.join(shuffled(near), "src", "left")
    return per.agg(F.count("*").alias("asked"), F.coalesce(F.sum("wanted"), F.lit(0)).alias("wanted"), F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"))
