"""Spectral clustering on the kNN graph, distributed.

The normalised adjacency matrix A = D^-1/2 W D^-1/2 of the graph is an edge
table; the spectral embedding is its leading eigenvectors, scaled by D^-1/2. They
are found by a block Krylov method with restarts:

* nodes are dealt into parts by a hash of their ids, as many as keep a part's
  share of a cycle's blocks below ``PART_BYTES``. A part has its nodes' outgoing
  edges, laid out once, and its rows of a block of m vectors. A times a block is
  one exchange: a part sends each other part the sums over its own edges, one row
  per target (a block is never gathered on the driver to be broadcast);
* a cycle builds the Chebyshev blocks T_0 X .. T_q+1 X (T_j+1 = 2 A T_j - T_j-1)
  and adds up their Gram matrix, in one job. As A T_j is half of T_j+1 + T_j-1,
  that matrix alone gives the Rayleigh-Ritz problem and the residuals |A v - theta v|;
* the driver solves it (numbers: parents x (m (q + 2))^2) and tasks combine the
  blocks to the next X, row by row, until the residuals are small. X is written.

Edges only join rows of one parent, so all parents of a level are one
block-diagonal matrix: a level costs the same number of jobs whatever its number
of parents, and no parent is gathered anywhere. A repeated id is one node; rows with
a NULL id are none.
"""

from __future__ import annotations

import math
import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffled
from . import similarity as S
from . import sweep
from .cluster import split_level

NEIGHBOURS = 10
DEGREES = 7, 16   # least and most Chebyshev blocks of a cycle, besides the first
GRAM = 400        # rows of a Gram matrix that the number of blocks aims at
SPARE = 4         # vectors of a block beyond those asked for
TOLERANCE = 1e-5  # of a residual
LOOSE = 1e-3      # of one whose vectors are only grouped
CYCLES = 12
PART_BYTES = 32 << 20  # of a part's rows of all blocks of a cycle
LEAST_NODES = 4096     # of a part, on average


class Embedding(NamedTuple):
    """``rows``: p, id, vec (eigenvectors, by descending eigenvalue, scaled by
    degree); per parent number p the eigenvalues of A and the residuals."""

    rows: DataFrame
    values: dict[int, np.ndarray]
    residuals: dict[int, np.ndarray]


class Part(NamedTuple):
    """The nodes of a part and the edges that leave them, ordered by the part and id
    of their target. A node without edges is a component of its own (``alone``)."""

    ids: np.ndarray      # ascending
    p: np.ndarray
    root: np.ndarray     # of a node's degree
    alone: np.ndarray
    source: np.ndarray   # of each edge, its place in ids
    weight: np.ndarray   # of each edge, over its source's root
    begins: np.ndarray   # first edge of each target
    targets: np.ndarray
    to: list[tuple]      # (part, its first and last edge, its first and last target)


def _laid_out(nodes: DataFrame, edges: DataFrame, m: int, parts: int) -> DataFrame:
    """(part, graph, x), written: of each part its pickled ``Part`` and its rows of the first block."""

    def place(c):
        return F.pmod(F.xxhash64(c, F.lit(11)), F.lit(parts)).cast("int")

    first = F.array(*(F.xxhash64("id", F.lit(j)) / F.lit(2.0**63) for j in range(m)))
    own = nodes.where("id IS NOT NULL").select(place("id").alias("part"), F.col("p").cast("int").alias("p"), "id", first.alias("x"))
    out = edges.where("src <> dst").select(place("src").alias("part"), place("dst").alias("to"), "src", "dst", F.col("weight").cast("double").alias("weight"))

    def pack(own: pa.Table, out: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table({"part": pa.array([], pa.int32()), "graph": pa.array([], pa.binary()), "x": pa.array([], pa.binary())})
        ids, at = np.unique(own.column("id").to_numpy(), return_index=True)
        src, dst, to, weight = (out.column(c).to_numpy() for c in ("src", "dst", "to", "weight"))
        source = np.minimum(np.searchsorted(ids, src), len(ids) - 1)
        order = np.lexsort((dst, to))
        order = order[ids[source[order]] == src[order]]
        source, dst, to, weight = source[order], dst[order], to[order], weight[order]
        degree = np.bincount(source, weight, len(ids))
        root = np.sqrt(np.where(degree > 0, degree, 1.0))
        begins = np.flatnonzero(np.r_[True, (dst[1:] != dst[:-1]) | (to[1:] != to[:-1])]) if len(dst) else np.zeros(0, np.int64)
        places, edge = np.unique(to, return_index=True)
        edge = np.r_[edge, len(to)]
        target = np.searchsorted(begins, edge)
        spans = [(int(q), *(int(v) for v in (edge[i], edge[i + 1], target[i], target[i + 1]))) for i, q in enumerate(places)]
        graph = Part(ids, own.column("p").to_numpy()[at], root, degree == 0, source, weight / root[source], begins, dst[begins], spans)
        x = S.matrix(own.column("x"))[at]
        return pa.table({"part": own.column("part")[:1], "graph": pa.array([pickle.dumps(tuple(graph))], pa.binary()), "x": pa.array([x.tobytes()], pa.binary())})

    return cut_lineage(own.groupBy("part").cogroup(out.groupBy("part")).applyInArrow(pack, "part int, graph binary, x binary"))


def _same_place(part: int) -> int:
    return part


def _dealt(table: DataFrame, col: str, key, parts: int) -> RDD:
    """(part, (key, blob)), part by part in the partition of its number."""
    return table.select("part", col).rdd.map(lambda r: (r[0], (key, bytes(r[1])))).partitionBy(parts, _same_place)


def _by_part(elements):
    """(part, {key: value}, received sums by the part they come from) of one partition's elements; ``graph`` and blocks as arrays."""
    held: dict[int, dict] = {}
    for part, (key, *value) in elements:
        own = held.setdefault(part, {"sums": {}})
        if key == "sums":
            own["sums"][value[0]] = value[1:]
        else:
            own[key] = Part(*pickle.loads(value[0])) if key == "graph" else value[0]
    for part, own in held.items():
        if "graph" in own:  # a part without nodes has none
            n = len(own["graph"].ids)
            yield part, {k: np.frombuffer(v, np.float64).reshape(n, -1) if isinstance(k, int) else v for k, v in own.items()}


def _times(graph: RDD, block: RDD, j: int, factor: float, parts: int, less: RDD | None = None) -> RDD:
    """Block j + 1: factor * A * block j - block j - 1, kept on the executors' disks."""

    first_two = less is None

    def send(elements):
        for part, own in _by_part(elements):
            g, x = own["graph"], own[j]
            for q, lo, hi, first, last in g.to:
                sums = np.add.reduceat(x[g.source[lo:hi]] * g.weight[lo:hi, None], g.begins[first:last] - lo, axis=0)
                yield q, ("sums", part, g.targets[first:last], sums)

    def receive(elements):
        for part, own in _by_part(elements):
            g, x = own["graph"], own[j]
            out = np.zeros_like(x)
            for _, (ids, sums) in sorted(own["sums"].items()):
                at = np.minimum(np.searchsorted(g.ids, ids), len(g.ids) - 1)
                known = g.ids[at] == ids
                out[at[known]] += sums[known]
            out = factor * (out / g.root[:, None] + g.alone[:, None] * x)
            yield part, (j + 1, (out if first_two else out - own[j - 1]).tobytes())

    sc = graph.context
    sent = sc.union([graph, block]).mapPartitions(send).partitionBy(parts, _same_place)
    return sc.union([graph, block, sent] if first_two else [graph, block, less, sent]).mapPartitions(receive, preservesPartitioning=True).persist(StorageLevel.DISK_ONLY)


def _gram(graph: RDD, blocks: list[RDD], parts: int) -> dict[int, np.ndarray]:
    """Per parent the Gram matrix of the blocks' columns; a part emits one partial matrix per parent."""
    count = len(blocks)

    def partial(elements):
        for _, own in _by_part(elements):
            basis, p = np.hstack([own[j] for j in range(count)]), own["graph"].p
            for v in np.unique(p).tolist():
                rows = basis[p == v]
                yield v, rows.T @ rows

    return dict(graph.context.union([graph, *blocks]).mapPartitions(partial).reduceByKey(lambda a, b: a + b, parts).collect())


def _ritz(gram: np.ndarray, m: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients, Ritz values, residuals) of the m leading vectors in the
    span of all blocks but the last."""
    n = m * (blocks - 1)
    step = np.zeros((m * blocks, n))  # A times the basis, in the basis of all blocks
    eye = np.eye(m)
    step[m : 2 * m, :m] = eye
    for j in range(1, blocks - 1):
        step[(j + 1) * m : (j + 2) * m, j * m : (j + 1) * m] = eye / 2
        step[(j - 1) * m : j * m, j * m : (j + 1) * m] = eye / 2
    scale = np.sqrt(np.maximum(np.diag(gram)[:n], 1e-300))
    size, vectors = np.linalg.eigh(gram[:n, :n] / np.outer(scale, scale))
    kept = size > 1e-11 * size[-1]
    white = vectors[:, kept] / np.sqrt(size[kept]) / scale[:, None]
    h = white.T @ (gram[:n] @ step) @ white
    theta, u = np.linalg.eigh((h + h.T) / 2)
    theta, c = theta[::-1][:m], (white @ u[:, ::-1])[:, :m]
    full = step @ c
    full[:n] -= c * theta
    residual = np.sqrt(np.maximum(np.einsum("ij,ij->j", full, gram @ full), 0))
    return c, theta, residual


def embed(nodes: DataFrame, edges: DataFrame, k: int, tolerance: float = TOLERANCE, cycles: int = CYCLES) -> Embedding:
    """The k leading vectors of every parent's graph. ``nodes``: (p, id), each
    parent of k rows at least; ``edges``: (src, dst, weight), symmetric, within
    parents."""
    m = k + SPARE
    q = min(max(GRAM // m - 2, DEGREES[0]), DEGREES[1])
    count = q + 2
    spark, n = nodes.sparkSession, nodes.count()
    parts = max(1, math.ceil(8 * n * m * count / PART_BYTES), min(spark.sparkContext.defaultParallelism, n // LEAST_NODES))
    table = _laid_out(nodes, edges, m, parts)
    graph, x, solved = _dealt(table, "graph", "graph", parts), table.select("part", "x"), {}
    for _ in range(cycles):
        blocks = [_dealt(x, "x", 0, parts)]
        while len(blocks) < count:
            j = len(blocks) - 1
            blocks.append(_times(graph, blocks[j], j, 2.0 if j else 1.0, parts, *blocks[j - 1 : j]))
        solved = {p: _ritz(g, m, count) for p, g in _gram(graph, blocks, parts).items()}
        shared = spark.sparkContext.broadcast({p: c for p, (c, _, _) in solved.items()})

        def combine(elements, shared=shared):
            for part, own in _by_part(elements):
                whole, p = np.hstack([own[j] for j in range(count - 1)]), own["graph"].p
                out = np.zeros((len(p), m))
                for v in np.unique(p).tolist():
                    c = shared.value[v]
                    out[p == v, : c.shape[1]] = whole[p == v] @ c
                yield part, out.tobytes()

        x = cut_lineage(spark.createDataFrame(spark.sparkContext.union([graph, *blocks[:-1]]).mapPartitions(combine), "part int, x binary"))
        for b in blocks[1:]:
            b.unpersist()
        worst = max((r[:k].max() for _, _, r in solved.values()), default=0.0)
        if worst <= tolerance:
            break

    def rows(batches):
        for b in batches:
            for graph, x in zip(b.column(0), b.column(1)):
                g = Part(*pickle.loads(graph.as_py()))
                vec = np.ascontiguousarray(np.frombuffer(x.as_py(), np.float64).reshape(len(g.ids), m)[:, :k]) / g.root[:, None]
                offsets = pa.array(np.arange(len(g.ids) + 1, dtype=np.int32) * k)
                yield pa.record_batch([pa.array(g.p), pa.array(g.ids), pa.ListArray.from_arrays(offsets, pa.array(vec.ravel()))], names=["p", "id", "vec"])

    scaled = table.select("part", "graph").join(shuffled(x), "part").select("graph", "x").mapInArrow(rows, "p int, id long, vec array<double>")
    return Embedding(scaled, {p: t[:k] for p, (_, t, _) in solved.items()}, {p: r[:k] for p, (_, _, r) in solved.items()})


def _first_centers(rows: DataFrame, parents: list[str], k: int) -> dict[tuple, np.ndarray]:
    """First centers of every parent by k-means++ on a few hundred of its rows
    (by a hash of their ids; a top-k with a partial limit in every task)."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(*parents).orderBy(F.xxhash64("id", F.lit(7)), "id")
    picked = rows.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= 32 * k).select(*parents, "r", "vec").collect()
    by: dict[tuple, list] = {}
    for r in sorted(picked, key=lambda r: r["r"]):
        by.setdefault(tuple(r[p] for p in parents), []).append(r["vec"])
    return {key: sweep.plus_plus(np.array(v, np.float64), k) for key, v in by.items()}


def split_level_spectral(rows: DataFrame, parents: list[str], out: str, k: int, neighbours: int = NEIGHBOURS, iterations: int = 20) -> DataFrame:
    """``rows`` (id, vec, *parents) with ``out``: spectral clusters inside every
    parent that has k rows at least, NULL elsewhere."""
    known = F.lit(True)
    for p in parents:
        known = known & F.col(p).isNotNull()
    sizes = rows.where(known).groupBy(*parents).agg(F.count("*").alias("n")).where(F.col("n") >= k).collect()  # a row per parent
    if not sizes:
        return rows.withColumn(out, F.lit(None).cast("int"))
    spark = rows.sparkSession
    names = sorted(tuple(r[p] for p in parents) for r in sizes)
    schema = ", ".join([*(f"{p} int" for p in parents), "p int"])
    numbers = spark.createDataFrame([(*name, i) for i, name in enumerate(names)], schema)
    active = rows.select("id", "vec", *parents)
    active = cut_lineage(active.join(F.broadcast(numbers), parents) if parents else active.withColumn("p", F.lit(0)))
    edges = cut_lineage(S.knn_graph(active, "id", "vec", neighbours, within=["p"] if parents else ()))
    found = embed(active, edges, k, LOOSE)
    labelled = split_level(cut_lineage(found.rows.select("id", "vec", "p")), ["p"], out, k, iterations, first=_first_centers)
    return rows.join(shuffled(labelled.select("id", out)), "id", "left")


def three_level_spectral(df: DataFrame, id_col: str, vec_col: str, ks=(12, 6, 3), neighbours: int = NEIGHBOURS) -> DataFrame:
    """(id, level_1, level_2, level_3)."""
    rows = df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    parents: list[str] = []
    for i, k in enumerate(ks):
        rows = cut_lineage(split_level_spectral(rows, parents, f"level_{i + 1}", k, neighbours))
        parents = [*parents, f"level_{i + 1}"]
    return rows.select(F.col("id").alias(id_col), *parents)


def spectral_sweep(df: DataFrame, id_col: str, vec_col: str, k_range=range(2, 31), neighbours: int = NEIGHBOURS) -> tuple[DataFrame, DataFrame]:
    """One graph and one embedding for all k, one k-means sweep over its
    prefixes. (id, labels: one per k) and (k, silhouette_sq, calinski_harabasz),
    scored on the original vectors."""
    rows = cut_lineage(df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.lit(0).alias("p")))
    ks = [k for k in k_range if k <= rows.count()]
    if not ks:
        empty = rows.select(F.col("id").alias(id_col), F.array().cast("array<int>").alias("labels"))
        return empty, sweep.scores(rows, [])
    edges = cut_lineage(S.knn_graph(rows, "id", "vec", neighbours))
    found = cut_lineage(embed(rows, edges, max(ks), LOOSE).rows.select("id", "vec"))
    centers = sweep.fit(found, ks, dims=lambda k: k)
    labelled = sweep.labels(found, centers).select("id", "labels")
    both = cut_lineage(rows.select("id", F.col("vec").alias("vec")).join(shuffled(labelled), "id"))
    return both.select(F.col("id").alias(id_col), "labels"), sweep.scores(both, list(centers))
