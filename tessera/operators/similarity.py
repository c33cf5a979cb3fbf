"""Vector scans and pair kernels.

Three execution shapes:

* **one query against a corpus** (C4/F2): a literal query vector, cosine as
  a JVM higher-order expression, ``orderBy(...).limit(k)`` which Spark plans
  as ``TakeOrderedAndProject`` (per-task top-k, no full sort);
* **many queries against a corpus** (C4 batch): the question matrix is
  broadcast slice by slice (each of bounded bytes), every task keeps a running
  top k per question, and a final window keeps the best k of all tasks;
* **pairs inside one table** (C5, C6, I15): rows are hashed into blocks, each
  pair of blocks meets in one cogroup, and NumPy does the block products in
  tiles. A block pair only *emits* top-k per row, pairs above a threshold, or
  per-label sums -- never all pairs. The bytes of a block are bounded, so a
  task's memory does not grow with the table; n rows make n / block blocks, and
  each row travels once per block, which exact all-pairs work can't avoid.
  ``knn_lsh`` is the form for tables too large for quadratic work.

Vectors reach NumPy as the flat child array of an Arrow list column. Distances
are taken after subtracting the common mean, so data far from the origin keep
their digits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import vectors as V

# Fixed parameters.
BLOCK_BYTES = 64 << 20            # one side of a block pair
QUERY_BYTES = 32 << 20            # question vectors broadcast at a time
TILE_ROWS = 1024                  # rows of a tile of a block product
TILE_COLUMNS = 1024               # and its columns: 8 MB of distances, whatever the dimension
DIST_DIGITS = 8                   # distances rounded before ranking (engine-stable ties)


def matrix(col) -> np.ndarray:
    """A list column without NULLs as an n x dim array of doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def unit_rows(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length one (zero rows stay zero), and which are not zero."""
    n = np.sqrt(np.einsum("ij,ij->i", m, m))
    return m / np.where(n > 0, n, 1)[:, None], n > 0


def dimension(df: DataFrame, vec_col: str) -> int:
    row = df.filter(F.col(vec_col).isNotNull()).select(F.size(vec_col)).first()
    return row[0] if row else 0


def mean_vector(df: DataFrame, vec_col: str) -> list[float]:
    """The mean of all vectors (dim values)."""
    rows = df.select(F.posexplode(vec_col).alias("d", "x")).groupBy("d").agg(F.avg(F.col("x").cast("double")).alias("m")).orderBy("d").collect()
    return [r["m"] for r in rows]


# ---------------------------------------------------------------- single-query scans


def unit_vectors(df: DataFrame, id_col: str, vec_col: str, out: str = "unit") -> DataFrame:
    """Normalized vectors; zero vectors give NULL."""
    return df.select(F.col(id_col), V.normalize(vec_col).alias(out))


def cosine_topk(corpus: DataFrame, id_col: str, vec_col: str, query_vec, k: int, out: str = "similarity", digits: int = 6) -> DataFrame:
    """C4 + H12 + F2: top-k rows by cosine to one query vector (ties: id asc).

    Zero-norm rows get a NULL score and are dropped (NaN would sort first).
    """
    size = math.sqrt(sum(float(x) ** 2 for x in query_vec))
    q = V.literal_vector([float(x) / size if size else 0.0 for x in query_vec])  # one norm less per row
    norm = F.nullif(V.norm(vec_col), F.lit(0.0))
    scored = corpus.withColumn(out, (F.round(V.dot(vec_col, q) / norm, digits) + 0.0) if size else F.lit(None).cast("double"))
    # NULLs sort last and are cut after the top k: the score is evaluated once per row
    top = scored.orderBy(F.col(out).desc_nulls_last(), F.col(id_col).asc()).limit(k)
    return top.filter(F.col(out).isNotNull()).orderBy(F.col(out).desc(), F.col(id_col).asc())


def vector_of(df: DataFrame, id_col: str, vec_col: str, key) -> list[float]:
    """Fetch one vector (a bounded, single-row read) to use as a query."""
    row = df.filter(F.col(id_col) == F.lit(key)).select(vec_col).head(1)
    if not row:
        raise KeyError(f"no row with {id_col} = {key}")
    return [float(x) for x in row[0][0]]


# ---------------------------------------------------------------- many queries


def _slices(queries: DataFrame, qid_col: str, qvec_col: str, limit: int):
    """The questions as (ids, unit vectors), ``limit`` bytes of vectors at a time."""
    ids, vecs, size = [], [], 0
    for r in queries.select(F.col(qid_col).cast("long").alias("i"), F.col(qvec_col).alias("v")).filter("v is not null").toLocalIterator():
        ids.append(r["i"])
        vecs.append(np.asarray(r["v"], dtype=np.float64))
        size += vecs[-1].nbytes
        if size >= limit:
            yield np.array(ids, np.int64), unit_rows(np.stack(vecs))[0]
            ids, vecs, size = [], [], 0
    if ids:
        yield np.array(ids, np.int64), unit_rows(np.stack(vecs))[0]


def _keep_best(q, s, i, k: int):
    """Of candidates (question, score, id) the best k per question (score desc, id asc)."""
    order = np.lexsort((i, -s, q))
    q, s, i = q[order], s[order], i[order]
    first = np.searchsorted(q, q)  # where each question begins
    keep = np.arange(len(q)) - first < k
    return q[keep], s[keep], i[keep]


def batch_topk(
    corpus: DataFrame,
    id_col: str,
    vec_col: str,
    queries: DataFrame,
    qid_col: str,
    qvec_col: str,
    k: int,
    out: str = "similarity",
    digits: int = 6,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """C4 for a batch of queries: (qid, id, similarity), top k per query (ties: id asc).

    One scan of the corpus per slice of questions. A task holds its running
    top k of each question and the candidates of a few tiles."""
    schema = T.StructType([T.StructField("qid", T.LongType()), T.StructField(id_col, T.LongType()), T.StructField(out, T.DoubleType())])
    rows = corpus.select(F.col(id_col).cast("long"), F.col(vec_col)).filter(F.col(vec_col).isNotNull())
    parts = []
    for piece in _slices(queries, qid_col, qvec_col, query_bytes):
        shared = corpus.sparkSession.sparkContext.broadcast(piece)

        def part_topk(batches, shared=shared):
            qids, qm = shared.value
            held = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
            floor = np.full(len(qids), -np.inf)
            fresh, n_fresh = [held], 0

            def settle():
                best = _keep_best(*(np.concatenate(x) for x in zip(*fresh)), k)
                n = np.bincount(best[0], minlength=len(qids))
                at = np.searchsorted(best[0], np.arange(len(qids))) + k - 1
                full = n >= k
                floor[full] = best[1][at[full]]
                return best

            for b in batches:
                ids, (m, ok) = b.column(0).to_numpy(zero_copy_only=False), unit_rows(matrix(b.column(1)))
                for a in range(0, len(ids), TILE_ROWS):
                    sims = np.round(m[a : a + TILE_ROWS] @ qm.T, digits) + 0.0  # no negative zero
                    r, q = np.nonzero((sims >= floor) & ok[a : a + TILE_ROWS, None])
                    fresh.append((q, sims[r, q], ids[a : a + TILE_ROWS][r]))
                    n_fresh += len(q)
                    if n_fresh > 2 * k * len(qids):
                        fresh, n_fresh = [settle()], 0
            q, s, i = settle()
            yield pa.RecordBatch.from_arrays([pa.array(qids[q]), pa.array(i.astype(np.int64)), pa.array(s)], names=["qid", id_col, out])

        parts.append(rows.mapInArrow(part_topk, schema))
    if not parts:
        return corpus.sparkSession.createDataFrame([], schema)
    partial = parts[0]
    for p in parts[1:]:
        partial = partial.unionByName(p)
    w = Window.partitionBy("qid").orderBy(F.col(out).desc(), F.col(id_col).asc())
    return partial.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


# ---------------------------------------------------------------- block pair kernels


def n_blocks(n_rows: int, dim: int, parallelism: int, block_bytes: int = BLOCK_BYTES) -> int:
    """Enough blocks to bound a block's bytes, and enough block pairs to fill the cores."""
    by_size = math.ceil(max(n_rows, 1) * max(dim, 1) * 8 / block_bytes)
    by_cores = math.ceil(math.sqrt(2 * max(parallelism, 1)))
    return max(1, by_size, min(by_cores, max(1, n_rows // 64)))


def _run_blocks(df, id_col, vec_col, extra, kernel, schema, nb=None, within=()):
    """``kernel(left, right, same)`` on each pair of blocks, as Arrow tables (id, vec, *extra).

    With ``within``, only rows that agree on these columns (none of them NULL)
    meet: each group of rows has blocks of its own, as many as its size asks for."""
    within = list(within)
    base = df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), *[F.col(c) for c in [*within, *extra]])
    dim, cores = dimension(base, "vec"), df.sparkSession.sparkContext.defaultParallelism
    if within:
        sizes = base.groupBy(*within).agg(F.count("*").alias("n"))
        most = max(1, BLOCK_BYTES // (8 * max(dim, 1)))
        base = base.join(sizes.select(*within, (F.lit(nb) if nb else F.ceil(F.col("n") / most)).cast("int").alias("nb")), within)
    else:
        base = base.withColumn("nb", F.lit(nb or n_blocks(base.count(), dim, cores)))
    base = base.withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    left = base.select("*", F.explode(F.sequence(F.col("blk"), F.col("nb") - 1)).alias("bj")).withColumnRenamed("blk", "bi").drop("nb")
    right = base.select("*", F.explode(F.sequence(F.lit(0), F.col("blk"))).alias("bi")).withColumnRenamed("blk", "bj").drop("nb")

    def run(lt: pa.Table, rt: pa.Table) -> pa.Table:
        empty = not lt.num_rows or not rt.num_rows
        same = not empty and lt.column("bi")[0] == lt.column("bj")[0]
        cols = [] if empty else list(kernel(lt, rt, same))
        names = [f.split(" ")[0] for f in schema.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
        types = [kinds[f.split(" ")[1]] for f in schema.split(", ")]
        if not cols:
            return pa.table([pa.array([], t) for t in types], names=names)
        return pa.table([pa.array(np.concatenate(c)).cast(t) for c, t in zip(zip(*cols), types)], names=names)

    # each side has key columns of its own, as both come from one table
    keys = [f"in{k}" for k in range(len(within))]
    left, right = (side.select(*(F.col(c).alias(c) for c in ["id", "vec", "bi", "bj", *extra]), *(F.col(c).alias(k) for c, k in zip(within, keys))) for side in (left, right))
    keys += ["bi", "bj"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _tiles(n: int, rows: int = TILE_ROWS):
    return ((a, min(a + rows, n)) for a in range(0, n, rows))


def _sq_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    an, bn = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    return np.maximum(an[:, None] + bn[None, :] - 2.0 * (a @ b.T), 0.0)


def _bound_factors(x: np.ndarray, s: np.ndarray, scale: float, slack: float, left: bool) -> np.ndarray:
    """Single-precision rows whose products are lower bounds of the squared distances:
    the squared norms enter smaller by ``slack``, more than such a product can be off."""
    own, one = ((1 - slack) * s / scale**2)[:, None], np.ones((len(s), 1))
    return np.hstack([-2.0 * x / scale, own, one] if left else [x / scale, one, own]).astype(np.float32)


def _nearest(a, ida, b, idb, k: int, include_self: bool):
    """For each row of a its k nearest of b: (src, dst, distance), by exact
    differences. Tiles on both sides: memory is that of a tile, whatever the
    blocks' size or dimension. A tile's shortlist are the pairs whose lower bound
    is within the k-th distance found so far, or k-th upper bound of the tile
    for rows with fewer than k."""
    sa, sb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    scale = np.sqrt(max((s[np.isfinite(s)].max(initial=0.0) for s in (sa, sb)), default=0.0)) or 1.0
    off = (a.shape[1] + 8) * 2.0**-23
    with np.errstate(over="ignore", invalid="ignore"):
        fb = _bound_factors(b, sb, scale, off, left=False)
        for lo, hi in _tiles(len(a)):
            x, ix = a[lo:hi], ida[lo:hi]
            fx, sx = _bound_factors(x, sa[lo:hi], scale, off, left=True), sa[lo:hi] / scale**2
            best = np.zeros(0, np.int64), np.zeros(0, idb.dtype), np.zeros(0)
            reach = np.full(hi - lo, np.inf)  # the k-th distance so far
            fresh, n_fresh = [best], 0
            for left, right in _tiles(len(b), TILE_COLUMNS):
                low = fx @ fb[left:right].T
                if not include_self:
                    low[ix[:, None] == idb[None, left:right]] = np.inf
                # distances equal after rounding are ties
                limit = (reach + 2.0**-26) ** 2 / scale**2
                some = np.flatnonzero(np.isinf(reach))
                if len(some):
                    kk = min(k, right - left)
                    most = np.fmax.reduce(sb[left:right]) / scale**2
                    limit[some] = np.partition(low[some], kk - 1, axis=1)[:, kk - 1] + 2 * off * (sx[some] + most) + 2.0**-26
                    limit[some] = (np.sqrt(np.maximum(limit[some], 0)) + 2.0**-25 / scale) ** 2
                r, c = np.nonzero(low <= (limit * (1 + 1e-6) + 1e-30).astype(np.float32)[:, None])
                r, c = (y[np.isfinite(low[r, c])] for y in (r, c))
                c += left
                exact = np.empty(len(r))
                step = max(1, (TILE_ROWS * TILE_COLUMNS) // max(1, x.shape[1]))
                for s, e in _tiles(len(r), step):
                    diff = x[r[s:e]] - b[c[s:e]]
                    exact[s:e] = np.round(np.sqrt(np.einsum("ij,ij->i", diff, diff)), DIST_DIGITS)
                near = exact <= reach[r]
                fresh.append((r[near], idb[c[near]], exact[near]))
                n_fresh += int(near.sum())
                if len(some) or n_fresh > k * (hi - lo) or right == len(b):
                    r, i, exact = (np.concatenate(y) for y in zip(*fresh))
                    order = np.lexsort((i, exact, r))
                    r, i, exact = r[order], i[order], exact[order]
                    place = np.arange(len(r)) - np.searchsorted(r, r)
                    best = r[place < k], i[place < k], exact[place < k]
                    reach[r[place == k - 1]] = exact[place == k - 1]
                    fresh, n_fresh = [best], 0
            yield ix[best[0]], best[1], best[2]


def knn(df: DataFrame, id_col: str, vec_col: str, k: int = 10, include_self: bool = True, nb: int | None = None, within=()) -> DataFrame:
    """E3/C6 (directed): (src, dst, distance, rank) for the k nearest by Euclidean distance.

    Exact. Each block pair proposes at most k candidates per row; the final
    row_number per src keeps the k best. Distances are rounded to 8 places
    before ranking; ties by dst id. With ``within``, neighbours are those of the
    same group of rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(np.array(mean_vector(df, vec_col)))

    def kernel(lt, rt, same):
        a, b = matrix(lt.column("vec")) - shared.value, matrix(rt.column("vec")) - shared.value
        ida, idb = lt.column("id").to_numpy(), rt.column("id").to_numpy()
        yield from _nearest(a, ida, b, idb, k, include_self)
        if not same:
            yield from _nearest(b, idb, a, ida, k, include_self)

    cand = _run_blocks(df, id_col, vec_col, [], kernel, "src long, dst long, distance double", nb, within)
    w = Window.partitionBy("src").orderBy(F.col("distance").asc(), F.col("dst").asc())
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_graph(df: DataFrame, id_col: str, vec_col: str, k: int = 10, nb: int | None = None, within=()) -> DataFrame:
    """Symmetrized connectivity ``W = (A + A^T) / 2`` of the kNN graph (self included).

    (src, dst, weight) with weight 1.0 for mutual neighbours and 0.5 otherwise.
    """
    a = knn(df, id_col, vec_col, k, include_self=True, nb=nb, within=within).select("src", "dst")
    return symmetric(a)


def symmetric(a: DataFrame) -> DataFrame:
    """``(A + A^T) / 2`` of a directed graph (src, dst)."""
    both = a.select("src", "dst", F.lit(0.5).alias("w")).unionByName(
        a.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0.5).alias("w"))
    )
    return both.groupBy("src", "dst").agg(F.sum("w").alias("weight"))


def pairwise_similarity(df: DataFrame, id_col: str, vec_col: str, threshold: float, nb: int | None = None, digits: int = 6) -> DataFrame:
    """All pairs (id_a < id_b) with cosine >= threshold, computed block by block."""

    def kernel(lt, rt, same):
        (a, oka), (b, okb) = unit_rows(matrix(lt.column("vec"))), unit_rows(matrix(rt.column("vec")))
        ida, idb = lt.column("id").to_numpy(), rt.column("id").to_numpy()
        for lo, hi in _tiles(len(a)):
            for left, right in _tiles(len(b), TILE_COLUMNS):
                s = np.round(a[lo:hi] @ b[left:right].T, digits) + 0.0
                ok = (s >= threshold) & oka[lo:hi, None] & okb[None, left:right]
                i, j = ida[lo:hi, None], idb[None, left:right]
                r, c = np.nonzero(ok & ((i < j) if same else (i != j)))
                x, y = ida[lo:hi][r], idb[left:right][c]
                yield np.minimum(x, y), np.maximum(x, y), s[r, c]

    return _run_blocks(df, id_col, vec_col, [], kernel, "id_a long, id_b long, similarity double", nb)


def label_distance_sums(df: DataFrame, id_col: str, vec_col: str, label_col: str, nb: int | None = None) -> DataFrame:
    """I15 pair stage: (id, label, other_label, sum_dist, n) -- Euclidean distance sums
    from each row to every cluster, self excluded. Output is rows x labels."""
    shared = df.sparkSession.sparkContext.broadcast(np.array(mean_vector(df, vec_col)))

    def members(t):
        """A block in the order of its labels: vectors, ids, labels, the distinct ones,
        their rows, and of each tile where its labels begin."""
        labels = t.column(label_col).to_numpy()
        order = np.argsort(labels, kind="stable")
        x, ids, labels = (matrix(t.column("vec")) - shared.value)[order], t.column("id").to_numpy()[order], labels[order]
        names, code = np.unique(labels, return_inverse=True)
        tiles = []
        for lo, hi in _tiles(len(code), TILE_ROWS):
            own = code[lo:hi]
            at = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            tiles.append((lo, hi, at, own[at]))
        return x, ids, labels, names, np.bincount(code, minlength=len(names)).astype(np.int64), tiles

    def found(ids, labels, total, names, size):
        n, k = total.shape
        return np.repeat(ids, k), np.repeat(labels, k), np.tile(names, n), total.ravel(), np.tile(size, n)

    def kernel(lt, rt, same):
        a, ida, la, names_a, size_a, tiles_a = members(lt)
        b, idb, lb, names_b, size_b, tiles_b = members(rt)
        # a tile's distances are added up by rows and, of two blocks, by columns too
        back = None if same else np.zeros((len(b), len(names_a)))
        for lo, hi, at_a, of_a in tiles_a:
            total = np.zeros((hi - lo, len(names_b)))
            for left, right, at_b, of_b in tiles_b:
                d = np.sqrt(_sq_distances(a[lo:hi], b[left:right]))
                if same:  # blocks are hashes of the ids: equal ids share one
                    d[ida[lo:hi, None] == idb[None, left:right]] = 0.0
                else:
                    back[left:right, of_a] += np.add.reduceat(d, at_a, axis=0).T
                total[:, of_b] += np.add.reduceat(d, at_b, axis=1)
            yield found(ida[lo:hi], la[lo:hi], total, names_b, size_b)
        if not same:
            yield found(idb, lb, back, names_a, size_a)

    schema = "id long, label int, other_label int, sum_dist double, n long"
    parts = _run_blocks(df, id_col, vec_col, [label_col], kernel, schema, nb)
    return parts.groupBy("id", "label", "other_label").agg(F.sum("sum_dist").alias("sum_dist"), F.sum("n").alias("n"))


def knn_lsh(df: DataFrame, id_col: str, vec_col: str, k: int = 10, radius: float = 1.0, bucket_length: float = 1.0, tables: int = 4, seed: int = 42) -> DataFrame:
    """C6 at large n (approximate): MLlib ``BucketedRandomProjectionLSH``
    self-join within ``radius``, then the k nearest per source.

    Candidate pairs only come from shared hash buckets, so the work is not
    quadratic; the result is approximate (a true neighbour in no shared
    bucket, or farther than ``radius``, is missed, so a row may have fewer
    than k). Use ``knn`` when exact neighbours are required.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH

    feats = df.select(F.col(id_col).cast("long").alias("id"), V.to_ml_vector(F.col(vec_col)).alias("features"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed).fit(feats)
    pairs = model.approxSimilarityJoin(feats, feats, radius, distCol="distance").select(
        F.col("datasetA.id").alias("src"), F.col("datasetB.id").alias("dst"), F.round("distance", DIST_DIGITS).alias("distance")
    )
    w = Window.partitionBy("src").orderBy(F.col("distance").asc(), F.col("dst").asc())
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
