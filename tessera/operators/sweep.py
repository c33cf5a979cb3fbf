"""k-means for a whole range of k in the same scans (I17, and the assignment
step of I18), with both scores of every k from two further scans.

One scan per iteration trains all k together: a task adds up its rows per
(k, center), Spark adds up the tasks, and only centers reach the driver (the sum
of all k times dim numbers). ``dims`` lets every k look at a prefix of the
vector, which is what spectral embeddings need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import similarity as S

#: Rows (by a hash of their id) that first centers are chosen from; all rows train.
SEED_ROWS = 2048


def plus_plus(x: np.ndarray, k: int, tries: int = 10, seed: int = 42) -> np.ndarray:
    """First centers by k-means++ and a few steps on a sample, the best of ``tries``."""
    rng = np.random.default_rng(seed)
    best, least = x[:k], np.inf
    for _ in range(tries):
        centers = x[rng.integers(len(x))][None]
        d = ((x - centers[0]) ** 2).sum(1)
        while len(centers) < k:
            at = rng.choice(len(x), p=d / d.sum()) if d.sum() > 0 else rng.integers(len(x))
            centers = np.vstack([centers, x[at]])
            d = np.minimum(d, ((x - x[at]) ** 2).sum(1))
        for _ in range(10):
            far = S._sq_distances(x, centers)
            label = far.argmin(1)
            n = np.bincount(label, minlength=k)
            total = np.zeros_like(centers)
            np.add.at(total, label, x)
            centers = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers)
        loss = S._sq_distances(x, centers).min(1).sum()
        if loss < least:
            best, least = centers, loss
    return best


def fit(rows: DataFrame, ks: Sequence[int], vec_col: str = "vec", id_col: str = "id", dims: Callable[[int], int] | None = None, iterations: int = 20) -> dict[int, np.ndarray]:
    """Centers of every k (those that the rows suffice for)."""
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64(F.col(id_col), F.lit(42)), id_col).limit(SEED_ROWS).select(vec_col).collect()
    x = np.array([r[0] for r in sample], np.float64)
    width = {k: dims(k) if dims else x.shape[1] for k in ks if k <= len(x)}
    centers = {k: plus_plus(x[:, : width[k]], k) for k in width}
    for _ in range(iterations if centers else 0):
        shared = spark.sparkContext.broadcast(centers)

        def add(batches, shared=shared):
            total = {k: np.zeros((k, c.shape[1] + 1)) for k, c in shared.value.items()}
            for b in batches:
                x = S.matrix(b.column(0))
                for k, c in shared.value.items():
                    own = x[:, : c.shape[1]]
                    label = S._sq_distances(own - c[0], c - c[0]).argmin(1)
                    np.add.at(total[k], label, np.c_[own, np.ones(len(own))])
            ks_ = np.concatenate([np.full(len(t), k) for k, t in total.items()])
            cells = [v.tolist() for t in total.values() for v in t]
            yield pa.record_batch([pa.array(ks_.astype(np.int32)), pa.array(np.concatenate([np.arange(len(t)) for t in total.values()]).astype(np.int32)), pa.array(cells, pa.list_(pa.float64()))], names=["k", "c", "s"])

        sums = rows.select(vec_col).mapInArrow(add, "k int, c int, s array<double>")
        per = sums.select("k", "c", F.posexplode("s").alias("d", "v")).groupBy("k", "c", "d").agg(F.sum("v").alias("v")).collect()
        new = {k: np.zeros((k, c.shape[1] + 1)) for k, c in centers.items()}
        for r in per:
            new[r["k"]][r["c"], r["d"]] = r["v"]
        moved = 0.0
        for k, t in new.items():
            mean = np.where(t[:, -1:] > 0, t[:, :-1] / np.maximum(t[:, -1:], 1), centers[k])
            moved = max(moved, float(np.abs(mean - centers[k]).max()))
            centers[k] = mean
        if moved < 1e-9:
            break
    return centers


def labels(rows: DataFrame, centers: dict[int, np.ndarray], vec_col: str = "vec", out: str = "labels") -> DataFrame:
    """``rows`` with one label per k, in ascending k: one scan for all k."""
    shared = rows.sparkSession.sparkContext.broadcast(centers)
    at = rows.columns.index(vec_col)

    def run(batches):
        for b in batches:
            x = S.matrix(b.column(at))
            found = [S._sq_distances(x[:, : c.shape[1]] - c[0], c - c[0]).argmin(1) for _, c in sorted(shared.value.items())]
            cells = np.stack(found, 1).astype(np.int32) if found else np.zeros((len(x), 0), np.int32)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * cells.shape[1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells.ravel()))], names=[*b.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def scores(rows: DataFrame, ks: Sequence[int], vec_col: str = "vec", labels_col: str = "labels") -> DataFrame:
    """(k, silhouette_sq, calinski_harabasz) of given labels (one array entry per
    k): one scan for the clusters' sums, one for the rows' silhouettes."""
    spark, ks = rows.sparkSession, sorted(ks)
    schema = "k int, silhouette_sq double, calinski_harabasz double"
    if not ks:
        return spark.createDataFrame([], schema)
    mu = spark.sparkContext.broadcast(np.array(S.mean_vector(rows, vec_col)))

    def add(batches):
        total: dict[tuple, np.ndarray] = {}
        for b in batches:
            x = S.matrix(b.column(0))
            if not len(x):
                continue
            x = x - mu.value  # sums about the common mean keep their digits
            y = np.c_[x, np.einsum("ij,ij->i", x, x), np.ones(len(x))]
            at = S.matrix(b.column(1)).astype(np.int64)
            for j, k in enumerate(ks):
                for c in np.unique(at[:, j]).tolist():
                    s = y[at[:, j] == c].sum(0)
                    total[k, c] = total[k, c] + s if (k, c) in total else s
        if total:
            keys = list(total)
            yield pa.record_batch([pa.array([k for k, _ in keys], pa.int32()), pa.array([c for _, c in keys], pa.int32()), pa.array([total[q].tolist() for q in keys], pa.list_(pa.float64()))], names=["k", "c", "s"])

    sums = rows.select(vec_col, labels_col).mapInArrow(add, "k int, c int, s array<double>")
    clusters: dict[int, dict[int, dict[int, float]]] = {k: {} for k in ks}
    for r in sums.select("k", "c", F.posexplode("s").alias("d", "v")).groupBy("k", "c", "d").agg(F.sum("v").alias("v")).collect():
        clusters[r["k"]].setdefault(r["c"], {})[r["d"]] = r["v"]
    model, harabasz = {}, {}
    for k, by in clusters.items():
        if not by:
            continue
        s = np.array([[v[d] for d in range(len(v))] for _, v in sorted(by.items())])
        n, mean = s[:, -1], s[:, :-2] / s[:, -1:]
        ss = np.maximum(s[:, -2] - n * (mean**2).sum(1), 0)
        model[k] = (np.array(sorted(by)), n, mean, ss)
        between = float((n * ((mean - (n[:, None] * mean).sum(0) / n.sum()) ** 2).sum(1)).sum())
        within, free = float(ss.sum()), n.sum() - len(n)
        harabasz[k] = between / (len(n) - 1) / (within / free) if len(n) > 1 and free > 0 and within > 0 else None
    shared = spark.sparkContext.broadcast(model)

    def silhouettes(batches):
        total = {k: [0.0, 0] for k in shared.value}
        for b in batches:
            x = S.matrix(b.column(0))
            if not len(x):
                continue
            x = x - mu.value
            at = S.matrix(b.column(1)).astype(np.int64)
            for j, k in enumerate(ks):
                names, n, mean, ss = shared.value[k]
                own, rows_ = np.searchsorted(names, at[:, j]), np.arange(len(x))
                d = S._sq_distances(x, mean) + ss / n
                a = d[rows_, own] * n[own] / np.maximum(n[own] - 1, 1)
                d[rows_, own] = np.inf
                other = d.min(1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    s = np.where(a < other, 1 - a / other, np.where(a > other, other / a - 1, 0.0))
                total[k][0] += float(np.where((n[own] <= 1) | ~np.isfinite(other), 0.0, s).sum())
                total[k][1] += len(x)
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([v[0] for v in total.values()]), pa.array([v[1] for v in total.values()], pa.int64())], names=["k", "s", "n"])

    per = rows.select(vec_col, labels_col).mapInArrow(silhouettes, "k int, s double, n long").groupBy("k").agg((F.sum("s") / F.sum("n")).alias("silhouette_sq"))
    known = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in harabasz.items()], "k int, calinski_harabasz double")
    return per.join(F.broadcast(known), "k").select("k", "silhouette_sq", "calinski_harabasz").orderBy("k")


def k_sweep(df: DataFrame, id_col: str, vec_col: str, k_range=range(2, 31), iterations: int = 20) -> DataFrame:
    """(k, silhouette_sq, calinski_harabasz) of k-means for every k."""
    rows = df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    centers = fit(rows, list(k_range), iterations=iterations)
    return scores(labels(rows, centers), list(centers))
