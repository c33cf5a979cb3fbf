"""Clustering on distributed algorithms.

Ward linkage and spectral embedding need all pairs of rows in one place, so
they are re-aimed (see README): the topic levels are k-means levels, one
distributed pass per iteration for *all* parents of a level at once, and the
flat hierarchical clustering is MLlib's BisectingKMeans (a divisive tree).
Only models (centers) reach the driver: k x dim numbers per parent.

Gates follow the reference: a parent splits only when its row count is at
least k; otherwise the lower level stays NULL.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from ..session import cut_lineage
from . import similarity as S

SEED = 42
ITERATIONS = 10


# ---------------------------------------------------------------- MLlib


def kmeans(df: DataFrame, id_col: str, vec_col: str, k: int = 30, seed: int = SEED) -> DataFrame:
    """MLlib KMeans (k-means||), (id, label)."""
    return kmeans_model(df, id_col, vec_col, k, seed)[0]


def kmeans_model(df: DataFrame, id_col: str, vec_col: str, k: int = 30, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """I11 with its centers (k x dim)."""
    from pyspark.ml.clustering import KMeans

    feats = df.select(F.col(id_col), V.to_ml_vector(F.col(vec_col)).alias("features"))
    model = KMeans(k=k, seed=seed, initMode="k-means||", featuresCol="features", predictionCol="label").fit(feats)
    return model.transform(feats).select(id_col, F.col("label").cast("int")), np.array(model.clusterCenters())


def bisecting(df: DataFrame, id_col: str, vec_col: str, k: int = 30, seed: int = SEED) -> DataFrame:
    """I13 (re-aimed): hierarchical clusters by MLlib BisectingKMeans, (id, label)."""
    from pyspark.ml.clustering import BisectingKMeans

    feats = df.select(F.col(id_col), V.to_ml_vector(F.col(vec_col)).alias("features"))
    model = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="label").fit(feats)
    return model.transform(feats).select(id_col, F.col("label").cast("int"))


def pca_2d(df: DataFrame, id_col: str, vec_col: str, k: int = 2) -> DataFrame:
    """Principal components after centring (MLlib's PCA does not centre);
    each component's sign is fixed so its largest loading is positive."""
    from pyspark.ml.feature import PCA

    mu = F.array(*[F.lit(v) for v in S.mean_vector(df, vec_col)])
    centred = df.select(F.col(id_col), V.to_ml_vector(F.zip_with(F.col(vec_col), mu, lambda a, b: a.cast("double") - b)).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(centred)
    pc = model.pc.toArray()
    signs = [1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0 for j in range(k)]
    proj = model.transform(centred).select(F.col(id_col), V.from_ml_vector("pc").alias("pc"))
    return proj.select(F.col(id_col), *[(F.col("pc")[j] * F.lit(signs[j])).alias(f"pc{j + 1}") for j in range(k)])


# ---------------------------------------------------------------- topic levels


def _first_centers(rows: DataFrame, parents: list[str], k: int) -> dict[tuple, np.ndarray]:
    """k rows of each parent as first centers, by a hash of their ids (a top-k
    with a partial limit in every task; no parent is gathered anywhere)."""
    from pyspark.sql.window import Window

    rows = rows.withColumn("h", F.xxhash64("id", F.lit(SEED)))
    if parents:
        w = Window.partitionBy(*parents).orderBy("h", "id")
        rows = rows.withColumn("c", F.row_number().over(w)).filter(F.col("c") <= k)
    else:
        rows = rows.orderBy("h", "id").limit(k)
    centers: dict[tuple, list] = {}
    for r in sorted(rows.select(*parents, "h", "id", "vec").collect(), key=lambda r: (r["h"], r["id"])):
        centers.setdefault(tuple(r[p] for p in parents), []).append(np.asarray(r["vec"], dtype=np.float64))
    return {key: np.stack(c) for key, c in centers.items()}


def _assigner(centers: dict[tuple, np.ndarray], n_parents: int):
    """Partial sums (parents, c, dim values and count) or labels of Arrow batches."""

    def label(ids, vec, parent):
        x = S.matrix(vec)
        out = np.full(len(ids), -1, np.int64)
        keys = list(zip(*(p.to_pylist() for p in parent))) if n_parents else [()] * len(ids)
        groups: dict[tuple, list[int]] = {}
        for i, key in enumerate(keys):
            groups.setdefault(key, []).append(i)
        for key, at in groups.items():
            if key in centers:
                c = centers[key]
                y = x[at]
                # relative to the first center: rows far from the origin keep their digits
                d = S._sq_distances(y - c[0], c - c[0])
                out[at] = d.argmin(1)
        return x, out

    return label


def split_level(rows: DataFrame, parents: list[str], out: str, k: int, iterations: int = ITERATIONS, first=_first_centers) -> DataFrame:
    """``rows`` (id, vec, *parents) with ``out``: k-means inside every parent that
    has k rows at least, NULL elsewhere.

    One iteration is one scan for all parents: tasks assign their rows and emit
    one sum per (parent, center); those are added up and the centers broadcast
    again (parents x k x dim numbers, the model)."""
    spark, n = rows.sparkSession, len(parents)
    known = F.lit(True)
    for p in parents:
        known = known & F.col(p).isNotNull()
    base = rows.filter(known)
    if parents:
        sizes = base.groupBy(*parents).agg(F.count("*").alias("_n"))
        base = cut_lineage(base.join(sizes.filter(F.col("_n") >= k).drop("_n"), parents, "left_semi"))  # read in every iteration
    elif base.limit(k).count() < k:
        return rows.withColumn(out, F.lit(None).cast("int"))
    centers = first(base, parents, k)
    fields = [T.StructField(p, base.schema[p].dataType) for p in parents]
    for _ in range(iterations if centers else 0):
        shared = spark.sparkContext.broadcast(centers)

        def sums(batches, shared=shared):
            import pyarrow as pa

            label = _assigner(shared.value, n)
            total: dict[tuple, np.ndarray] = {}
            types = []
            for b in batches:
                types = [b.column(j).type for j in range(n)]
                parent = [b.column(j) for j in range(n)]
                x, at = label(b.column(n), b.column(n), parent)
                keys_ = list(zip(*(p.to_pylist() for p in parent))) if n else [()] * len(at)
                order: dict[tuple, list[int]] = {}
                for i, key in enumerate(keys_):
                    if at[i] >= 0:
                        order.setdefault((*key, int(at[i])), []).append(i)
                for key, rows_ in order.items():
                    add = np.r_[x[rows_].sum(0), len(rows_)]
                    total[key] = total[key] + add if key in total else add
            if total:
                cols = list(zip(*total))
                arrays = [pa.array(c, t) for c, t in zip(cols, types)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(cols[-1], pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=[*parents, "c", "s"])

        schema = T.StructType([*fields, T.StructField("c", T.IntegerType()), T.StructField("s", T.ArrayType(T.DoubleType()))])
        parts = base.select(*parents, "vec").mapInArrow(sums, schema)
        added = parts.select(*parents, "c", F.posexplode("s").alias("d", "v")).groupBy(*parents, "c", "d").agg(F.sum("v").alias("v")).collect()
        new: dict[tuple, dict[int, dict[int, float]]] = {}
        for r in added:
            new.setdefault(tuple(r[p] for p in parents), {}).setdefault(r["c"], {})[r["d"]] = r["v"]
        moved = 0.0
        for key, by_center in new.items():
            for c, v in by_center.items():
                dim = len(v) - 1
                mean = np.array([v[d] for d in range(dim)]) / v[dim]
                moved = max(moved, float(np.abs(mean - centers[key][c]).max()))
                centers[key][c] = mean
        if moved < 1e-6:
            break
    shared = spark.sparkContext.broadcast(centers)
    at_parent = [rows.columns.index(p) for p in parents]
    at_vec = rows.columns.index("vec")

    def label_rows(batches):
        import pyarrow as pa

        label = _assigner(shared.value, n)
        for b in batches:
            _, at = label(b.column(at_vec), b.column(at_vec), [b.column(j) for j in at_parent])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32), mask=at < 0)], names=[*b.schema.names, out])

    return rows.mapInArrow(label_rows, T.StructType([*rows.schema.fields, T.StructField(out, T.IntegerType())]))


def three_level(df: DataFrame, id_col: str, vec_col: str, ks=(12, 6, 3), iterations: int = ITERATIONS) -> DataFrame:
    """I19 (re-aimed): (id, level_1, level_2, level_3) by k-means levels."""
    rows = df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    parents: list[str] = []
    for i, k in enumerate(ks):
        rows = cut_lineage(split_level(rows, parents, f"level_{i + 1}", k, iterations))
        parents = [*parents, f"level_{i + 1}"]
    return rows.select(F.col("id").alias(id_col), *parents)


# ---------------------------------------------------------------- rows with clusters


def clustered_rows(df: DataFrame, id_col: str, vec_col: str, k: int = 30, seed: int = SEED) -> DataFrame:
    """Every row with both flat clusterings attached by an id join."""
    km = kmeans(df, id_col, vec_col, k, seed).withColumnRenamed("label", "cluster_kmeans")
    bis = bisecting(df, id_col, vec_col, k, seed).withColumnRenamed("label", "cluster_hierarchical")
    return df.join(km, id_col, "left").join(bis, id_col, "left")
