"""Cluster statistics and quality scores.

Everything that depends on the clusters only (sizes, means, sums of squares)
comes from partial + final aggregates over a ``posexplode`` of the vectors, so
cost is one linear scan; per-row work uses a broadcast of the k cluster
summaries, k x dim numbers like those of a fitted KMeans model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import similarity as S

#: Bytes of cluster summaries (labels x dim) that go to the driver at a time.
SUMMARY_BYTES = 64 << 20


def cluster_ids(df: DataFrame, label_col: str) -> DataFrame:
    """Distinct non-null cluster ids."""
    return df.select(label_col).na.drop().distinct()


def cluster_sizes(df: DataFrame, label_col: str, min_size: int | None = None) -> DataFrame:
    """Rows per cluster and the split gate ``size >= k``."""
    out = df.filter(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count(F.lit(1)).alias("size"))
    if min_size is not None:
        out = out.withColumn("can_split", F.col("size") >= F.lit(min_size))
    return out


def centroids(df: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """(label, dim, mean) -- cluster means in long form."""
    lf = df.filter(F.col(label_col).isNotNull()).select(F.col(label_col), F.posexplode(vec_col).alias("dim", "x"))
    return lf.groupBy(label_col, "dim").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def collect_centroids(cent: DataFrame, label_col: str, value_col: str = "mean"):
    """(labels, matrix): k x dim numbers of a fitted model, on the driver."""
    import numpy as np

    rows = cent.select(label_col, "dim", value_col).collect()
    labels = sorted({r[0] for r in rows})
    pos = {lab: i for i, lab in enumerate(labels)}
    m = np.zeros((len(labels), 1 + max((r[1] for r in rows), default=-1)))
    for lab, d, v in rows:
        m[pos[lab], d] = v
    return np.array(labels), m


def _center_slices(labels, centers, limit: int = SUMMARY_BYTES):
    """The centers, ``limit`` bytes at a time (one slice for any usual model)."""
    step = max(1, limit // max(1, centers.shape[1] * 8))
    return [(labels[k : k + step], centers[k : k + step]) for k in range(0, len(labels), step)]


def assign_nearest(df: DataFrame, id_col: str, vec_col: str, labels, centers, digits: int = 8) -> DataFrame:
    """Nearest centroid per row (Euclidean; distance rounded, ties to the lowest label).

    Exact differences, one center at a time over a batch, so a task holds one
    batch. Centers beyond ``SUMMARY_BYTES`` are broadcast in slices, whose
    nearest are compared afterwards."""
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("nearest", T.IntegerType()), T.StructField("distance", T.DoubleType())])
    rows = df.select(F.col(id_col).cast("long"), F.col(vec_col)).filter(F.col(vec_col).isNotNull())
    parts = []
    for piece in _center_slices(labels, centers):
        shared = df.sparkSession.sparkContext.broadcast(piece)

        def assign(batches, shared=shared):
            import numpy as np
            import pyarrow as pa

            labs, c = shared.value
            for b in batches:
                x = S.matrix(b.column(1))
                best, at = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
                for j in range(len(c)):
                    diff = x - c[j]
                    d = np.round(np.sqrt(np.einsum("ij,ij->i", diff, diff)), digits)
                    closer = d < best  # the first of equals stays: labels are sorted
                    best[closer], at[closer] = d[closer], j
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(labs[at].astype(np.int32)), pa.array(best)], names=[id_col, "nearest", "distance"])

        parts.append(rows.mapInArrow(assign, schema))
    if len(parts) == 1:
        return parts[0]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    best = both.groupBy(id_col).agg(F.min(F.struct("distance", "nearest")).alias("b"))
    return best.select(id_col, "b.nearest", "b.distance")


def silhouette(df: DataFrame, id_col: str, vec_col: str, label_col: str, nb: int | None = None) -> DataFrame:
    """I15 exact: mean silhouette with Euclidean distance (single-member clusters score 0).

    The n^2 distances are computed block by block and only per-(row, cluster)
    sums leave a block.
    """
    sums = S.label_distance_sums(df.filter(F.col(label_col).isNotNull()), id_col, vec_col, label_col, nb)
    own = sums.filter(F.col("label") == F.col("other_label")).select(
        "id", F.col("n").alias("n_own"), F.when(F.col("n") > 1, F.col("sum_dist") / (F.col("n") - 1)).alias("a")
    )
    other = (
        sums.filter(F.col("label") != F.col("other_label"))
        .groupBy("id")
        .agg(F.min(F.col("sum_dist") / F.col("n")).alias("b"))
    )
    per = own.join(other, "id", "left").select(
        "id",
        F.when((F.col("n_own") <= 1) | F.col("b").isNull(), F.lit(0.0))
        .otherwise((F.col("b") - F.col("a")) / F.greatest(F.col("a"), F.col("b")))
        .alias("s"),
    )
    return per.agg(F.avg("s").alias("silhouette"))


def cluster_summaries(df: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """Per cluster and dimension: (label, dim, n, mean, ss) with ss the sum of
    squares about the cluster's mean. Spark merges partial variances stably, so
    data far from the origin lose no digits."""
    x = df.filter(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull())
    v = x.select(F.col(label_col).alias("label"), F.posexplode(vec_col).alias("dim", "v")).withColumn("v", F.col("v").cast("double"))
    return v.groupBy("label", "dim").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("*")).alias("ss"))


def silhouette_sq(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """I15 at scale: silhouette with *squared* Euclidean distance in closed form
    (the definition MLlib's ClusteringEvaluator uses). Linear cost: each row
    meets the k cluster summaries: the mean squared distance to a cluster is
    |x - mean|^2 + ss / n."""
    import numpy as np

    rows = cluster_summaries(df, label_col, vec_col).collect()  # k x dim numbers of a fitted model
    labels = np.array(sorted({r["label"] for r in rows}))
    pos = {lab: i for i, lab in enumerate(labels.tolist())}
    n, ss = np.zeros(len(labels)), np.zeros(len(labels))
    mean = np.zeros((len(labels), 1 + max((r["dim"] for r in rows), default=-1)))
    for r in rows:
        k = pos[r["label"]]
        n[k] = r["n"]
        ss[k] += r["ss"]
        mean[k, r["dim"]] = r["mean"]
    bc = df.sparkSession.sparkContext.broadcast((labels, n, ss, mean))

    def score(batches):
        import numpy as np
        import pyarrow as pa

        labs, n_, ss_, mean_ = bc.value
        for b in batches:
            if b.num_rows == 0:
                continue
            own = np.searchsorted(labs, b.column(0).to_numpy(zero_copy_only=False))
            x = S.matrix(b.column(1))
            rows = np.arange(len(x))
            a, best = np.zeros(len(x)), np.full(len(x), np.inf)
            for k in range(len(labs)):
                diff = x - mean_[k]
                d = np.einsum("ij,ij->i", diff, diff) + ss_[k] / n_[k]
                mine = own == k
                a[mine] = d[mine] * n_[k] / max(n_[k] - 1, 1)
                best = np.where(mine, best, np.minimum(best, d))
            with np.errstate(divide="ignore", invalid="ignore"):
                s = np.where(a < best, 1 - a / best, np.where(a > best, best / a - 1, 0.0))
            s = np.where((n_[own] <= 1) | ~np.isfinite(best), 0.0, s)[rows]
            yield pa.RecordBatch.from_arrays([pa.array(s)], names=["s"])

    x = df.filter(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(label_col), F.col(vec_col))
    return x.mapInArrow(score, "s double").agg(F.avg("s").alias("silhouette_sq"))


def calinski_harabasz(df: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """I16: (B / (k - 1)) / (W / (n - k)) from cluster summaries only: W is the sum
    of squares within clusters, B that of the cluster means about the mean."""
    v = cluster_summaries(df, label_col, vec_col)
    per_dim = v.groupBy("dim").agg(
        F.sum("ss").alias("within"), F.sum("n").alias("n_tot"), F.count(F.lit(1)).alias("k_tot"),
        F.collect_list(F.struct("n", "mean")).alias("c"),  # one entry per cluster
    )
    # the mean relative to the first cluster's, so that large means lose no digits
    first = F.col("c")[0]["mean"]
    mu = first + F.aggregate("c", F.lit(0.0), lambda s, x: s + x["n"] * (x["mean"] - first)) / F.col("n_tot")
    per_dim = per_dim.withColumn("mu", mu)
    between = F.aggregate(F.zip_with("c", F.array_repeat("mu", F.size("c")), lambda x, m: x["n"] * (x["mean"] - m) * (x["mean"] - m)), F.lit(0.0), lambda s, y: s + y)
    t = per_dim.select("within", "n_tot", "k_tot", between.alias("between")).agg(
        F.sum("within").alias("w"), F.sum("between").alias("b"), F.max("n_tot").alias("n_tot"), F.max("k_tot").alias("k_tot")
    )
    return t.select(((F.col("b") / (F.col("k_tot") - 1)) / (F.col("w") / (F.col("n_tot") - F.col("k_tot")))).alias("calinski_harabasz"))
