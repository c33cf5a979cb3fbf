import numpy as np
import pytest

from pyspark.sql import functions as F

from tessera.operators import cluster, quality, sweep
from tessera.operators import similarity as S


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>").repartition(parts)


def blobs(seed=1, n=40, dim=3, k=4, apart=30.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(k, dim)) * apart
    return np.vstack([c + rng.normal(size=(n, dim)) for c in centers])


def nearest(x, centers):
    return ((x[:, None] - centers[None]) ** 2).sum(-1).argmin(1)


def test_kmeans_rows_are_at_their_nearest_center(spark):
    x = blobs()
    labels, centers = cluster.kmeans_model(frame(spark, x), "id", "vec", 4)
    got = np.array([r["label"] for r in labels.orderBy("id").collect()])
    assert (got == nearest(x, centers)).all()
    for c in range(4):  # and centers are the means of their rows
        assert np.allclose(centers[c], x[got == c].mean(0), atol=1e-6)


def test_pca_components_are_those_of_the_covariance(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5)) @ np.diag([5, 3, 1, 0.5, 0.1]) + 1e3
    got = cluster.pca_2d(frame(spark, x), "id", "vec").orderBy("id").toPandas()[["pc1", "pc2"]].to_numpy()
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(got.var(0, ddof=1), values[::-1][:2], rtol=1e-6)  # explained variance
    assert abs(np.corrcoef(got.T)[0, 1]) < 1e-9  # orthogonal
    want = (x - x.mean(0)) @ vectors[:, ::-1][:, :2]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-5)


def test_bisecting_separates_blobs(spark):
    x = blobs(2, k=2)
    out = cluster.bisecting(frame(spark, x), "id", "vec", 2).orderBy("id").toPandas()
    assert len(out) == len(x) and out["label"].nunique() == 2
    for b in range(2):
        assert out["label"][40 * b : 40 * (b + 1)].nunique() == 1


def lloyd(x, at, order, k, iterations):
    """k-means of the rows ``at`` from the first k of them in ``order``."""
    if len(at) < k:
        return None
    centers = x[[i for i in order if i in set(at)][:k]].copy()
    for _ in range(iterations):
        lab = nearest(x[at], centers)
        new = np.array([x[at][lab == c].mean(0) if (lab == c).any() else centers[c] for c in range(k)])
        moved, centers = np.abs(new - centers).max(), new
        if moved < 1e-6:
            break
    return nearest(x[at], centers)


@pytest.mark.parametrize("offset", [0.0, 1e4])
def test_three_levels_equal_lloyd_inside_each_parent(spark, offset):
    x = blobs(3, 45, 3, 3, 6.0) + offset
    df = frame(spark, x)
    order = [r["id"] for r in df.select("id", F.xxhash64("id", F.lit(cluster.SEED)).alias("h")).orderBy("h", "id").collect()]
    got = cluster.three_level(df, "id", "vec", (3, 40, 4), 6).toPandas().sort_values("id").reset_index(drop=True)
    ids = np.arange(len(x))
    level_1 = lloyd(x, ids, order, 3, 6)
    assert (got["level_1"] == level_1).all() and len(got) == len(x)
    for p in range(3):
        at = ids[level_1 == p]
        level_2 = lloyd(x, at, order, 40, 6)
        if level_2 is None:  # fewer rows than clusters: not split
            assert got["level_2"][at].isna().all() and got["level_3"][at].isna().all()
            continue
        assert (got["level_2"][at] == level_2).all()
        for q in range(40):
            below = at[level_2 == q]
            level_3 = lloyd(x, below, order, 4, 6)
            assert got["level_3"][below].isna().all() if level_3 is None else (got["level_3"][below] == level_3).all()


def test_three_levels_of_no_rows(spark):
    assert cluster.three_level(frame(spark, np.zeros((1, 2))).limit(0), "id", "vec").count() == 0


def test_sweep_finds_the_number_of_blobs(spark):
    out = sweep.k_sweep(frame(spark, blobs(4)), "id", "vec", range(2, 6)).toPandas().set_index("k")
    assert list(out.index) == [2, 3, 4, 5]
    assert out["silhouette_sq"].idxmax() == 4 and out["calinski_harabasz"].idxmax() == 4


def test_clustered_rows_keeps_every_row(spark):
    df = frame(spark, blobs(5)).withColumn("extra", F.lit("x"))
    out = cluster.clustered_rows(df, "id", "vec", 4)
    assert out.columns == ["id", "vec", "extra", "cluster_kmeans", "cluster_hierarchical"]
    assert out.count() == 160 and out.where("cluster_kmeans is null or cluster_hierarchical is null").count() == 0


def far(n=200, dim=6, mean=1e5, spread=1e-3, seed=8):
    rng = np.random.default_rng(seed)
    return mean + spread * rng.normal(size=(n, dim))


def test_knn_far_from_the_origin(spark):
    x = far()
    got = S.knn(frame(spark, x), "id", "vec", 4, nb=3).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).round(S.DIST_DIGITS)
    for i in range(len(x)):
        want = sorted(range(len(x)), key=lambda j: (d[i, j], j))[:4]
        assert [r["dst"] for r in sorted((r for r in got if r["src"] == i), key=lambda r: r["rank"])] == want


def test_scores_far_from_the_origin(spark):
    x, lab = far(mean=1e4, spread=1.0), np.arange(200) % 3
    df = spark.createDataFrame([(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, lab))], "id long, vec array<double>, label int").repartition(5)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        a = d[i, lab == lab[i]].sum() / ((lab == lab[i]).sum() - 1)
        b = min(d[i, lab == c].mean() for c in range(3) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert abs(quality.silhouette(df, "id", "vec", "label", nb=3).first()[0] - np.mean(s)) < 1e-8
    means = [x[lab == c].mean(0) for c in range(3)]
    between = sum((lab == c).sum() * ((means[c] - x.mean(0)) ** 2).sum() for c in range(3))
    within = sum(((x[lab == c] - means[c]) ** 2).sum() for c in range(3))
    assert abs(quality.calinski_harabasz(df, "label", "vec").first()[0] - (between / 2) / (within / 197)) < 1e-8
