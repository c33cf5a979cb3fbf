import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import quality, spectral, sweep
from tessera.operators import similarity as S


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>").repartition(parts)


def dense(edges, n):
    w = np.zeros((n, n))
    for r in edges.collect():
        if r.src != r.dst:
            w[r.src, r.dst] = r.weight
    d = w.sum(1)
    root = np.sqrt(np.where(d > 0, d, 1))
    a = w / np.outer(root, root)
    a[np.diag_indices(n)] = np.where(d > 0, 0, 1)
    return a, root


def test_eigenvectors_of_all_parents_against_numpy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], np.float64)
    nodes = spark.createDataFrame([(i % 3, i, x[i].tolist()) for i in range(len(x))], "p int, id long, vec array<double>")
    edges = S.knn_graph(nodes, "id", "vec", 10, within=["p"])
    found = spectral.embed(nodes, edges, 5)
    a, root = dense(edges, len(x))
    got = {r.id: r.vec for r in found.rows.collect()}
    for p in range(3):
        at = np.arange(p, len(x), 3)
        own = a[np.ix_(at, at)]
        values = np.linalg.eigvalsh(own)[::-1][:5]
        v = np.array([got[i] for i in at]) * root[at][:, None]
        assert np.allclose(found.values[p], values, atol=1e-8)
        assert np.abs(v.T @ v - np.eye(5)).max() < 1e-6  # orthonormal
        assert np.linalg.norm(own @ v - v * found.values[p], axis=0).max() < 2e-5  # ||L v - lambda v||
        assert found.residuals[p].max() <= spectral.TOLERANCE


def rings(rng, n, radii, at=(0, 0)):
    out = []
    for r in radii:
        t = rng.uniform(0, 2 * np.pi, n)
        out.append(np.c_[r * np.cos(t) + at[0], r * np.sin(t) + at[1]] + rng.normal(size=(n, 2)) * 0.02)
    return np.vstack(out)


def test_rings_that_k_means_cannot_separate(spark):
    rng = np.random.default_rng(1)
    x = rings(rng, 120, [1, 3])
    rows = frame(spark, x)
    out = spectral.split_level_spectral(rows, [], "c", 2).orderBy("id").toPandas()["c"].to_numpy()
    assert len(set(out[:120])) == 1 and len(set(out[120:])) == 1 and out[0] != out[120]


def test_levels_and_gates(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rings(rng, 60, [1, 3], (0, 0)), rings(rng, 60, [1, 3], (100, 0)), [[0.0, 500.0], [0.0, 500.1]]])
    df = spark.createDataFrame([(i, [float(v) for v in r], 1 if i < 120 else 2 if i < 240 else 3) for i, r in enumerate(x)], "id long, vec array<double>, top int")
    out = spectral.split_level_spectral(df, ["top"], "c", 2).orderBy("id").toPandas()
    for a in (0, 120):
        one, two = set(out["c"][a : a + 60]), set(out["c"][a + 60 : a + 120])
        assert len(one) == len(two) == 1 and one != two
    assert set(out["c"][240:]) <= {0, 1}
    small = spectral.split_level_spectral(df, ["top"], "c", 3).orderBy("id").toPandas()
    assert small["c"][240:].isna().all() and small["c"][:240].notna().all()


def test_no_group_holds_a_parent(spark, monkeypatch):
    df = frame(spark, np.random.default_rng(3).normal(size=(200, 3))).withColumn("p", F.lit(0))
    seen = []
    inner = spectral._times
    monkeypatch.setattr(spectral, "_times", lambda *a: seen.append(1) or inner(*a))
    spectral.embed(df, S.knn_graph(df, "id", "vec", 5), 3, cycles=1)
    assert len(seen) == spectral.DEGREES[1] + 1  # a cycle's products, one job each


def test_a_cycle_is_few_jobs(spark):
    nodes = frame(spark, np.random.default_rng(4).normal(size=(300, 3))).withColumn("p", F.lit(0))
    edges = spark.createDataFrame(S.knn_graph(nodes, "id", "vec", 5).collect())
    sc = spark.sparkContext
    for cycles in (1, 2):  # as many more jobs as the second cycle has
        sc.setJobGroup(f"cycles-{cycles}", "embed")
        spectral.embed(nodes, edges, 3, 0.0, cycles)
    sc.setLocalProperty("spark.jobGroup.id", None)
    one, two = (len(sc.statusTracker().getJobIdsForGroup(f"cycles-{c}")) for c in (1, 2))
    assert two - one <= 6  # not one a product or more


def test_parts_exchange_their_sums(spark, monkeypatch):
    monkeypatch.setattr(spectral, "PART_BYTES", 1 << 17)  # several parts
    x = np.random.default_rng(8).normal(size=(240, 4))
    nodes = spark.createDataFrame([(i % 2, i, v.tolist()) for i, v in enumerate(x)], "p int, id long, vec array<double>")
    edges = S.knn_graph(nodes, "id", "vec", 6, within=["p"])
    dealt = []
    inner = spectral._laid_out
    monkeypatch.setattr(spectral, "_laid_out", lambda *a: dealt.append(inner(*a)) or dealt[-1])
    found = spectral.embed(nodes, edges, 4)
    assert dealt[0].count() > 2
    a, root = dense(edges, len(x))
    got = {r.id: r.vec for r in found.rows.collect()}
    for p in range(2):
        at = np.arange(p, len(x), 2)
        own = a[np.ix_(at, at)]
        v = np.array([got[i] for i in at]) * root[at][:, None]
        assert np.allclose(found.values[p], np.linalg.eigvalsh(own)[::-1][:4], atol=1e-8)
        assert np.linalg.norm(own @ v - v * found.values[p], axis=0).max() < 2e-5


def test_repeated_and_missing_ids(spark):
    x = rings(np.random.default_rng(1), 80, [1, 3])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame([*rows, *rows[:20], *rows[:5]], "id long, vec array<double>")
    out = spectral.split_level_spectral(df, [], "c", 2).select("id", "c").collect()
    assert len(out) == 185  # a row for each row
    labels = dict(out)
    assert len({labels[i] for i in range(20, 80)}) == 1 and len({labels[i] for i in range(80, 160)}) == 1
    nodes = spark.createDataFrame([(0, i) for i in range(6)] + [(0, None)], "p int, id long")
    edges = spark.createDataFrame([(i, (i + d) % 6, 1.0) for i in range(6) for d in (1, 5)], "src long, dst long, weight double")
    assert sorted(r.id for r in spectral.embed(nodes, edges, 2).rows.collect()) == list(range(6))


def test_empty_and_tiny(spark):
    empty = spark.createDataFrame([], "id long, vec array<double>")
    assert spectral.three_level_spectral(empty, "id", "vec").count() == 0
    assert spectral.spectral_sweep(empty, "id", "vec", [2, 3])[1].count() == 0
    out = spectral.three_level_spectral(frame(spark, [[0.0], [1.0], [9.0]]), "id", "vec", (2, 2, 2))
    assert out.count() == 3


@pytest.fixture(scope="module")
def swept(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([c + rng.normal(size=(40, 3)) for c in rng.normal(size=(4, 3)) * 30])
    rows = frame(spark, x)
    centers = sweep.fit(rows, [2, 4, 7])
    return x, centers, sweep.labels(rows, centers)


def test_sweep_finds_the_blobs_and_nearest_centers(swept):
    x, centers, labelled = swept
    got = np.array([r.labels for r in labelled.orderBy("id").collect()])
    for j, k in enumerate((2, 4, 7)):
        assert (got[:, j] == ((x[:, None] - centers[k][None]) ** 2).sum(2).argmin(1)).all()
        for c in set(got[:, j]):
            assert np.allclose(centers[k][c], x[got[:, j] == c].mean(0), atol=1e-6)
    assert [len(set(got[40 * b : 40 * b + 40, 1])) for b in range(4)] == [1] * 4


def test_sweep_scores_equal_the_single_operators(swept):
    _, centers, labelled = swept
    got = {r.k: (r.silhouette_sq, r.calinski_harabasz) for r in sweep.scores(labelled, list(centers)).collect()}
    for j, k in enumerate((2, 4, 7)):
        one = labelled.select("id", "vec", F.col("labels")[j].alias("label"))
        assert got[k][0] == pytest.approx(quality.silhouette_sq(one, "id", "vec", "label").first()[0], rel=1e-9)
        assert got[k][1] == pytest.approx(quality.calinski_harabasz(one, "label", "vec").first()[0], rel=1e-9)


def test_spectral_sweep(spark):
    rng = np.random.default_rng(6)
    x = rings(rng, 200, [1, 3, 5])  # close enough in a ring that no neighbour is in another one
    labels, scores = spectral.spectral_sweep(frame(spark, x), "id", "vec", range(2, 5))
    got = np.array([r.labels for r in labels.orderBy("id").collect()])
    assert [len(set(got[200 * b : 200 * b + 200, 1])) for b in range(3)] == [1] * 3 and len(set(got[:, 1])) == 3
    assert sorted(r.k for r in scores.collect()) == [2, 3, 4]
