import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import nndescent, similarity

VEC = "id long, vec array<double>"


def frame(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], VEC)


def brute(rows, k):
    """{src: [(distance, dst)]} by all pairs."""
    out = {}
    for i, u in rows:
        d = sorted((round(float(np.sqrt(((np.array(u) - np.array(v)) ** 2).sum())), 8), j) for j, v in rows if j != i)
        out[i] = d[:k]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["src"], r["rank"])):
        out.setdefault(r["src"], []).append((r["distance"], r["dst"]))
    return out


def test_small_tables_are_exact(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(1).normal(size=(60, 5)))]
    found = got(nndescent.knn(spark.createDataFrame(rows, VEC), "id", "vec", 4))
    want = brute(rows, 4)
    assert found.keys() == want.keys()
    for i in want:
        assert [j for _, j in found[i]] == [j for _, j in want[i]]
        assert np.allclose([d for d, _ in found[i]], [d for d, _ in want[i]], atol=2e-8)


def test_recall_and_k_neighbours(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(3000, 16))
    df = frame(spark, m)
    found = nndescent.knn(df, "id", "vec", 10)
    counts = found.groupBy("src").count().groupBy("count").count().collect()
    assert [(r[0], r[1]) for r in counts] == [(10, 3000)]
    assert found.filter("src = dst").isEmpty()
    r = nndescent.recall(df, "id", "vec", found, F.col("id") % 20 == 0, 10).first()
    assert r["asked"] == 150 and r["wanted"] == 1500
    assert r["hits"] >= 0.9 * r["wanted"]


def test_rounds_do_the_work(spark):
    m = np.random.default_rng(6).normal(size=(3000, 16))
    df = frame(spark, m)
    start = nndescent.knn(df, "id", "vec", 10, rounds=0)
    r = nndescent.recall(df, "id", "vec", start, F.col("id") % 20 == 0, 10).first()
    assert r["hits"] < 0.8 * r["wanted"]  # the first orders alone are not enough


def test_copies_fill_no_lists(spark):
    rng = np.random.default_rng(2)
    m = np.vstack([np.tile(rng.normal(size=6), (500, 1)), rng.normal(size=(700, 6))])
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(1200), m)]
    found, want = got(nndescent.knn(spark.createDataFrame(rows, VEC), "id", "vec", 5)), brute(rows, 5)
    assert all(len(found[i]) == 5 for i in want)
    copies = {i for i, v in rows if v == rows[0][1]}
    assert len(copies) == 500
    for i in copies:
        assert found[i] == want[i]  # the smallest ids of the other copies
    hits = sum(len({j for _, j in found[i]} & {j for _, j in want[i]}) for i in want)
    assert hits >= 0.95 * 5 * 1200


def test_rows_without_neighbours_are_completed(spark):
    rows = nndescent.clean(frame(spark, np.arange(12.0).reshape(12, 1)), "id", "vec")
    none = spark.createDataFrame([(i, None, None, 1) for i in range(12)], "src long, dst long, distance double, rank int")
    found = got(nndescent._completed(rows, none, 3))
    assert found == brute([(i, [float(i)]) for i in range(12)], 3)


def test_recall_takes_the_exact_neighbours_once(spark):
    df = frame(spark, np.random.default_rng(12).normal(size=(80, 3)))
    found = spark.createDataFrame([(i, j, d, r) for i, near in brute([(i, v["vec"]) for i, v in enumerate(df.orderBy("id").collect())], 4).items() for r, (d, j) in enumerate(near, 1)], "src long, dst long, distance double, rank int")
    seen = nndescent.recall(df, "id", "vec", found, F.col("id") % 5 == 0, 4)
    assert "InArrow" not in seen._jdf.queryExecution().executedPlan().toString()  # they are stored when they are asked for
    assert seen.first().asDict() == {"asked": 16, "wanted": 64, "hits": 64}


def test_edges_are_shuffled_once_a_round(spark):
    rows = [(i, j, float(i * 7 % 5 + j), 1, 1) for i in range(20) for j in range(8)] * 2 + [(0, 3, 3.0, 0, 0)]
    edges = spark.createDataFrame(rows, "src long, dst long, distance double, new int, fresh int")
    best = nndescent._nearest_of_each(edges, 4)
    assert best._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {(r.src, r.dst): (r.distance, r.new, r.fresh) for r in best.collect()}
    assert got == {(i, j): (float(i * 7 % 5 + j), 0 if (i, j) == (0, 3) else 1, 0 if (i, j) == (0, 3) else 1) for i in range(20) for j in range(4)}


def test_lists_are_whole_across_batches():
    import pyarrow as pa

    v = np.repeat([3, 5, 8, 9], [4, 1, 11, 2])
    t = pa.table({"v": v, "vec": pa.array([[float(i), 1.0] for i in range(len(v))], pa.list_(pa.float32()))})
    for rows in (1, 3, 5, 40):
        found = list(nndescent._whole_lists(t.to_batches(max_chunksize=rows)))
        assert np.concatenate([c[0] for c in found]).tolist() == v.tolist()
        assert np.concatenate([c[1] for c in found])[:, 0].tolist() == list(range(len(v)))
        assert all(len({*c[0]} & {*d[0]}) == 0 for i, c in enumerate(found) for d in found[:i])
    assert list(nndescent._whole_lists(t[:0].to_batches())) == []


def test_floats_stay_floats_with_the_same_result(spark):
    m = np.random.default_rng(11).normal(size=(700, 6)).astype(np.float32)
    m[5] = m[4]
    doubles = frame(spark, m)
    floats = doubles.select("id", F.col("vec").cast("array<float>").alias("vec"))
    assert dict(nndescent.clean(floats, "id", "vec", True).dtypes)["vec"] == "array<float>"
    assert dict(nndescent.clean(floats, "id", "vec").dtypes)["vec"] == "array<double>"  # as others read it
    assert dict(nndescent.clean(doubles, "id", "vec", True).dtypes)["vec"] == "array<double>"
    found, same = (got(nndescent.knn(df, "id", "vec", 3)) for df in (floats, doubles))
    assert found == same and len(found) == 700


def test_edges(spark):
    bad = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (2, [9.0, 9.0]), (2, [1.0, 0.0]), (3, None), (None, [0.0, 1.0]), (4, [float("nan"), 0.0]),
           (5, [float("inf"), 0.0]), (6, [None, 0.0]), (7, []), (8, [-0.0, 0.0]), (9, [0.0, 3.0])]
    df = spark.createDataFrame(bad, VEC).withColumn("src", F.lit("x")).withColumn("rank", F.lit(None).cast("string"))
    found = got(nndescent.knn(df, "id", "vec", 2))
    assert {i: [j for _, j in v] for i, v in found.items()} == {1: [8, 2], 2: [1, 8], 8: [1, 2], 9: [1, 8]}
    assert found[1][0][0] == 0.0
    assert nndescent.knn(df.limit(0), "id", "vec", 2).collect() == []
    assert nndescent.knn(df.filter("id = 1"), "id", "vec", 2).collect() == []
    renamed = df.select(F.col("id").alias("vec"), F.col("vec").alias("id"))
    assert got(nndescent.knn(renamed, "vec", "id", 2)) == found


def test_nearest_of_is_exact(spark):
    m = np.random.default_rng(9).normal(size=(200, 4))
    df = frame(spark, m).withColumn("asked", F.col("id") % 7 == 0)
    found = got(nndescent.nearest_of(df, "id", "vec", "asked", 3, nb=3))
    want = brute(list(enumerate(m)), 3)
    assert {i: [j for _, j in v] for i, v in found.items()} == {i: [j for _, j in want[i]] for i in want if i % 7 == 0}
