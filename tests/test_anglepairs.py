import numpy as np
from pyspark.sql import functions as F

from tessera.operators import anglepairs

VEC = "id long, vec array<double>"


def brute(rows, threshold, digits=6):
    first = {}
    for i, v in sorted(rows):
        first.setdefault(tuple(v), i)
    out = set()
    ids = sorted((i, np.array(v)) for v, i in first.items())
    for x, (i, u) in enumerate(ids):
        for j, v in ids[x + 1:]:
            s = round(float(u @ v / np.linalg.norm(u) / np.linalg.norm(v)), digits)
            if s >= threshold:
                out.add((i, j, s + 0.0))
    return out


def found(df):
    rows = [(r["id_a"], r["id_b"], r["similarity"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def close(a, b):
    assert {x[:2] for x in a} == {x[:2] for x in b}
    assert np.allclose([x[2] for x in sorted(a)], [x[2] for x in sorted(b)], atol=2e-6)


def blobs(n, dim, centres, seed=3, spread=0.05):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    m = c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim))
    return [(i, [float(x) for x in v]) for i, v in enumerate(m)]


def test_clusters_are_exact_and_skip(spark):
    rows = blobs(900, 8, 15)
    pairs, members, report = anglepairs.threshold_pairs(spark.createDataFrame(rows, VEC), "id", "vec", 0.97, blocks=30, n_pivots=15)
    close(found(pairs), brute(rows, 0.97))
    assert members.filter("id = class_id").count() == members.count() == 900
    r = report.first()
    assert r["met"] + r["skipped"] == r["blocks"] * (r["blocks"] + 1) // 2
    assert r["skipped"] > 0.6 * (r["met"] + r["skipped"])


def test_without_clusters_nothing_is_lost(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(400, 6)))]
    for threshold in (-0.2, 0.5, 0.9):
        pairs, _, _ = anglepairs.threshold_pairs(spark.createDataFrame(rows, VEC), "id", "vec", threshold, blocks=7)
        close(found(pairs), brute(rows, threshold))


def test_tiles_of_a_block(spark, monkeypatch):
    rng = np.random.default_rng(8)
    m = rng.normal(size=(300, 5))
    m /= np.linalg.norm(m, axis=1)[:, None]
    monkeypatch.setattr(anglepairs.S, "TILE_ROWS", 16)
    ids = np.arange(300)
    got = set()
    for same, left, right in ((True, slice(0, 170), slice(0, 170)), (False, slice(0, 170), slice(170, 300)), (True, slice(170, 300), slice(170, 300))):
        for i, j, s in anglepairs._compare(ids[left], m[left], ids[right], m[right], same, m[:4], np.arccos(0.8) + 1e-6, 0.8, 6):
            got |= set(zip(i.tolist(), j.tolist(), s.tolist()))
    close(got, brute([(i, list(v)) for i, v in enumerate(m)], 0.8))


def test_copies_are_members(spark):
    rows = blobs(200, 6, 4) + [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(700)] + [(5000, [2.0, 4.0, 6.0, 8.0, 10.0, 12.0])]
    pairs, members, _ = anglepairs.threshold_pairs(spark.createDataFrame(rows, VEC), "id", "vec", 0.95)
    close(found(pairs), brute(rows, 0.95))
    assert (1000, 5000, 1.0) in found(pairs)
    assert members.filter("class_id = 1000").count() == 700
    counted = {r["id"]: r["links"] for r in anglepairs.links(pairs, members).collect()}
    near = brute(rows, 0.95)
    size = {i: 700 if i == 1000 else 1 for i in counted}
    for i in [*range(200), 1000, 5000]:
        assert counted[i] == size[i] - 1 + sum(size[b] if a == i else size[a] for a, b, _ in near if i in (a, b))
    assert {counted[i] for i in range(1000, 1700)} == {counted[1000]}


def test_edges(spark):
    bad = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (2, [9.0, 9.0]), (3, None), (None, [1.0, 1.0]), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, []),
           (7, [None, 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, -0.0])]
    df = spark.createDataFrame(bad, VEC).withColumn("id_a", F.lit("x")).withColumn("block", F.lit(1))
    pairs, members, _ = anglepairs.threshold_pairs(df, "id", "vec", 0.9)
    assert found(pairs) == {(1, 2, 0.995037)}
    assert sorted(map(tuple, members.collect())) == [(1, 1), (2, 2), (9, 1)]
    pairs, members, report = anglepairs.threshold_pairs(df.limit(0), "id", "vec", 0.9)
    assert not pairs.collect() and not members.collect() and tuple(report.first()) == (0, 0, 0)
