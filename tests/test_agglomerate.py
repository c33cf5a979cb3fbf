import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import agglomerate


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>").repartition(parts)


def brute_ward(x):
    """One merge at a time, by the Lance-Williams formula on a full matrix."""
    n = len(x)
    d2 = ((x[:, None] - x[None]) ** 2).sum(2)
    size, alive, out = {i: 1 for i in range(n)}, list(range(n)), []
    d = {(i, j): d2[i, j] for i in range(n) for j in range(i + 1, n)}
    get = lambda i, j: d[min(i, j), max(i, j)]
    for step in range(n - 1):
        i, j = min(((i, j) for i in alive for j in alive if i < j), key=lambda p: get(*p))
        new, dij = n + step, get(i, j)
        alive = [c for c in alive if c not in (i, j)]
        for c in alive:
            a, b, m = size[i], size[j], size[c]
            d[c, new] = ((a + m) * get(i, c) + (b + m) * get(j, c) - m * dij) / (a + b + m)
        size[new] = size[i] + size[j]
        alive.append(new)
        out.append((i, j, np.sqrt(dij), size[new]))
    return out


def members(merges, n):
    """The set of leaves of every merge, by distance."""
    sets = {i: frozenset([i]) for i in range(n)}
    for step, (i, j, *_) in enumerate(merges):
        sets[n + step] = sets[i] | sets[j]
    return sets


def table(tree):
    rows = tree.merges.orderBy("step").collect()
    assert [r.step for r in rows] == list(range(tree.n - 1))
    return [(r.left, r.right, r.distance, r["size"]) for r in rows]


def test_exact_ward_on_a_complete_graph(spark):
    x = np.random.default_rng(1).normal(size=(45, 3))
    tree = agglomerate.ward(frame(spark, x), "id", "vec", neighbours=44)
    got, want = table(tree), brute_ward(x)
    assert np.allclose([r[2] for r in got], [r[2] for r in want])
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    for k in (1, 4, 45, 60):
        labels = {r.id: r.label for r in agglomerate.flat(tree, k).collect()}
        sets, cut = members(want, 45), max(45 - k, 0)
        used = {c for r in want[:cut] for c in r[:2]}
        clusters = sorted((sorted(sets[c]) for c in range(45 + cut) if c not in used))
        assert labels == {i: c for c, own in enumerate(clusters) for i in own}
    top = agglomerate.top_levels(tree, 3).collect()
    assert {r.depth for r in top} == {0, 1, 2} and [r["size"] for r in top if r.depth == 0] == [45]


def test_few_neighbours_copies_and_separate_parts(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([c + rng.normal(size=(30, 2)) for c in ([0, 0], [100, 0], [0, 100])] + [np.zeros((40, 2))])
    tree = agglomerate.ward(frame(spark, x), "id", "vec", neighbours=5)
    assert tree.n == 91 and tree.leaves.count() == 130
    got = table(tree)
    distance = [r[2] for r in got]
    assert distance == sorted(distance) and got[-1][3] == 130
    size = {leaf: n for leaf, n in tree.leaves.groupBy("leaf").agg(F.count("*")).collect()}
    for step, (i, j, _, n) in enumerate(got):  # sizes add up and no node is used before it exists
        assert max(i, j) < 91 + step
        size[91 + step] = size[i] + size[j]
        assert n == size[91 + step]
    labels = np.array([r.label for r in agglomerate.flat(tree, 3).orderBy("id").collect()])
    assert len(set(labels)) == 3 and all(len(set(labels[a : a + 30])) == 1 for a in (0, 30, 60)) and set(labels[90:]) == set(labels[:30])


def test_empty_and_single(spark):
    empty = agglomerate.ward(spark.createDataFrame([], "id long, vec array<double>"), "id", "vec")
    assert empty.n == 0 and empty.merges.count() == 0 and agglomerate.flat(empty, 3).count() == 0
    one = agglomerate.ward(frame(spark, [[1.0], [1.0], [1.0]]), "id", "vec")
    assert one.n == 1 and one.merges.count() == 0 and [r.label for r in agglomerate.flat(one, 3).collect()] == [0, 0, 0]


def test_a_round_measures_only_links_of_merged_clusters(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(16, 3))
    asked, inner = [], agglomerate._measured
    monkeypatch.setattr(agglomerate, "_measured", lambda links, clusters, side: asked.append((links.count(), clusters.count())) or inner(links, clusters, side))
    got = table(agglomerate.ward(frame(spark, x), "id", "vec", neighbours=15))
    assert np.allclose([r[2] for r in got], [r[2] for r in brute_ward(x)])
    assert asked[0] == (16 * 15 / 2, 16)
    for (_, before), (links, left) in zip(asked, asked[1:]):
        same = left - (before - left)  # clusters that did not merge
        assert links == left * (left - 1) / 2 - same * (same - 1) / 2


def test_numbered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    assert all(r.v == r.at for r in agglomerate.numbered(df, ["v"], "at").collect())
