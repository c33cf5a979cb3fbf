import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import groupfit

SCHEMA = "g string, h int, id long, vec array<double>"


def sample(n=900, dim=5, seed=1):
    rng = np.random.default_rng(seed)
    g = rng.choice(["hot", "b", "c", None], n, p=[0.6, 0.2, 0.15, 0.05])
    m = rng.normal(size=(n, dim)) * [5, 1, 1, 1, 1] + 1000 + rng.integers(0, 3, (n, 1)) * 30
    return [(None if x is None else str(x), int(i % 2), i, [float(v) for v in row]) for i, (x, row) in enumerate(zip(g, m))]


def groups(rows):
    out = {}
    for g, h, i, v in rows:
        out.setdefault((g, h), []).append((i, v))
    return {k: (np.array([i for i, _ in r]), np.array([v for _, v in r])) for k, r in out.items()}


@pytest.fixture(params=["broadcast", "streamed"])
def way(request, monkeypatch):
    if request.param == "streamed":
        monkeypatch.setattr(groupfit, "PARAM_BYTES", 0)
        monkeypatch.setattr(groupfit, "SALT_ROWS", 100)
    monkeypatch.setattr(groupfit, "STATE_BYTES", 500)
    return request.param


def test_principal_axis(spark, way):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    model = groupfit.PrincipalAxis()
    fitted = groupfit.fit_groups(df, ["g", "h"], "id", "vec", model)
    want = groups(rows)
    got = {(r["g"], r["h"]): np.array(r["params"]) for r in fitted.collect()}
    assert got.keys() == want.keys()
    for key, (ids, x) in want.items():
        size, axes = np.linalg.eigh(np.cov(x.T, bias=True).reshape(5, 5))
        axis = axes[:, -1] * np.sign(axes[np.abs(axes[:, -1]).argmax(), -1])
        assert got[key][0] == len(x)
        assert np.allclose(got[key][1], size[-1]) and np.allclose(got[key][2:7], x.mean(axis=0)) and np.allclose(got[key][7:], axis)
    value = {r["id"]: r["value"] for r in groupfit.apply_groups(df, ["g", "h"], "id", "vec", fitted, model).collect()}
    assert len(value) == len(rows)
    for key, (ids, x) in want.items():
        assert np.allclose([value[int(i)] for i in ids], (x - got[key][2:7]) @ got[key][7:])


def test_kmeans_equals_one_task(spark, way):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    model = groupfit.KMeans(3, 4)
    fitted = groupfit.fit_groups(df, ["g", "h"], "id", "vec", model)
    got = {(r["g"], r["h"]): np.array(r["params"]) for r in fitted.collect()}
    for key, (ids, x) in groups(rows).items():
        params = None
        for _ in range(model.passes):
            params = model.finish(model.part(x, ids, params), params)
        assert np.allclose(got[key], params)
    label = {r["id"]: int(r["value"]) for r in groupfit.apply_groups(df, ["g", "h"], "id", "vec", fitted, model).collect()}
    for key, (ids, x) in groups(rows).items():
        near = ((x[:, None] - got[key].reshape(-1, 5)[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert [label[int(i)] for i in ids] == near.tolist()


def test_hot_group_is_split_over_tasks(spark):
    df = spark.createDataFrame([("a", 0, i, [float(i), 1.0]) for i in range(400)], SCHEMA).repartition(8)
    seen = []

    class Parts(groupfit.PrincipalAxis):
        def finish(self, state, params):
            return state

        def part(self, x, ids, params):
            return np.array([1.0, len(x)])

        def merge(self, a, b):
            return np.array([a[0] + b[0], max(a[1], b[1])])

    tasks, most = groupfit.fit_groups(df, ["g"], "id", "vec", Parts()).first()["params"]
    assert tasks >= 8 and most < 400


def test_edges(spark):
    bad = [("a", 1, 1, [1.0, 2.0]), ("a", 1, 1, [1.0, 2.0]), ("a", 1, None, [9.0, 9.0]), ("b", 1, 2, None), ("c", 1, 3, [float("nan"), 0.0]), (None, 1, 4, [0.0, 1.0]), ("d", 1, 5, [])]
    df = spark.createDataFrame(bad, SCHEMA).withColumn("name", F.lit("x")).withColumn("params", F.lit(1)).withColumn("k0", F.lit(2))
    fitted = groupfit.fit_groups(df, ["g"], "id", "vec", groupfit.KMeans(4, 2))
    assert {r["g"]: r["params"] for r in fitted.collect()} == {"a": [1.0, 2.0], None: [0.0, 1.0]}
    axis = groupfit.fit_groups(df, ["g"], "id", "vec", groupfit.PrincipalAxis())
    assert {r["g"]: r["params"][:4] for r in axis.collect()} == {"a": [2.0, 0.0, 1.0, 2.0], None: [1.0, 0.0, 0.0, 1.0]}
    assert groupfit.fit_groups(df.limit(0), ["g"], "id", "vec", groupfit.KMeans(2)).collect() == []
    with pytest.raises(ValueError, match="rename"):
        groupfit.fit_groups(df, ["name"], "id", "vec", groupfit.KMeans(2))
