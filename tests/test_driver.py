"""Loops that join written tables send nothing of them through the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import agglomerate, nndescent, spectral
from tessera.operators import similarity as S


def frame(spark, n, dim=3, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")


@pytest.fixture
def written(monkeypatch):
    """The plans of what a module writes."""
    plans = []

    def watch(module):
        inner = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or inner(df))
        return plans

    return watch


def test_spectral_blocks_are_not_broadcast(spark, written):
    df = frame(spark, 60).withColumn("p", F.lit(0))
    edges = S.knn_graph(df, "id", "vec", 5)
    plans = written(spectral)
    spectral.embed(df, edges, 2, cycles=1).rows.count()
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("BroadcastHashJoin" in p for p in plans)


def test_merge_rounds_are_not_broadcast(spark, written, monkeypatch):
    monkeypatch.setattr(agglomerate, "BROADCAST_CLUSTERS", 0, raising=False)
    monkeypatch.setattr(agglomerate, "numbered", lambda df, order, out, inner=agglomerate.numbered: inner(df, order, out).localCheckpoint())
    plans = written(agglomerate)
    tree = agglomerate.ward(frame(spark, 12), "id", "vec", 4)
    assert tree.merges.count() == 11 and tree.merges.agg(F.max("size")).first()[0] == 12
    assert not any("BroadcastHashJoin" in p for p in plans)


def test_descent_rounds_broadcast_hubs_only(spark, written):
    rows = frame(spark, 300)
    plans = written(nndescent)
    out = nndescent.knn(rows, "id", "vec", 3, pool=6, rounds=1)
    assert out.count() == 900
    known = [p for p in plans if "sum(named" in p]  # the vectors of a round beside their farthest neighbour
    assert len(known) == 1 and "SortMergeJoin" in known[0] and "BroadcastHashJoin" not in known[0]
    assert nndescent.HUB_BYTES <= 4 << 20  # frequent nodes are broadcast in every round
