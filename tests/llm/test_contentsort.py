import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import contentsort


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["hot"] * 150 + ["hot "] * 20 + ["Hot"] * 20 + [None, "", "", "é" * 40 + "a", "é" * 40 + "b"] + [f"text {k % 7}" for k in range(60)] + ["x" * 50_000 + str(k % 2) for k in range(4)]
    rows = [(k, t, "x", None) for k, t in enumerate(texts)] + [(3, "hot", "x", 1), (3, "hot", "y", 1), (None, "hot", "y", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, __p string, __n long").repartition(6)


@pytest.fixture(scope="module", params=[1, 4, 40])
def parts(request, spark):
    """Few and many partitions: groups inside one and over several."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("keep,pick", [("largest", max), ("smallest", min)])
def test_groups_equal_brute_force(spark, docs, parts, keep, pick):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    group = collections.defaultdict(list)
    for i, t in rows:
        group[t].append(i)
    stay = {t: pick((i for i in ids if i is not None), default=None) for t, ids in group.items()}
    want = [(i, stay[t], len(group[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows]
    got = contentsort.dedup(docs, keep=keep).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got)
    assert sum(r.kept for r in got) == len(group)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_keep_one_returns_whole_rows(spark, docs, parts):
    got = contentsort.keep_one(docs)
    assert got.schema.names == docs.schema.names
    rows = got.collect()
    assert sorted(r.text or "" for r in rows) == sorted({r.text or "" for r in docs.collect()})
    assert {tuple(r) for r in rows} <= {tuple(r) for r in docs.collect()}


def test_empty_table_and_bad_parameter(spark, docs):
    assert contentsort.dedup(docs.where(F.lit(False))).count() == 0
    assert contentsort.keep_one(docs.where(F.lit(False))).count() == 0
    with pytest.raises(ValueError):
        contentsort.dedup(docs, keep="any")
