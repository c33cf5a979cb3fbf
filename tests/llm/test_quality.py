import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality
from tessera.llm.common import crc_fold

DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    return docs, labels, quality.fit(docs, labels.where(crc_fold("doc_id", 4) != 2))


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    rows = quality.predict(docs, model).where(crc_fold("doc_id", 4) == 2).join(labels, "doc_id").select("score", "quality").toPandas()
    good, bad = rows[rows.quality == 1].score, rows[rows.quality == 0].score
    assert rows.score.between(0, 1).all()
    assert (good >= 0.7).mean() > 0.97 and (bad >= 0.7).mean() < 0.1


def test_passages_are_the_texts_words_in_order():
    text = " ".join(f"w{k}" for k in range(150))
    x, row = quality.passages(pa.array([text, "", None, "one", "  \n", "x" * 300_000]))
    assert row.tolist() == [0, 0, 0, 1, 2, 3, 4, 5]
    parts = text.split(" ")
    for k in range(3):  # alone, a passage has the same features
        alone = " ".join(parts[64 * k : 64 * (k + 1)]) + (" " if k < 2 else "")
        y, _ = quality.passages(pa.array([alone]))
        assert np.allclose(x[k], y[0], atol=1e-6)
    assert not x[3].any() and not x[4].any() and x[7].any()


def test_the_fit_reads_every_passage_of_a_long_text(spark, monkeypatch):
    n = 64 * 700  # 700 passages
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{i}" for i in range(n))) for k in (0, 1)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "_train", lambda x, bag, y, prior: seen.append((x, bag, y)))
    quality.fit(docs, labels)
    (x, bag, y), = seen
    assert np.bincount(bag).tolist() == [700, 700]
    texts = {r.doc_id: r.text for r in docs.collect()}
    want, _ = quality.passages(pa.array([texts[int(k)] for k in y]))
    assert np.array_equal(x, want.astype(np.float16).astype(np.float32))


def test_gradients_equal_differences():
    """One full-batch Adam step follows the sign of the numeric gradient."""
    rnd = np.random.default_rng(0)
    x, bag = rnd.random((12, quality.FEATURES)).astype(np.float32), np.repeat(np.arange(4), 3)
    y = np.array([0, 1, 0, 1], np.float32)
    old = quality.EPOCHS, quality.DECAY
    try:
        quality.EPOCHS, quality.DECAY = 0, 0.0
        before = quality._train(x, bag, y, 0.0)
        start = {k: w.copy() for k, w in before.weights.items()}
        quality.EPOCHS = 1
        after = quality._train(x, bag, y, 0.0)
    finally:
        quality.EPOCHS, quality.DECAY = old

    def loss():
        logit, _ = before.forward(x.astype(float), bag, 4)
        p = 1 / (1 + np.exp(-logit))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    checked = 0
    before.weights = {k: w.astype(float) for k, w in start.items()}
    for name, w in before.weights.items():
        for at in [tuple(rnd.integers(0, n) for n in w.shape) for _ in range(12)]:
            w[at] += 1e-4
            up = loss()
            w[at] -= 2e-4
            down = loss()
            w[at] += 1e-4
            slope = (up - down) / 2e-4
            if abs(slope) > 1e-4:
                checked += 1
                assert np.sign(start[name][at] - after.weights[name][at]) == np.sign(slope), (name, at)
    assert checked > 20


def test_odd_texts_and_clashing_columns(fitted, spark):
    _, _, model = fitted
    rows = [(1, None, 1), (2, "", 1), (3, " \n ", 1), (4, "word and the " * 60_000, 1), (None, "TH!! AND!! " * 50, 2), (4, "x", 3), (4, "x", 3)]
    got = quality.predict(spark.createDataFrame(rows, "doc_id long, text string, c1 int"), model)
    assert got.columns == ["doc_id", "text", "c1", "score", "attention"]
    out = got.collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and abs(sum(r.attention) - 1) < 1e-3 for r in out)
    by = {(r.doc_id, (r.text or "")[:2]): r for r in out}
    assert abs(by[(1, "")].score - by[(2, "")].score) < 1e-6 and len(by[(4, "wo")].attention) == 2813
    assert by[(None, "TH")].score < 0.5


def test_score_does_not_depend_on_neighbours(fitted, spark):
    docs, _, model = fitted
    some = docs.where("doc_id < 40")
    a = {r.doc_id: r.score for r in quality.predict(some.repartition(7), model).collect()}
    b = {r.doc_id: r.score for r in quality.predict(some.coalesce(1), model).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-4 for k in a)


def test_empty_tables(fitted):
    docs, labels, model = fitted
    assert quality.predict(docs.where(F.lit(False)), model).count() == 0
    for some, good in (("quality = 1", True), ("quality > 5", True), ("quality = 0", False)):
        got = quality.predict(docs.limit(3), quality.fit(docs, labels.where(some))).collect()
        assert len(got) == 3 and all((r.score > 0.9) if good else (r.score < 0.1) for r in got)
