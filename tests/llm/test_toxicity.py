import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity
from tessera.llm.common import crc_fold

DIR = "/root/testdata/sf0.1"


def brute_segments(score):
    """Maximal segments by their definition: the best of all, then left and right of it."""
    if not len(score) or max(score) <= 0:
        return []
    total = np.concatenate([[0], np.cumsum(score)])
    best = max(((total[b] - total[a], -(b - a), -a) for a in range(len(score)) for b in range(a + 1, len(score) + 1)))
    n, a = -best[1], -best[2]
    left, right = brute_segments(score[:a]), brute_segments(score[a + n :])
    return left + [(a, a + n, best[0])] + [(x + a + n, y + a + n, s) for x, y, s in right]


@pytest.mark.parametrize("seed", range(60))
def test_segments_equal_the_definition(seed):
    rnd = random.Random(seed)
    score = np.array([rnd.choice([-3, -2, -1, -1, 1, 2, 5]) + rnd.random() * 0.01 for _ in range(rnd.randint(0, 40))])
    total = np.concatenate([[0.0], np.cumsum(score)])
    hot = np.flatnonzero(score > 0)
    got = [(int(hot[i]), int(hot[j]) + 1, s) for i, j, s in toxicity.segments(total[hot].tolist(), total[hot + 1].tolist())]
    want = brute_segments(score)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_log_odds_sign_and_shrinkage():
    odds = toxicity._log_odds(np.array([5000.0, 0, 1, 50_000]), np.array([0.0, 5000, 0, 50_000]))
    assert odds[0] > 1 and odds[1] < -1 and odds[2] == 0 and abs(odds[3]) < 0.1


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    return docs, labels, toxicity.fit(docs, labels.where(crc_fold("doc_id", 4) != 2))


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    rows = toxicity.predict(docs, model).where(crc_fold("doc_id", 4) == 2).join(labels, "doc_id").select("score", "toxic").toPandas()
    bad, good = rows[rows.toxic == 1].score, rows[rows.toxic == 0].score
    assert (bad >= 0.3).mean() > 0.8 and (good >= 0.3).mean() < 0.05  # some labels are noise
    assert rows.score.between(0, 1).all()


def test_passages_cover_planted_words_only(fitted, spark):
    _, _, model = fitted
    clean = "the of and thing on anea. " * 40
    text = clean + "you stupid worthless idiot, pathetic moron " + clean
    got = toxicity.predict(spark.createDataFrame([(1, text), (2, clean)], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert got[0].score >= 0.5 and got[1].score < 0.1 and got[1].passages == []
    (passage,) = got[0].passages
    assert text.encode()[passage.start : passage.end].decode() == "stupid worthless idiot, pathetic moron"


def test_odd_texts_and_clashing_columns(fitted, spark):
    _, _, model = fitted
    rows = [(1, None, 1), (2, "", 1), (3, "... !", 1), (4, "IDIOT " * 50_000, 1), (None, "moron idiot scum", 2), (4, "x", 3), (4, "x", 3)]
    got = toxicity.predict(spark.createDataFrame(rows, "doc_id long, text string, c1 int"), model)
    assert got.columns == ["doc_id", "text", "c1", "score", "passages"]
    by = {(r.doc_id, (r.text or "")[:3]): r for r in got.collect()}
    assert got.count() == len(rows)
    assert by[(1, "")].score == by[(2, "")].score == by[(3, "...")].score == by[(4, "x")].score < 0.3
    assert by[(4, "IDI")].score > 0.9 and by[(None, "mor")].score > 0.9


def test_empty_tables(fitted):
    docs, labels, model = fitted
    assert toxicity.predict(docs.where(F.lit(False)), model).count() == 0
    for some, score in (("toxic = 0", 0), ("toxic > 5", 0), ("toxic = 1 and doc_id < 300", 0.8)):
        known = labels.where(some)
        got = toxicity.predict(docs.limit(3), toxicity.fit(docs, known)).collect()
        assert len(got) == 3 and all(r.passages == [] and (r.score > score if score else r.score < 1e-9) for r in got)
    assert toxicity._batch_segments(pa.array([], pa.string()), model) == []
