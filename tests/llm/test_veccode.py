import math
import random

import numpy as np
import pytest

from tessera.llm import veccode


def brute(vectors, parts, entries, rounds, scale):
    """The same codes by full search in Python integers."""
    x = [[math.floor(scale * c) for c in v] for v in vectors]
    size = len(x[0]) // parts
    cut = [[tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for v in x]
    books = [[cut[i][p] for i in range(min(entries, len(x)))] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(near(v[p], books[p])[1], []).append(v[p])
            for k, g in groups.items():
                books[p][k] = tuple(sum(c) // len(g) for c in zip(*g))
    found = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    return [bytes(k for _, k in f) for f in found], [sum(d for d, _ in f) for f in found], books


@pytest.mark.parametrize("seed", range(20))
def test_nearest_equals_full_search(seed):
    rng = np.random.default_rng(seed)
    spread = int(rng.choice([2, 5, 300, 10**6]))  # small ones make ties
    x, book = rng.integers(-spread, spread + 1, (500, 4)), rng.integers(-spread, spread + 1, (30, 4))
    pivots = veccode.choose_pivots(book)
    to_pivots = ((x[:, None] - pivots[None]) ** 2).sum(2)
    full = ((x[:, None] - book[None]) ** 2).sum(2)
    index, best, evaluated = veccode.nearest(x, to_pivots, book, pivots)
    assert (index == full.argmin(1)).all() and (best == full.min(1)).all()
    assert evaluated < full.size * 0.8


def test_few_evaluations_on_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(256 * np.array([r.embedding for r in rows], np.float64)).astype(np.int64)[:, :4]
    book = x[:64]
    pivots = veccode.choose_pivots(book)
    evaluated = veccode.nearest(x, ((x[:, None] - pivots[None]) ** 2).sum(2), book, pivots)[2]
    assert evaluated < len(x) * 64 / 4


def test_codes_equal_brute_force(spark):
    rnd = random.Random(5)
    vectors = [[rnd.choice([0.0, -0.004, 0.5, -1.0, rnd.gauss(0, 1)]) for _ in range(8)] for _ in range(120)]
    vectors += [vectors[3], vectors[3], vectors[0]]
    labels = [rnd.choice([1, 2, None]) for _ in vectors]
    df = spark.createDataFrame([(k, v, c, "x", 1) for k, (v, c) in enumerate(zip(vectors, labels))], "vec_id long, embedding array<float>, label int, row string, error int")
    vectors = [[float(np.float32(c)) for c in v] for v in vectors]
    codes, errors, books = brute(vectors, 4, 10, 2, 256)
    got = veccode.encode(df.repartition(5), parts=4, entries=10)
    assert got.codebooks.tolist() == [[list(e) for e in b] for b in books]
    total = {}
    for c, e in zip(labels, errors):
        total[c] = total.get(c, 0) + e
    out = {r.vec_id: (bytes(r.codes), r.error, r.label_error) for r in veccode.with_label_error(got).collect()}
    assert out == {k: (codes[k], errors[k], total[labels[k]]) for k in range(len(vectors))}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [1.0, -inf], 1), (5, [], 1), (6, [0.5, -0.001], None), (6, [0.25, 3.0], None), (None, [9.0, 9.0], 2), (7, [1.0, 2.0, 3.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = veccode.encode(df, parts=2, entries=64)
    out = veccode.with_label_error(got).collect()
    assert sorted(r.vec_id or 0 for r in out) == [0, 6, 6]
    assert got.codebooks.shape == (2, 2, 1)
    codes, errors, books = brute([[0.25, 3.0], [0.5, -0.001], [9.0, 9.0]], 2, 2, 2, 256)
    assert got.codebooks.tolist() == [[list(e) for e in b] for b in books]
    assert sorted((bytes(r.codes), r.error) for r in out) == sorted(zip(codes, errors))


def test_refused_and_empty(spark):
    schema = "vec_id long, embedding array<float>, label int"
    with pytest.raises(ValueError):
        veccode.encode(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], schema), parts=2)
    with pytest.raises(Exception, match="too large"):
        veccode.encode(spark.createDataFrame([(1, [1e9, 2.0], 1)], schema), parts=2).rows.collect()
    for rows in ([], [(1, None, 1)]):
        assert veccode.with_label_error(veccode.encode(spark.createDataFrame(rows, schema))).count() == 0
