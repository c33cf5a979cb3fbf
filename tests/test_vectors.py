import numpy as np
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import quality, retrieve, similarity


def vec_df(spark, mat, labels=None):
    rows = [(i, [float(x) for x in v], None if labels is None else int(labels[i])) for i, v in enumerate(mat)]
    return spark.createDataFrame(rows, "id long, vec array<float>, label int")


def test_cosine_zero_and_opposite(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], [2.0, 0.0]), (2, [0.0, 0.0], [1.0, 1.0]), (3, [1.0, 2.0], [-1.0, -2.0])], "id int, a array<double>, b array<double>")
    r = {x["id"]: x["c"] for x in df.select("id", V.cosine("a", "b").alias("c")).collect()}
    assert r[1] == 1.0 and r[2] is None and abs(r[3] + 1.0) < 1e-12
    n = df.select(V.normalize("b").alias("u")).collect()
    assert abs(n[0]["u"][0] - 1.0) < 1e-12


def test_topk_ties_by_id(spark):
    df = vec_df(spark, [[1, 0], [1, 0], [0, 1], [1, 0]])
    out = similarity.cosine_topk(df, "id", "vec", [1.0, 0.0], 2).collect()
    assert [r["id"] for r in out] == [0, 1]


def _rand(n=60, d=5, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, d)).astype(np.float32).astype(np.float64)


def test_knn_matches_brute_force(spark):
    x = _rand()
    df = vec_df(spark, x)
    got = similarity.knn(df, "id", "vec", k=4, nb=3).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)).round(8)
    for i in range(len(x)):
        want = sorted(range(len(x)), key=lambda j: (d[i, j], j))[:4]
        assert sorted(r["dst"] for r in got if r["src"] == i) == sorted(want)


def test_pairwise_threshold_matches_brute_force(spark):
    x = _rand(40, 3, 1)
    df = vec_df(spark, x)
    got = {(r["id_a"], r["id_b"]) for r in similarity.pairwise_similarity(df, "id", "vec", 0.8, nb=3).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = (u @ u.T).round(6)
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= 0.8}
    assert got == want


def _silhouette_np(x, lab):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_silhouette_exact_and_ch(spark):
    x = _rand(50, 4, 2)
    lab = np.array([i % 3 for i in range(50)])
    lab[0] = 7  # a singleton cluster scores 0
    df = vec_df(spark, x, lab)
    got = quality.silhouette(df, "id", "vec", "label", nb=3).first()[0]
    assert abs(got - _silhouette_np(x, lab)) < 1e-9
    ch = quality.calinski_harabasz(df, "label", "vec").first()[0]
    mu = x.mean(0)
    cl = sorted(set(lab))
    b = sum((lab == c).sum() * ((x[lab == c].mean(0) - mu) ** 2).sum() for c in cl)
    w = sum(((x[lab == c] - x[lab == c].mean(0)) ** 2).sum() for c in cl)
    assert abs(ch - (b / (len(cl) - 1)) / (w / (len(x) - len(cl)))) < 1e-7


def test_silhouette_sq_matches_mllib(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator

    x = _rand(80, 4, 3)
    lab = np.array([i % 4 for i in range(80)])
    df = vec_df(spark, x, lab)
    ours = quality.silhouette_sq(df, "id", "vec", "label").first()[0]
    feats = df.select(V.to_ml_vector("vec").alias("features"), F.col("label").cast("double").alias("prediction"))
    theirs = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(feats)
    assert abs(ours - theirs) < 1e-9


def test_two_stage_finds_planted_duplicate(spark):
    x = _rand(200, 8, 4)
    q = x[17] + 1e-3
    df = vec_df(spark, x).withColumn("fine", F.col("vec"))
    top = retrieve.two_stage(df, "id", "vec", "fine", q.tolist(), q.tolist(), 20, 3).collect()
    assert top[0]["id"] == 17 and "coarse_similarity" in top[0].asDict()
    qs = spark.createDataFrame([(0, [float(v) for v in q], [float(v) for v in q])], "qid long, qc array<double>, qf array<double>")
    batch = retrieve.batch_two_stage(df, "id", "vec", "fine", qs, "qid", "qc", "qf", 20, 3).collect()
    assert [r["id"] for r in sorted(batch, key=lambda r: -r["similarity"])] == [r["id"] for r in top]


def test_knn_lsh_recall(spark):
    x = _rand(200, 4, 9) * 0.3
    df = vec_df(spark, x)
    exact = {(r["src"], r["dst"]) for r in similarity.knn(df, "id", "vec", k=5, nb=2).collect()}
    approx = {(r["src"], r["dst"]) for r in similarity.knn_lsh(df, "id", "vec", k=5, radius=2.0, bucket_length=2.0, tables=6).collect()}
    assert len(exact & approx) / len(exact) >= 0.9


def test_batch_topk_matches_single_queries(spark):
    x = _rand(300, 6, 12)
    df = vec_df(spark, x)
    qs = _rand(7, 6, 13)
    qdf = spark.createDataFrame([(i, [float(v) for v in q]) for i, q in enumerate(qs)], "qid long, q array<double>")
    batch = similarity.batch_topk(df.repartition(4), "id", "vec", qdf, "qid", "q", 5).collect()
    for i, q in enumerate(qs):
        single = [r["id"] for r in similarity.cosine_topk(df, "id", "vec", q.tolist(), 5).collect()]
        got = [r["id"] for r in sorted((r for r in batch if r["qid"] == i), key=lambda r: (-r["similarity"], r["id"]))]
        assert got == single


def test_texts_without_tokens_keep_their_rows(spark):
    from tessera.operators import embed

    df = spark.createDataFrame([(1, "alpha beta"), (2, ""), (3, None), (4, "alpha")], "id long, text string")
    ctx = embed.context_stats(df, "id", "text", 8)
    mean = np.array(ctx.mean)
    got = {r["id"]: np.array(r["vec"]) for r in embed.context_embedding(df, "id", "text", ctx).collect()}
    assert len(got) == 4 and np.allclose(got[2], -mean / np.linalg.norm(mean)) and np.allclose(got[2], got[3])
    assert {r["id"] for r in embed.hashed_vectors(df, "id", "text", 8).collect() if not any(r["vec"])} == {2, 3}
    assert {r["id"]: r["keywords"] for r in embed.keyphrases(df, "id", "text").collect()}[3] == ""
    index = embed.index_table(df, "id", "text", [], ctx, 8)
    assert index.count() == 4 and index.columns == ["id", "keywords", "doc_vec", "kw_vec"]


def test_stored_index_gives_back_what_was_fitted(spark, tmp_path):
    from tessera.operators import embed

    df = spark.createDataFrame([(i, f"word{i % 5} other{i % 3}", "s") for i in range(30)], "id long, text string, src string")
    embed.save_index(df, "id", "text", ["src"], str(tmp_path), n=20)
    index, ctx = embed.load_index(spark, str(tmp_path))
    fitted = embed.context_stats(embed.sample_corpus(df, "id", 20), "id", "text")
    assert ctx == fitted and index.count() == 30 and "src" in index.columns


def test_batch_topk_in_slices_and_ties(spark):
    x = np.repeat(_rand(40, 4, 3), 3, axis=0)  # every vector three times
    df = vec_df(spark, x).repartition(3)
    qdf = spark.createDataFrame([(i, [float(v) for v in q]) for i, q in enumerate(_rand(9, 4, 5))] + [(99, [0.0] * 4)], "qid long, q array<double>")
    whole, cut = (sorted(map(tuple, similarity.batch_topk(df, "id", "vec", qdf, "qid", "q", 5, query_bytes=b).collect())) for b in (1 << 20, 64))
    assert whole == cut and len([r for r in whole if r[0] < 9]) == 45
    for qid in range(9):
        ids = [r[1] for r in sorted((r for r in whole if r[0] == qid), key=lambda r: (-r[2], r[1]))]
        assert ids[:3] == list(range(ids[0], ids[0] + 3)) and ids[0] % 3 == 0  # equal vectors by id


def test_pair_kernels_stay_within_a_tile():
    import tracemalloc

    from tessera.operators import similarity as S

    rng = np.random.default_rng(3)
    for dim in (2, 512):
        a, ids = rng.normal(size=(6000, dim)), np.arange(6000)
        tracemalloc.start()
        out = [np.concatenate(x) for x in zip(*S._nearest(a, ids, a, ids, 5, False))]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 150 << 20
        some = rng.integers(0, 6000, 20)
        d = np.sqrt(((a[some, None] - a[None]) ** 2).sum(2))
        d[np.arange(20), some] = np.inf
        for r, i in enumerate(some):
            assert set(out[1][out[0] == i]) == set(np.argsort(d[r])[:5])


def test_neighbours_within_groups(spark):
    rng = np.random.default_rng(4)
    x, g = rng.normal(size=(90, 3)), rng.integers(0, 3, 90)
    rows = [(i, [float(v) for v in x[i]], int(g[i]) if i % 10 else None) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, g int")
    from tessera.operators import similarity as S

    got = {}
    for r in S.knn(df, "id", "vec", 4, include_self=False, nb=2, within=["g"]).collect():
        got.setdefault(r.src, []).append((r["rank"], r.dst))
    for i in range(90):
        if i % 10 == 0:
            assert i not in got
            continue
        own = [j for j in range(90) if j % 10 and g[j] == g[i] and j != i]
        want = sorted(own, key=lambda j: ((x[i] - x[j]) ** 2).sum())[:4]
        assert [d for _, d in sorted(got[i])] == want


def test_label_distance_sums_take_each_block_pair_once(spark, monkeypatch):
    import numpy as np

    from tessera.operators import similarity as S

    rng = np.random.default_rng(11)
    x, label = rng.normal(size=(90, 4)), rng.integers(0, 5, 90)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, label))], "id long, vec array<double>, c int")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    monkeypatch.setattr(S, "TILE_ROWS", 7)
    monkeypatch.setattr(S, "TILE_COLUMNS", 7)
    got = {(r.id, r.other_label): (r.label, r.sum_dist, r.n) for r in S.label_distance_sums(df, "id", "vec", "c", 3).collect()}
    assert len(got) == 90 * 5
    for (i, c), (own, total, n) in got.items():
        assert own == label[i] and n == (label == c).sum() and abs(total - d[i, label == c].sum()) < 1e-9
    # every distance is taken once between two blocks
    calls = []
    inner = S._sq_distances
    table = df.toArrow().rename_columns(["id", "vec", "c"])
    kernel = {}
    monkeypatch.setattr(S, "_run_blocks", lambda d, i, v, extra, k, schema, nb=None, within=(): kernel.setdefault("k", k) and d.selectExpr("id", "c label", "c other_label", "0d sum_dist", "1L n"))
    S.label_distance_sums(df, "id", "vec", "c", 2)
    monkeypatch.setattr(S, "_sq_distances", lambda a, b: calls.append(len(a) * len(b)) or inner(a, b))
    list(kernel["k"](table.slice(0, 40), table.slice(40), False))
    assert sum(calls) == 40 * 50


def test_nearest_partitions_a_tile_only_until_rows_are_full(monkeypatch):
    from tessera.operators import similarity as S

    rng = np.random.default_rng(4)
    x = rng.normal(size=(640, 6))
    x[300:330] = x[7]  # ties
    x[11] *= 1e6  # an outlier
    ids = rng.permutation(640)
    monkeypatch.setattr(S, "TILE_ROWS", 64)
    monkeypatch.setattr(S, "TILE_COLUMNS", 64)
    calls, inner = [], np.partition
    monkeypatch.setattr(S.np, "partition", lambda *a, **k: calls.append(1) or inner(*a, **k))
    got = [np.concatenate(y) for y in zip(*S._nearest(x, ids, x, ids, 5, False))]
    exact = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), S.DIST_DIGITS)
    exact[np.arange(640), np.arange(640)] = np.inf
    order = np.lexsort((np.broadcast_to(ids, exact.shape), exact))[:, :5]
    assert {s: [] for s in ids} | {s: [d for q, d in zip(got[0], got[1]) if q == s] for s in ids} == {ids[r]: list(ids[order[r]]) for r in range(640)}
    assert len(calls) <= 2 * 10  # 100 tiles


def test_batch_sends_few_candidates_to_the_stored_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in a], [float(v) for v in b]) for i, (a, b) in enumerate(zip(rng.normal(size=(80, 4)), rng.normal(size=(80, 4))))]
    corpus = spark.createDataFrame(rows, "id long, kw array<double>, doc array<double>").repartition(3)
    asked = spark.createDataFrame(rows[:6], "qid long, coarse array<double>, fine array<double>")

    def batch():
        return retrieve.batch_two_stage(corpus, "id", "kw", "doc", asked, "qid", "coarse", "fine", k1=20, k2=4)

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = batch()
        assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(retrieve, "BROADCAST_CANDIDATES", 20 * 6 - 1)
        many = batch()
        assert "BroadcastHashJoin" not in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() == 6 * 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
