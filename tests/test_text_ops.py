import math

import pytest

from tessera.operators import embed
from tessera.operators import keywords as K
from tessera.operators import language as L


def test_group_keywords_tfidf_by_hand(spark):
    rows = [(1, "apple apple banana", 0), (2, "banana cherry", 0), (3, "the and of", 0), (4, "zebra", 1)]
    df = spark.createDataFrame(rows, "id long, text string, g int")
    kw = {r["g"]: r["keywords"] for r in K.group_keywords(df, "id", "text", "g", 2).collect()}
    # group 0: N = 3 (stop-word-only text counts), df(apple)=1, df(banana)=2, df(cherry)=1
    idf = lambda d: math.log(4 / (1 + d)) + 1
    d1 = {"apple": 2 * idf(1), "banana": idf(2)}
    d2 = {"banana": idf(2), "cherry": idf(1)}
    score = {}
    for d in (d1, d2):
        n = math.sqrt(sum(v * v for v in d.values()))
        for t, v in d.items():
            score[t] = score.get(t, 0) + v / n
    want = [t for t, _ in sorted(score.items(), key=lambda kv: (-round(kv[1], 6), kv[0]))][:2]
    assert kw[0] == ", ".join(want) and kw[1] == "zebra"


def test_language_scorer(spark):
    train = [
        (1, "the cat sat on the mat with the hat", "en"),
        (2, "where is the house and the garden", "en"),
        (3, "der hund und die katze sind im haus", "de"),
        (4, "die katze schläft unter dem tisch", "de"),
    ]
    df = spark.createDataFrame(train, "id long, text string, lang string")
    model = L.train(df, "id", "text", "lang")
    test = spark.createDataFrame([(10, "the garden and the cat"), (11, "der tisch und die katze"), (12, "12345 !!!"), (13, ""), (14, None)], "id long, text string")
    pred = {r["id"]: r["lang_pred"] for r in L.with_language(test, "id", "text", model).collect()}
    assert pred == {10: "en", 11: "de", 12: None, 13: None, 14: None}
    kept = [r["id"] for r in L.keep_english(test, "id", "text", model).collect()]
    assert kept == [10]
    assert L.decode_gram((ord("a") << 42) | (ord("b") << 21) | ord("c")) == "abc"


def test_language_by_join_says_the_same(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = L.train(df, "doc_id", "text", "lang")
    a, b = (sorted(tuple(r) for r in L.with_language(df, "doc_id", "text", model, most).select("doc_id", "lang_pred").collect()) for most in (L.MAX_WEIGHTS, 0))
    assert a == b and len(a) == 200


def test_nodes_without_terms_and_null_names_are_kept(spark):
    from tessera.operators import tree

    rows = [(1, "the of", "x", 1, 1), (2, "apple pie", None, 1, 2), (3, "", "y", 2, None), (4, None, None, 2, None)]
    df = spark.createDataFrame(rows, "id long, text string, prof string, a int, b int")
    assert {r["a"]: r["keywords"] for r in K.group_keywords(df, "id", "text", "a", 2).collect()} == {1: "apple, pie", 2: ""}
    nodes = {r["node_id"]: (r["size"], r["keywords"], r["top_professors"]) for r in tree.tree_nodes(df, "id", "text", "prof", ["a", "b"]).collect()}
    assert nodes == {"Cluster 1": (2, "apple, pie", "x (1)"), "Cluster 1.1": (1, "", "x (1)"), "Cluster 1.2": (1, "apple, pie", None), "Cluster 2": (2, "", "y (1)")}
    kept = {r["id"]: (r["a_keywords"], r["b_keywords"]) for r in K.level_keywords(df, "id", "text", ["a", "b"], 1).collect()}
    assert kept == {1: ("apple", ""), 2: ("apple", "apple"), 3: ("", None), 4: ("", None)}
    text = {r["node_id"]: r["description"] for r in tree.describe_node(tree.tree_nodes(df, "id", "text", "prof", ["a"])).collect()}
    assert text["Cluster 2"] == "Cluster 2\nKeywords: \nProfessors: y (1)"


def _common_texts():
    """120 documents on two levels, one word in all of them, others in one or a few."""
    rows = [(i, f"everywhere everywhere word{i % 7} only{i} pair{i // 2}" + " more" * (i % 3), i % 2, i % 3 if i % 5 else None) for i in range(120)]
    return rows, "id long, text string, a int, b int"


def _scores_by_hand(rows):
    """(level, path, term) -> score: tf-idf per node, each document scaled to length one."""
    nodes = {}
    for i, text, a, b in rows:
        nodes.setdefault((1, f"{a}"), []).append(text.split())
        if b is not None:
            nodes.setdefault((2, f"{a}.{b}"), []).append(text.split())
    out = {}
    for (level, path), docs in nodes.items():
        df = {}
        for d in docs:
            for t in set(d):
                df[t] = df.get(t, 0) + 1
        for d in docs:
            w = {t: d.count(t) * (math.log((len(docs) + 1) / (df[t] + 1)) + 1) for t in set(d)}
            size = math.sqrt(sum(x * x for x in w.values()))
            for t, x in w.items():
                out[level, path, t] = out.get((level, path, t), 0.0) + x / size
    return out


@pytest.mark.parametrize("frequent", [200_000, 12, 0])
def test_keyword_scores_with_a_term_in_every_document(spark, frequent):
    rows, schema = _common_texts()
    got = K.text_node_scores(spark.createDataFrame(rows, schema), "id", "text", ["a", "b"], stop_words=["of"], frequent_rows=frequent)
    found = {(r["level"], r["path"], r["term"]): r["score"] for r in got.collect()}
    want = _scores_by_hand(rows)
    assert found.keys() == want.keys()
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("frequent", [200_000, 12, 0])
def test_keyphrases_with_a_term_in_every_document(spark, frequent):
    rows, schema = _common_texts()
    got = {r["id"]: r["keywords"] for r in embed.keyphrases(spark.createDataFrame(rows, schema), "id", "text", 3, frequent).collect()}
    df = {}
    for _, text, *_ in rows:
        for t in set(text.split()) - {"more"}:
            df[t] = df.get(t, 0) + 1
    for i, text, *_ in rows:
        terms = set(text.split()) - {"more"}  # a stop word
        score = {t: round(text.split().count(t) * (math.log(121 / (df[t] + 1)) + 1), 6) for t in terms}
        assert got[i] == ", ".join(sorted(terms, key=lambda t: (-score[t], t))[:3])


def test_a_common_term_is_no_shuffle_key(spark):
    rows, schema = _common_texts()
    df = spark.createDataFrame(rows, schema)
    for got in (K.text_node_scores(df, "id", "text", ["a", "b"], frequent_rows=12), embed.keyphrases(df, "id", "text", 3, 12)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        # the frequent keys by broadcast, the rest without them by shuffle
        assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_terms_are_counted_in_tasks_of_bounded_text(spark, monkeypatch):
    from tessera.operators import embed, skew
    from tessera.operators import keywords as K

    monkeypatch.setattr(skew, "TASK_BYTES", 1000)
    df = spark.createDataFrame([(i, f"alpha beta w{i} " * 20, 0) for i in range(40)] + [(40, None, 0)], "id long, text string, a int")
    total = sum(len(f"alpha beta w{i} " * 20) for i in range(40))
    assert skew.text_tasks(df, "text") == -(-total // 1000)
    plan = embed.doc_tokens(df, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan  # texts by id, and no (id, term) row after them
    plans, inner = [], K.cut_lineage
    monkeypatch.setattr(K, "cut_lineage", lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString()) or inner(d))
    scores = {r["term"]: r["score"] for r in K.text_node_scores(df, "id", "text", ["a"]).collect()}
    assert set(scores) == {"alpha", "beta", *(f"w{i}" for i in range(40))}
    assert plans[0].count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plans[0]
