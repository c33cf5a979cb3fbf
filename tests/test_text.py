from pyspark.sql import functions as F

from tessera.functions import text as tx


def test_clean_title_and_text(spark):
    rows = [(1, "A: B"), (2, "  X "), (3, ""), (4, None), (5, "Ünïcode: tail"), (6, "line one\nline two: x")]
    df = spark.createDataFrame(rows, "id int, t string")
    out = {r["id"]: r["k"] for r in df.select("id", tx.clean_title("t").alias("k")).collect()}
    assert out == {1: "a", 2: "x", 3: "", 4: None, 5: "ünïcode", 6: "line one\nline two"}
    got = {r["id"]: r["c"] for r in df.select("id", tx.clean_text("t").alias("c")).collect()}
    assert got[5] == "ncode: tail" and got[6] == "line oneline two: x" and got[4] is None


def test_tokenizers(spark):
    df = spark.createDataFrame([(1, "Hello, World!  a b_c 42"), (2, None)], "id int, t string")
    r = {x["id"]: (x["ws"], x["wd"]) for x in df.select("id", tx.whitespace_tokens("t").alias("ws"), tx.word_tokens("t").alias("wd")).collect()}
    assert r[1][0] == ["hello,", "world!", "a", "b_c", "42"]
    assert r[1][1] == ["hello", "world", "b_c", "42"]
    assert r[2] == ([], [])


def test_path_label_and_prefix(spark):
    df = spark.createDataFrame([(1, 2, None)], "a int, b int, c int")
    row = df.select(tx.path_label("a", "b", "c").alias("p"), tx.with_prefix(F.lit("q"), tx.QUERY_PREFIX).alias("q")).first()
    assert row["p"] == "Cluster 1.2" and row["q"] == "Query: q"
