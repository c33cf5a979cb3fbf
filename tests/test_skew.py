from pyspark.sql import functions as F

from tessera.operators import skew


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_join_equals_a_plain_join(spark):
    left = spark.range(0, 4000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97)).alias("k"), F.col("id").alias("v"))
    keys = left.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s")).where("k % 5 <> 4")
    want = sorted(map(tuple, left.join(keys.drop("n"), "k").collect()))
    for rows in (1000, 50, 2, 1, 0):
        got = skew.split_join(left, keys, ["k"], "n", rows)
        assert got.columns == ["k", "v", "s"]
        assert sorted(map(tuple, got.collect())) == want


def test_frequent_cut(spark):
    keys = spark.createDataFrame([(k, 1 if k else 1000) for k in range(100)], "k long, n long")
    assert skew.frequent_cut(keys, "n", 100) == 0
    assert skew.frequent_cut(keys, "n", 99) == 512
    assert skew.frequent_cut(keys, "n", 0) is None
    assert skew.frequent_cut(keys.where("false"), "n", 5) == 0


def test_only_rare_keys_are_shuffled(spark):
    left = spark.range(0, 1000).select((F.col("id") % 2 * 0 + 7).cast("int").alias("k"))
    keys = spark.createDataFrame([(7, 1000), (8, 1), (9, 1)], "k int, n long")
    text = plan(skew.split_join(left, keys, ["k"], "n", 1))
    assert "Union" in text and "LeftAnti" in text and text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" in text
