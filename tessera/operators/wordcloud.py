"""Word-cloud frequency table (the table behind the picture; no drawing).

Follows the public behaviour of the usual word-cloud text processing:

* tokens ``\\w[\\w']*`` (Unicode letters/digits/underscore), a trailing
  ``'s`` removed, pure numbers dropped;
* bigrams are taken from consecutive tokens *before* stop words go, and any
  bigram holding a stop word is dropped; unigrams are the non-stop tokens;
* plural folding: a key ending in ``s`` (not ``ss``) whose singular is also a
  key is counted under the singular (for unigrams and bigrams alike);
* a bigram is a collocation when Dunning's log-likelihood score exceeds 30;
  its count is then subtracted from both words and it enters the table;
* keys with a count <= 0 go; the top ``max_words`` by count (ties: word asc)
  get weight = count / largest count.

Differences, by design: bigrams are formed inside each document (the
original joins all texts with a space first, so a bigram could span two
rows depending on row order), and words are shown lower-cased (the original
shows the most frequent spelling).

All steps are group-bys and equi-joins over the vocabulary; token arrays are
built and paired with JVM array functions, without Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stopwords import EXPLORE_STOP_WORDS
from ..session import cut_lineage

# Token pattern, collocation threshold, number of words.
TOKEN = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"
DIGITS_ONLY = r"^\p{Nd}+$"
COLLOCATION_THRESHOLD = 30.0
MAX_WORDS = 100
EPS = 1e-10


def _tokens(df: DataFrame, text_col: str) -> DataFrame:
    """(arr): cleaned token array per document (whole text)."""
    raw = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN), 0)
    stripped = F.transform(F.coalesce(raw, F.array().cast("array<string>")), lambda t: F.when(t.endswith("'s"), F.substring(t, F.lit(1), F.length(t) - 2)).otherwise(t))
    kept = F.filter(stripped, lambda t: ~t.rlike(DIGITS_ONLY))
    return df.select(kept.alias("arr"))


def _fold_plurals(counts: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(folded counts (key, n), standard form map (key -> std))."""
    plural = F.col(key).endswith("s") & ~F.col(key).endswith("ss")
    cand = counts.where(plural).select(key, "n", F.expr(f"substring({key}, 1, length({key}) - 1)").alias("_sing"))
    keys = counts.select(F.col(key).alias("_sing"), F.lit(True).alias("_known"))
    # only keys that may be plurals look for another one
    found = cand.join(keys, "_sing", "left").select(key, F.when(F.col("_known"), F.col("_sing")).otherwise(F.col(key)).alias("std"), "n")
    named = counts.where(~plural).select(key, F.col(key).alias("std"), "n").unionByName(found)
    return named.groupBy(F.col("std").alias(key)).agg(F.sum("n").alias("n")), named.select(key, "std")


def _ll(k, n, x):
    return F.log(F.greatest(x, F.lit(EPS))) * k + F.log(F.greatest(1 - x, F.lit(EPS))) * (n - k)


def wordcloud_weights(df: DataFrame, text_col: str, stop_words: list[str] = EXPLORE_STOP_WORDS, max_words: int = MAX_WORDS) -> DataFrame:
    """(word, count, weight) for the top ``max_words`` entries (words and collocations)."""
    toks = _tokens(df, text_col)

    # every token with the next one, or none behind the last (zip_with fills up
    # with NULL; its lambda only sees its own arguments, as an outer column inside
    # a lambda is re-evaluated per element)
    after = F.slice("arr", F.lit(2), F.size("arr"))
    both = toks.select(F.explode(F.zip_with("arr", after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p")).select("p.a", "p.b")
    stop = list(stop_words)
    both = both.where(~F.col("a").isin(stop)).select("a", F.when(~F.col("b").isin(stop), F.col("b")).alias("b"))
    # texts are tokenized once: the counts of pairs hold those of the words, too
    counts = cut_lineage(both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    # both vocabularies are read several times below: written once each
    uni_counts = cut_lineage(counts.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n")))
    n_words = uni_counts.agg(F.sum("n")).collect()[0][0] or 0  # one scalar
    bi_counts = counts.where("b IS NOT NULL").select(F.concat_ws(" ", "a", "b").alias("key"), "n")

    uni_f, uni_std = _fold_plurals(uni_counts)
    uni_f = cut_lineage(uni_f)
    bi_f, _ = _fold_plurals(bi_counts)

    # score each (folded) bigram against the folded unigram counts of its words
    bi_s = bi_f.select(
        F.col("key"), F.col("n").alias("c12"), F.split_part("key", F.lit(" "), F.lit(1)).alias("w1"), F.split_part("key", F.lit(" "), F.lit(2)).alias("w2")
    )
    words = cut_lineage(uni_std.join(uni_f.select(F.col("key").alias("std"), "n"), "std"))
    first = words.select(F.col("key").alias("w1"), F.col("std").alias("s1"), F.col("n").alias("c1"))
    second = words.select(F.col("key").alias("w2"), F.col("std").alias("s2"), F.col("n").alias("c2"))
    scored = bi_s.join(first, "w1").join(second, "w2")
    N, k12, k1, k2 = F.lit(float(n_words)), F.col("c12").cast("double"), F.col("c1").cast("double"), F.col("c2").cast("double")
    p = k2 / N
    p1 = k12 / k1
    p2 = (k2 - k12) / F.nullif(N - k1, F.lit(0))
    score = -2 * (_ll(k12, k1, p) + _ll(k2 - k12, N - k1, p) - _ll(k12, k1, p1) - _ll(k2 - k12, N - k1, p2))
    colloc = cut_lineage(scored.withColumn("score", score).filter(F.col("score") > COLLOCATION_THRESHOLD).select("key", "s1", "s2", "c12"))

    minus = colloc.select(F.col("s1").alias("key"), (-F.col("c12")).alias("n")).unionByName(
        colloc.select(F.col("s2").alias("key"), (-F.col("c12")).alias("n"))
    )
    table = uni_f.unionByName(minus).groupBy("key").agg(F.sum("n").alias("n")).unionByName(
        colloc.select("key", F.col("c12").alias("n"))
    )
    table = table.filter(F.col("n") > 0)
    top = table.orderBy(F.col("n").desc(), F.col("key").asc()).limit(max_words)
    # at most max_words rows: a window over all of them is one small partition
    mx = F.max("n").over(Window.partitionBy())
    return top.select(F.col("key").alias("word"), F.col("n").cast("bigint").alias("count"), (F.col("n") / mx).alias("weight"))
