"""TF-IDF keywords per cluster node.

Instead of a fit per cluster (1 + 12 + 72 of them), all nodes of all levels are
scored in the same group-bys:

* tf(d, t) per document (vectorizer tokens minus stop words);
* per node: keep the ``max_features`` terms with the largest total tf
  (ties: term asc), N = documents in the node (token-free ones too),
  idf = ln((1 + N) / (1 + df)) + 1;
* w = tf * idf, L2-normalized per document over the kept terms;
* score(t) = sum over the node's documents of w; top n by score (rounded to
  6 places) desc, term asc.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx
from ..functions.stopwords import KEYWORD_STOP_WORDS, stop_word_frame
from ..session import cut_lineage
from .skew import FREQUENT_ROWS, split_join, text_tasks

MAX_FEATURES = 1000
SCORE_DIGITS = 6


def _path_items(level_cols: list[str]):
    """Array of (level, path) structs for one row; a level exists only below a
    non-NULL parent; path = "a", "a.b", "a.b.c"."""
    items = []
    for i in range(len(level_cols)):
        cols = level_cols[: i + 1]
        ok = F.lit(True)
        for c in cols:
            ok = ok & F.col(c).isNotNull()
        items.append(F.when(ok, F.struct(F.lit(i + 1).alias("level"), F.concat_ws(".", *[F.col(c).cast("string") for c in cols]).alias("path"))))
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def node_paths(df: DataFrame, id_col: str, level_cols: list[str]) -> DataFrame:
    """(id, level, path): one row per node a document belongs to."""
    exploded = df.select(F.col(id_col).alias("id"), F.explode(_path_items(level_cols)).alias("n"))
    return exploded.select("id", "n.level", "n.path")


def text_node_scores(df: DataFrame, id_col: str, text_col: str, level_cols: list[str], max_features: int = MAX_FEATURES,
                     stop_words: list[str] = KEYWORD_STOP_WORDS, frequent_rows: int = FREQUENT_ROWS) -> DataFrame:
    """(level, path, term, score) for every node, straight from the texts.

    Terms are counted per document under one number that stands for its full
    path (``leaf``); node statistics come from (leaf, term) sums through the
    small table that says which nodes lie above a leaf. A term that stands in
    every document is no key of a shuffle: it meets its rows by broadcast, as one
    of at most ``frequent_rows`` frequent (leaf, term) pairs, and its scores are
    summed in each task first. Ids are unique. The texts are shuffled by id, a bounded
    number of bytes to a task, and their terms counted there: that task's memory does not
    grow with the table, and no (id, term) row is shuffled to be counted.
    """
    tasks = text_tasks(df, text_col)
    leaf = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in level_cols])
    base = df.select(F.col(id_col).alias("id"), leaf.alias("leaf"), _path_items(level_cols).alias("paths"), F.col(text_col).alias("_text"))
    above = base.select("leaf", F.explode("paths").alias("p")).groupBy("leaf", "p.level", "p.path").agg(F.count(F.lit(1)).alias("n"))
    n_docs = above.groupBy("level", "path").agg(F.sum("n").alias("N"))
    above = above.select("leaf", "level", "path")
    texts = base.where(F.size("paths") > 0).select("id", "leaf", "_text").repartition(tasks, "id")
    toks = texts.select("id", "leaf", F.explode(tx.word_tokens("_text")).alias("term"))
    toks = toks.join(F.broadcast(stop_word_frame(df.sparkSession, stop_words, "term")), "term", "left_anti")
    # read by the statistics and by the weights: written once, so texts are tokenized once
    tf = cut_lineage(toks.groupBy("id", "leaf", "term").agg(F.count(F.lit(1)).alias("tf")))
    by_leaf = cut_lineage(tf.groupBy("leaf", "term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df")))
    placed = by_leaf.join(above, "leaf")
    stats = placed.groupBy("level", "path", "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
    w = Window.partitionBy("level", "path").orderBy(F.col("total").desc(), F.col("term").asc())
    vocab = stats.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_features)
    vocab = vocab.join(n_docs, ["level", "path"]).select("level", "path", "term", (F.log((F.col("N") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))
    # a (leaf, term) with its idf on each level; a frequent one meets its rows by broadcast
    levels = range(1, len(level_cols) + 1)
    keys = placed.select("leaf", "term", "level", "path", "df").join(vocab, ["level", "path", "term"]).groupBy("leaf", "term").agg(
        F.max("df").alias("rows"), *[F.max(F.when(F.col("level") == i, F.col("idf"))).alias(f"idf{i}") for i in levels]
    )
    known = split_join(tf, cut_lineage(keys), ["leaf", "term"], "rows", frequent_rows)
    # a document's terms as one array beside its norms: one shuffle, no row per level
    docs = known.groupBy("id", "leaf").agg(
        F.collect_list(F.struct("term", "tf", *[f"idf{i}" for i in levels])).alias("terms"),
        *[F.sqrt(F.sum(F.pow(F.col("tf") * F.col(f"idf{i}"), F.lit(2.0)))).alias(f"norm{i}") for i in levels],
    )
    each = docs.select("leaf", F.explode("terms").alias("t"), *[f"norm{i}" for i in levels])
    sums = each.groupBy("leaf", F.col("t.term").alias("term")).agg(
        *[F.sum(F.col("t.tf") * F.col(f"t.idf{i}") / F.col(f"norm{i}")).alias(f"s{i}") for i in levels]
    )
    by_level = sums.select("leaf", "term", F.posexplode(F.array(*[f"s{i}" for i in levels])).alias("i", "s")).where("s is not null")
    scored = by_level.withColumn("level", F.col("i") + 1).join(above, ["leaf", "level"])
    return scored.groupBy("level", "path", "term").agg(F.sum("s").alias("score"))


def top_keywords(scores: DataFrame, n: int) -> DataFrame:
    """(level, path, keywords): top n terms per node, joined ', ' in rank order."""
    r = scores.withColumn("s", F.round("score", SCORE_DIGITS))
    w = Window.partitionBy("level", "path").orderBy(F.col("s").desc(), F.col("term").asc())
    ranked = r.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    # at most n entries per node: a bounded collect
    agg = ranked.groupBy("level", "path").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("kw"))
    return agg.select("level", "path", tx.join_list(F.transform("kw", lambda x: x["term"])).alias("keywords"))


def node_keywords(df: DataFrame, id_col: str, text_col: str, level_cols: list[str], n: int) -> DataFrame:
    """(level, path, size, keywords) for every node; a node without terms has ''."""
    sizes = node_paths(df, id_col, level_cols).groupBy("level", "path").agg(F.count(F.lit(1)).alias("size"))
    kw = top_keywords(text_node_scores(df, id_col, text_col, level_cols), n)
    return sizes.join(kw, ["level", "path"], "left").select("level", "path", "size", F.coalesce("keywords", F.lit("")).alias("keywords"))


def group_keywords(df: DataFrame, id_col: str, text_col: str, group_col: str, n: int = 5) -> DataFrame:
    """Top n keywords of each group of texts: (group, keywords)."""
    kw = node_keywords(df, id_col, text_col, [group_col], n)
    return kw.select(F.col("path").cast(df.schema[group_col].dataType).alias(group_col), "keywords")


def level_keywords(df: DataFrame, id_col: str, text_col: str, level_cols: list[str], n: int = 10) -> DataFrame:
    """I22 + C3: each row with ``<level>_keywords`` for each of its levels (NULL below a leaf).

    The node table (one row per node) is written once and joined per level."""
    kw = cut_lineage(node_keywords(df, id_col, text_col, level_cols, n))
    out = df
    for i, c in enumerate(level_cols):
        parts = level_cols[: i + 1]
        complete = F.lit(True)
        for x in parts:
            complete = complete & F.col(x).isNotNull()
        key = F.when(complete, F.concat_ws(".", *[F.col(x).cast("string") for x in parts]))
        node_kw = kw.filter(F.col("level") == i + 1).select(F.col("path").alias(f"_p{i}"), F.col("keywords").alias(f"{c}_keywords"))
        out = out.withColumn(f"_p{i}", key).join(node_kw, f"_p{i}", "left").drop(f"_p{i}")
    return out


def level1_report(df: DataFrame, id_col: str, text_col: str, level_col: str, n: int = 10) -> DataFrame:
    """The Level-1 rows of the node table: (level_1, keywords)."""
    return group_keywords(df, id_col, text_col, level_col, n)
