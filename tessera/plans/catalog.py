"""Registered queries: the library's operators applied to the driver tables.

Table roles (see SURVEY 7.4): ``documents`` are publications (text =
abstract, source = professor, lang = language truth); ``orders`` is the
dated table (o_custkey = professor, o_orderpriority = authors,
year(o_orderdate) = year); ``embeddings`` holds vectors (label = given
cluster). Every query reads whole tables; each callable takes
``(spark, sf_dir)`` and returns a DataFrame whose column names equal the
oracle SQL's. The title of a record is its whole text.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import clean, explore, language
from ..session import ensure_checkpoint_dir, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed parameters of the registered queries.
FIRST_YEAR = 1995           # documents get a year derived from doc_id: 1995 + doc_id % 7
YEAR_SPAN = 7
TARGET_YEAR = 1998
DIGITS = 6


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- table views


def publications(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` seen as publications."""
    d = table(spark, sf, "documents")
    return d.select(
        F.col("doc_id").alias("pub_id"),
        F.col("source").alias("professor"),
        (F.lit(FIRST_YEAR) + F.pmod(F.col("doc_id"), F.lit(YEAR_SPAN))).cast("int").alias("pub_year"),
        F.col("text").alias("abstract"),
        F.col("lang"),
    )


def dated(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` seen as dated publication records."""
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("pub_id"),
        F.col("o_custkey").alias("professor"),
        F.col("o_orderpriority").alias("authors"),
        F.year("o_orderdate").alias("pub_year"),
    )


def docs_with_labels(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    lab = table(spark, sf, "labels")
    return d.join(lab, "doc_id", "left")


def language_model(spark: SparkSession, sf: str):
    d = table(spark, sf, "documents")
    return language.train(d, "doc_id", "text", "lang")


# ---------------------------------------------------------------- B: cleaning


@register("drop_columns")
def q_drop_columns(spark, sf):
    return clean.drop_columns(table(spark, sf, "orders"), "o_totalprice", "o_orderstatus")


@register("drop_na")
def q_drop_na(spark, sf):
    return clean.drop_missing(docs_with_labels(spark, sf), "quality").select("doc_id", "source", "quality", "toxic")


@register("drop_na_any")
def q_drop_na_any(spark, sf):
    return clean.drop_missing_any(docs_with_labels(spark, sf).select("doc_id", "source", "lang", "quality", "toxic"))


@register("coerce_year")
def q_coerce_year(spark, sf):
    # the landed form writes 'N/A' for a missing number; coercion turns it back into NULL
    # and every third number is written as a float column writes it
    number = F.concat(F.col("quality").cast("string"), F.when(F.col("doc_id") % 3 == 0, F.lit(".0")).otherwise(F.lit("")))
    df = docs_with_labels(spark, sf).select("doc_id", F.coalesce(number, F.lit("N/A")).alias("citations_text"))
    return clean.coerce_numeric(df, "citations_text", "int", out="citations")


@register("fill_missing")
def q_fill_missing(spark, sf):
    df = docs_with_labels(spark, sf).select("doc_id", "quality", "toxic")
    return clean.fill_missing(df, {"quality": 0, "toxic": 0})


@register("cluster_rows")
def q_cluster_rows(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    return clean.select_cluster(e, label=3)


@register("preview")
def q_preview(spark, sf):
    return clean.preview(table(spark, sf, "orders"), 5, "o_orderkey")


@register("keep_recent")
def q_keep_recent(spark, sf):
    return clean.keep_recent(dated(spark, sf), ["professor", "authors"], "pub_year", "pub_id")


@register("language_id")
def q_language_id(spark, sf):
    model = language_model(spark, sf)
    return language.detect(table(spark, sf, "documents"), "doc_id", "text", model)


@register("keep_english")
def q_keep_english(spark, sf):
    model = language_model(spark, sf)
    d = table(spark, sf, "documents").select("doc_id", "source", "text")
    return language.keep_english(d, "doc_id", "text", model).select("doc_id", "source")


def _pubs_flagged(spark, sf):
    model = language_model(spark, sf)
    pubs = publications(spark, sf)
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("pub_id"), "quality", "toxic")
    # toxic = NULL stands for a missing year (labels cover only part of the table)
    pubs = pubs.join(lab, "pub_id", "left").withColumn(
        "pub_year", F.when(F.col("toxic").isNotNull(), F.col("pub_year"))
    )
    return language.with_language(pubs, "pub_id", "abstract", model)


@register("clean_pipeline")
def q_clean_pipeline(spark, sf):
    df = _pubs_flagged(spark, sf)
    out = clean.clean_pipeline(
        df,
        id_col="pub_id",
        text_col="abstract",
        year_col="pub_year",
        keys=["professor", "quality"],
        drop=["lang", "toxic"],
        is_english=F.col("lang_pred") == "en",
    )
    return out.select("pub_id", "professor", "quality", "pub_year")


@register("clean_audit")
def q_clean_audit(spark, sf):
    df = _pubs_flagged(spark, sf)
    return clean.clean_audit(df, year_col="pub_year", keys=["professor", "quality"], is_english=F.col("lang_pred") == "en")


@register("write_clean")
def q_write_clean(spark, sf):
    # the cleaned table, written, with the row counts of its steps from the same job
    df = _pubs_flagged(spark, sf).select("pub_id", "professor", "quality", "pub_year", "lang_pred")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-clean-{uuid.uuid4().hex}"
    counts = clean.write_clean(df, path, id_col="pub_id", year_col="pub_year", keys=["professor", "quality"], drop=[],
                               is_english=F.col("lang_pred") == "en")
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


# ---------------------------------------------------------------- H: text


@register("clean_title")
def q_clean_title(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", tx.clean_title("text").alias("title_key"))


@register("encoder_tokens")
def q_encoder_tokens(spark, sf):
    # H8 + H9: what a plugged encoder with a limit of 512 tokens would read
    tokens = tx.truncate_tokens(tx.whitespace_tokens(tx.with_prefix("text", tx.DOCUMENT_PREFIX)))
    d = table(spark, sf, "documents").select("doc_id", tokens.alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.element_at("t", 1).alias("first_token"), F.element_at("t", -1).alias("last_token"))


@register("clean_text")
def q_clean_text(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", tx.clean_text("html").alias("clean_html"))


# ---------------------------------------------------------------- D: exploration


@register("top_authors")
def q_top_authors(spark, sf):
    # every eleventh publication has no author
    pubs = publications(spark, sf).withColumn("professor", F.when(F.col("pub_id") % 11 != 0, F.col("professor")))
    return explore.top_authors(pubs, "professor", 30)


@register("pubs_per_year")
def q_pubs_per_year(spark, sf):
    # years as a float column writes them: '1996.0'
    d = dated(spark, sf).withColumn("pub_year", F.concat(F.col("pub_year").cast("string"), F.when(F.col("pub_id") % 2 == 0, F.lit(".0")).otherwise(F.lit(""))))
    return explore.pubs_per_year(d, "pub_year")


@register("common_words")
def q_common_words(spark, sf):
    return explore.common_words(publications(spark, sf), "abstract", 40)


@register("words_by_year")
def q_words_by_year(spark, sf):
    return explore.words_by_year(publications(spark, sf), "pub_year", "abstract")


@register("top_words_in_year")
def q_top_words_in_year(spark, sf):
    freq = explore.words_by_year(publications(spark, sf), "pub_year", "abstract")
    return explore.top_words_in_year(freq, TARGET_YEAR, 10)


@register("top_words_per_year")
def q_top_words_per_year(spark, sf):
    freq = explore.words_by_year(publications(spark, sf), "pub_year", "abstract")
    return explore.top_words_per_year(freq, 10)


@register("describe")
def q_describe(spark, sf):
    # one price in seven is NaN, which counts as missing
    o = table(spark, sf, "orders").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")))
    d = explore.describe(o, ["o_orderkey", "o_custkey", "o_totalprice"])
    return d.select("column", "count", *[F.round(c, DIGITS).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


@register("profile_columns")
def q_profile_columns(spark, sf):
    return explore.profile_columns(docs_with_labels(spark, sf))


@register("null_counts")
def q_null_counts(spark, sf):
    return explore.null_counts(docs_with_labels(spark, sf))


@register("duplicate_rows")
def q_duplicate_rows(spark, sf):
    return explore.duplicate_rows(table(spark, sf, "documents"), ["source", "text"])


# ---------------------------------------------------------------- vectors and quality

from ..operators import invlists, quality, retrieve  # noqa: E402
from ..operators import similarity as sim  # noqa: E402

QUERY_VEC_ID = 0
PAIR_THRESHOLD = 0.4
KNN_K = 10
QUESTION_STEP = 20          # every row whose id it divides is a question
SPLIT_K = 6


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


@register("cluster_ids")
def q_cluster_ids(spark, sf):
    return quality.cluster_ids(_emb(spark, sf), "label")


@register("cluster_sizes")
def q_cluster_sizes(spark, sf):
    return quality.cluster_sizes(_emb(spark, sf), "label", SPLIT_K)


@register("cluster_centroids")
def q_cluster_centroids(spark, sf):
    c = quality.centroids(_emb(spark, sf), "label", "embedding")
    return c.select("label", "dim", F.round("mean", DIGITS).alias("mean"))


@register("unit_vectors")
def q_unit_vectors(spark, sf):
    u = sim.unit_vectors(_emb(spark, sf), "vec_id", "embedding")
    return u.select("vec_id", F.transform("unit", lambda x: F.round(x, DIGITS)).alias("unit"))


@register("cosine_topk")
def q_cosine_topk(spark, sf):
    e = _emb(spark, sf)
    q = sim.vector_of(e, "vec_id", "embedding", QUERY_VEC_ID)
    return sim.cosine_topk(e.select("vec_id", "embedding"), "vec_id", "embedding", q, 10).select("vec_id", "similarity")


@register("pairwise_similarity")
def q_pairwise_similarity(spark, sf):
    return sim.pairwise_similarity(_emb(spark, sf), "vec_id", "embedding", PAIR_THRESHOLD)


@register("knn_graph")
def q_knn_graph(spark, sf):
    return sim.knn_graph(_emb(spark, sf), "vec_id", "embedding", KNN_K)


@register("assign_nearest")
def q_assign_nearest(spark, sf):
    e = _emb(spark, sf)
    labels, centers = quality.collect_centroids(quality.centroids(e, "label", "embedding"), "label")
    out = quality.assign_nearest(e, "vec_id", "embedding", labels, centers)
    return out.select("vec_id", "nearest", F.round("distance", DIGITS).alias("distance"))


@register("silhouette")
def q_silhouette(spark, sf):
    s = quality.silhouette(_emb(spark, sf), "vec_id", "embedding", "label")
    return s.select(F.round("silhouette", DIGITS).alias("silhouette"))


@register("silhouette_sq")
def q_silhouette_sq(spark, sf):
    s = quality.silhouette_sq(_emb(spark, sf), "vec_id", "embedding", "label")
    return s.select(F.round("silhouette_sq", DIGITS).alias("silhouette_sq"))


@register("calinski_harabasz")
def q_calinski_harabasz(spark, sf):
    s = quality.calinski_harabasz(_emb(spark, sf), "label", "embedding")
    return s.select(F.round("calinski_harabasz", DIGITS).alias("calinski_harabasz"))


@register("retrieve_coarse")
def q_retrieve_coarse(spark, sf):
    # all vectors are ranked; only the candidates meet the documents
    e = _emb(spark, sf)
    q = sim.vector_of(e, "vec_id", "embedding", QUERY_VEC_ID)
    out = retrieve.coarse(e.select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id", "embedding", q)
    return out.join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", "left").select("doc_id", "source", "coarse_similarity")


# ---------------------------------------------------------------- keywords and tree

from ..operators import keywords as kwd  # noqa: E402
from ..operators import tree  # noqa: E402

LEVELS = ["level_1", "level_2", "level_3"]


def leveled_docs(spark, sf):
    """All documents with a path (stand-ins for cluster labels): level_1 = the
    given vector label, or 10 and 11 for documents without a vector, level_2 =
    doc_id % 3, level_3 = doc_id % 2 but for every fifth, which ends at level 2.
    Every eleventh has no professor."""
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 11 != 0, F.col("source")).alias("source"), "text")
    e = _emb(spark, sf).select(F.col("vec_id").alias("doc_id"), "label")
    return d.join(e, "doc_id", "left").select(
        "doc_id",
        "source",
        "text",
        F.coalesce("label", 10 + F.pmod("doc_id", F.lit(2))).cast("int").alias("level_1"),
        F.pmod("doc_id", F.lit(3)).cast("int").alias("level_2"),
        F.when(F.col("doc_id") % 5 != 0, F.pmod("doc_id", F.lit(2))).cast("int").alias("level_3"),
    )


@register("group_keywords")
def q_group_keywords(spark, sf):
    return kwd.group_keywords(leveled_docs(spark, sf), "doc_id", "text", "level_1", 5)


@register("level_keywords")
def q_level_keywords(spark, sf):
    out = kwd.level_keywords(leveled_docs(spark, sf), "doc_id", "text", LEVELS, 10)
    return out.select("doc_id", *LEVELS, *[f"{c}_keywords" for c in LEVELS])


@register("level1_report")
def q_level1_report(spark, sf):
    return kwd.level1_report(leveled_docs(spark, sf), "doc_id", "text", "level_1", 10)


@register("tree_nodes")
def q_tree_nodes(spark, sf):
    return tree.tree_nodes(leveled_docs(spark, sf), "doc_id", "text", "source", LEVELS)


@register("node_text")
def q_node_text(spark, sf):
    nodes = tree.tree_nodes(leveled_docs(spark, sf), "doc_id", "text", "source", LEVELS)
    return tree.describe_node(nodes).select("node_id", "description")


@register("tree_edges")
def q_tree_edges(spark, sf):
    return tree.tree_edges(leveled_docs(spark, sf), "doc_id", LEVELS)


# ---------------------------------------------------------------- embeddings and text retrieval

from ..operators import embed  # noqa: E402

QUESTION_ID = 0


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _context(spark, sf):
    d = _docs(spark, sf)
    return d, embed.context_stats(embed.sample_corpus(d, "doc_id"), "doc_id", "text")


def _round_vec(c: str):
    return F.transform(c, lambda x: F.round(x, DIGITS)).alias(c)


@register("hashed_embedding")
def q_hashed_embedding(spark, sf):
    h = embed.hashed_embedding(_docs(spark, sf), "doc_id", "text")
    return h.select(F.col("id").alias("doc_id"), "bucket", F.round("w", DIGITS).alias("w"))


@register("sample_corpus")
def q_sample_corpus(spark, sf):
    return embed.sample_corpus(_docs(spark, sf), "doc_id").select("doc_id")


@register("context_stats")
def q_context_stats(spark, sf):
    _, ctx = _context(spark, sf)
    return embed.context_frame(spark, ctx).select("bucket", F.round("mean", DIGITS).alias("mean"))


@register("context_embedding")
def q_context_embedding(spark, sf):
    d, ctx = _context(spark, sf)
    return embed.context_embedding(d, "doc_id", "text", ctx).select("doc_id", _round_vec("vec"))


@register("keyphrases")
def q_keyphrases(spark, sf):
    return embed.keyphrases(_docs(spark, sf), "doc_id", "text")


def stored_index(spark, sf):
    """The stored index and context of ``documents``: a folder named after the
    table's version below the shared folder, so any session finds it. Building
    (``embed.save_index``) is a step of its own; a question only loads."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-index-{fsrc.table_version(spark, os.path.join(sf, 'documents.parquet'))}"
    if not fsrc.path_exists(spark, f"{path}/index/_SUCCESS"):
        embed.save_index(_docs(spark, sf), "doc_id", "text", ["source"], path)
    return embed.load_index(spark, path)


@register("index_table")
def q_index_table(spark, sf):
    d, ctx = _context(spark, sf)
    idx = embed.index_table(d, "doc_id", "text", ["source"], ctx)
    return idx.select("doc_id", "source", "keywords", _round_vec("doc_vec"), _round_vec("kw_vec"))


def _question(spark, sf, ctx):
    """One question (benchmark item 0) through both encoders."""
    q = table(spark, sf, "benchmark").filter(F.col("item_id") == QUESTION_ID)
    row = embed.question_vectors(q, "item_id", "text", ctx).first()
    return (row["coarse"], row["fine"]) if row else ([0.0] * ctx.dim,) * 2


@register("retrieve_fine")
def q_retrieve_fine(spark, sf):
    idx, ctx = stored_index(spark, sf)
    _, q_fine = _question(spark, sf, ctx)
    out = retrieve.fine(idx.select("doc_id", "source", "doc_vec"), "doc_id", "doc_vec", q_fine)
    return out.select("doc_id", "source", "similarity")


@register("retrieve_two_stage")
def q_retrieve_two_stage(spark, sf):
    idx, ctx = stored_index(spark, sf)
    q_coarse, q_fine = _question(spark, sf, ctx)
    out = retrieve.two_stage(idx.select("doc_id", "source", "kw_vec", "doc_vec"), "doc_id", "kw_vec", "doc_vec", q_coarse, q_fine)
    return out.select("doc_id", "source", "coarse_similarity", "similarity")


@register("retrieve_batch")
def q_retrieve_batch(spark, sf):
    # every benchmark item is a question
    idx, ctx = stored_index(spark, sf)
    q = embed.question_vectors(table(spark, sf, "benchmark"), "item_id", "text", ctx)
    out = retrieve.batch_two_stage(idx, "doc_id", "kw_vec", "doc_vec", q, "qid", "coarse", "fine")
    return out.select(F.col("qid").alias("item_id"), "doc_id", "coarse_similarity", "similarity")


def stored_lists(spark, sf):
    """The inverted lists of ``embeddings``, built once per version of the table."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-lists-{fsrc.table_version(spark, os.path.join(sf, 'embeddings.parquet'))}"
    if not fsrc.path_exists(spark, f"{path}/lists/_SUCCESS"):
        invlists.build(_emb(spark, sf), "vec_id", "embedding", path)
    return path


@register("retrieve_pruned")
def q_retrieve_pruned(spark, sf):
    # the stated query set: every row whose id is divisible by 20, against all rows
    q = _emb(spark, sf).filter(F.col("vec_id") % QUESTION_STEP == 0)
    out, _ = invlists.search(spark, stored_lists(spark, sf), q, "vec_id", "embedding", KNN_K)
    return out.select(F.col("qid").alias("vec_id"), F.col("id").alias("neighbour"), "similarity")


from ..operators import anglepairs, nndescent  # noqa: E402


@register("pairs_pruned")
def q_pairs_pruned(spark, sf):
    return anglepairs.threshold_pairs(_emb(spark, sf), "vec_id", "embedding", PAIR_THRESHOLD)[0]


@register("pair_links")
def q_pair_links(spark, sf):
    pairs, members, _ = anglepairs.threshold_pairs(_emb(spark, sf), "vec_id", "embedding", PAIR_THRESHOLD)
    return anglepairs.links(pairs, members).withColumnRenamed("id", "vec_id")


@register("knn_descent")
def q_knn_descent(spark, sf):
    out = nndescent.knn(_emb(spark, sf), "vec_id", "embedding", KNN_K)
    return out.select("src", "dst", F.round("distance", DIGITS).alias("distance"), "rank")


@register("knn_descent_recall")
def q_knn_descent_recall(spark, sf):
    # asked exactly: every row whose id is divisible by 20, against all rows
    e = _emb(spark, sf)
    found = nndescent.knn(e, "vec_id", "embedding", KNN_K)
    seen = nndescent.recall(e, "vec_id", "embedding", found, F.col("id") % QUESTION_STEP == 0, KNN_K)
    return seen.select("asked", "wanted", (F.col("hits") >= 0.9 * F.col("wanted")).alias("enough"))


# ---------------------------------------------------------------- clustering (rows-checked)

from ..operators import agglomerate, cluster, groupfit, spectral, sweep  # noqa: E402

FLAT_K = 30
LEVEL_KS = (12, 6, 3)
SWEEP = range(2, 31)


@register("group_axes")
def q_group_axes(spark, sf):
    fitted = groupfit.fit_groups(_emb(spark, sf), ["label"], "vec_id", "embedding", groupfit.PrincipalAxis())
    dim = F.floor((F.size("params") - 2) / 2).cast("int")
    means = fitted.select("label", F.col("params")[0].cast("long").alias("n"), F.posexplode(F.slice("params", F.lit(3), dim)).alias("dim", "mean"))
    return means.select("label", "n", F.col("dim").cast("long").alias("dim"), F.round("mean", DIGITS).alias("mean"))


@register("group_kmeans")
def q_group_kmeans(spark, sf):
    e, model = _emb(spark, sf), groupfit.KMeans(LEVEL_KS[1])
    fitted = groupfit.fit_groups(e, ["label"], "vec_id", "embedding", model)
    out = groupfit.apply_groups(e, ["label"], "vec_id", "embedding", fitted, model)
    return out.select(F.col("id").alias("vec_id"), F.col("value").cast("int").alias("child"))


@register("pca_2d")
def q_pca_2d(spark, sf):
    return cluster.pca_2d(_emb(spark, sf), "vec_id", "embedding")


@register("kmeans")
def q_kmeans(spark, sf):
    return cluster.kmeans(_emb(spark, sf), "vec_id", "embedding", FLAT_K)


@register("bisecting")
def q_bisecting(spark, sf):
    return cluster.bisecting(_emb(spark, sf), "vec_id", "embedding", FLAT_K)


@register("three_level")
def q_three_level(spark, sf):
    return cluster.three_level(_emb(spark, sf), "vec_id", "embedding", LEVEL_KS)


@register("k_sweep")
def q_k_sweep(spark, sf):
    return sweep.k_sweep(_emb(spark, sf), "vec_id", "embedding", SWEEP)


_TREES: dict[str, agglomerate.Tree] = {}


def merge_tree(spark, sf):
    """The merge tree of ``embeddings``, built once per session and table version."""
    key = spark.sparkContext.applicationId + fsrc.table_version(spark, os.path.join(sf, "embeddings.parquet"))
    if key not in _TREES:
        _TREES[key] = agglomerate.ward(_emb(spark, sf), "vec_id", "embedding")
    return _TREES[key]


@register("merge_table")
def q_merge_table(spark, sf):
    return merge_tree(spark, sf).merges


@register("merge_summary")
def q_merge_summary(spark, sf):
    # what SQL can say of the merge table: one root over all rows, distances in order, the nearest pair first
    m = merge_tree(spark, sf).merges
    step = m.join(m.select((F.col("step") + 1).alias("step"), F.col("distance").alias("before")), "step", "left")
    return step.agg(
        F.count("*").alias("merges"),
        F.max("size").alias("root_size"),
        F.min(F.col("distance") >= F.coalesce("before", F.lit(0.0))).alias("monotone"),
        F.round(F.min("distance"), DIGITS).alias("first_distance"),
    )


@register("dendrogram_top")
def q_dendrogram_top(spark, sf):
    return agglomerate.top_levels(merge_tree(spark, sf))


@register("agglomerative")
def q_agglomerative(spark, sf):
    return agglomerate.flat(merge_tree(spark, sf), FLAT_K).withColumnRenamed("id", "vec_id")


@register("sweep_scores")
def q_sweep_scores(spark, sf):
    # labels and scores of every k for given centers: the k rows of smallest ids
    rows = _emb(spark, sf).filter("embedding IS NOT NULL").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    first = [r["vec"] for r in rows.orderBy("id").limit(max(SWEEP)).collect()]
    centers = {k: np.array(first[:k], np.float64) for k in SWEEP if k <= len(first)}
    out = sweep.scores(sweep.labels(rows, centers), list(centers))
    return out.select("k", F.round("silhouette_sq", DIGITS).alias("silhouette_sq"), F.round("calinski_harabasz", DIGITS).alias("calinski_harabasz"))


@register("three_level_spectral")
def q_three_level_spectral(spark, sf):
    return spectral.three_level_spectral(_emb(spark, sf), "vec_id", "embedding", LEVEL_KS)


@register("spectral_sweep")
def q_spectral_sweep(spark, sf):
    return spectral.spectral_sweep(_emb(spark, sf), "vec_id", "embedding", SWEEP)[1]


@register("clustered_rows")
def q_clustered_rows(spark, sf):
    return cluster.clustered_rows(_emb(spark, sf).select("vec_id", "embedding", "label"), "vec_id", "embedding", FLAT_K).drop("embedding")


# ---------------------------------------------------------------- ingest

from ..sources import files as fsrc, splitcsv  # noqa: E402
from ..sources import records as rec  # noqa: E402

def raw_records(spark, sf):
    """Raw records, one per document: (doc_id, value JSON); the whole text is the title."""
    d = table(spark, sf, "documents")
    bib = F.struct(F.col("text").alias("title"), (FIRST_YEAR + F.pmod(F.col("doc_id"), F.lit(YEAR_SPAN))).cast("string").alias("pub_year"), F.col("lang").alias("author"))
    pub = F.struct(bib.alias("bib"), F.col("n_chars").alias("num_citations"))
    return d.select("doc_id", F.to_json(F.struct(F.col("source").alias("name"), F.array(pub).alias("publications"))).alias("value"))


def faulty_title():
    """The title of a document's faulty record: its whole text, told from the whole record's."""
    return F.concat("source", F.lit(": "), "text")


def faulty_records(spark, sf):
    """The same documents as a crawl with faults leaves them: (doc_id, value JSON).
    Every seventh has no title, every fifth no year, every fourth no citations, every
    third failed to load; a ninth of them are cut off and don't parse."""
    d = table(spark, sf, "documents")
    pub = F.struct(
        F.struct(
            F.when(F.col("doc_id") % 7 != 0, faulty_title()).alias("title"),
            F.when(F.col("doc_id") % 5 != 0, (FIRST_YEAR + F.pmod(F.col("doc_id"), F.lit(YEAR_SPAN))).cast("string")).alias("pub_year"),
            F.col("lang").alias("author"),
        ).alias("bib"),
        F.when(F.col("doc_id") % 4 != 0, F.col("n_chars")).alias("num_citations"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("timeout")).alias("error"),
    )
    one = F.to_json(F.struct(F.col("source").alias("name"), F.array(pub).alias("publications")))
    return d.select("doc_id", one.alias("one")).select("doc_id", F.expr("if(doc_id % 9 <> 0, one, substring(one, 1, length(one) - 3))").alias("value"))


def landed_records(spark, sf):
    """Every document twice: whole, and with the faults of a crawl."""
    return raw_records(spark, sf).unionByName(faulty_records(spark, sf))


@register("flatten_records")
def q_flatten_records(spark, sf):
    return rec.flatten_records(landed_records(spark, sf), "value")


@register("build_snapshot")
def q_build_snapshot(spark, sf):
    # one lookup response per document and title; of the faulty ones' every fourth has a number for an abstract
    d = table(spark, sf, "documents")
    number = F.when(F.col("doc_id") % 4 == 0, F.to_json(F.struct(F.col("n_chars").alias("abstract"))))
    whole = F.to_json(F.struct(F.col("text").alias("abstract")))
    lookups = [
        d.select(title.alias("title"), F.concat(F.lit('{"data":['), candidate, F.lit("]}")).alias("response"), F.col("doc_id").alias("seq"))
        for title, candidate in ((F.col("text"), whole), (faulty_title(), F.coalesce(number, whole)))
    ]
    return rec.build_snapshot(landed_records(spark, sf), "value", lookups[0].unionByName(lookups[1]))


def _landing(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


@register("stream_ingest")
def q_stream_ingest(spark, sf):
    # the raw records arrive as files; the stream appends each (professor, title) once
    from ..streaming import ingest

    landed = _landing(spark, "landing")
    raw_records(spark, sf).select("value").write.text(f"{landed}/files")
    ingest.start(spark, f"{landed}/files", f"{landed}/table", f"{landed}/progress").awaitTermination()
    return spark.read.parquet(f"{landed}/table").select("professor", "title")


@register("csv_round_trip")
def q_csv_round_trip(spark, sf):
    # whole texts, and beside them the column of which every seventh is written as a missing marker
    path = _landing(spark, "csv")
    marked = F.when(F.col("doc_id") % 7 == 0, F.lit("N/A")).otherwise(F.col("text")).alias("marked")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", marked)
    fsrc.write_csv(d, path)
    back = fsrc.read_csv(spark, path, d.schema)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "marked")


@register("csv_split_round_trip")
def q_csv_split_round_trip(spark, sf):
    path = _landing(spark, "csv")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    fsrc.write_csv(d, path)
    back = splitcsv.read_csv(spark, path, d.schema)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


@register("first_match")
def q_first_match(spark, sf):
    # the landed lookup candidates are the documents themselves (copies share titles); rank = doc_id
    d = table(spark, sf, "documents").select("doc_id", "text")
    out = rec.first_match(d, "text", d.select(F.col("text").alias("t"), F.col("text").alias("a"), F.col("doc_id").alias("r")), "t", "a", "r")
    return out.select("doc_id", "abstract")


@register("merge_abstracts")
def q_merge_abstracts(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("title"), "text")
    lookup = d.select(F.col("title").alias("t"), tx.clean_text("text").alias("a"), F.col("doc_id").alias("seq"))
    out = rec.merge_abstracts(d.select("doc_id", "title"), "title", lookup, "t", "a", "seq")
    return out.select("doc_id", "abstract")


@register("pending_keys")
def q_pending_keys(spark, sf):
    # documents not processed yet = no row in labels
    keys = table(spark, sf, "documents").select("doc_id", "source")
    done = table(spark, sf, "labels").select("doc_id")
    return fsrc.pending(keys, done, "doc_id")


# ---------------------------------------------------------------- word cloud

from ..operators import wordcloud  # noqa: E402


@register("wordcloud_weights")
def q_wordcloud_weights(spark, sf):
    w = wordcloud.wordcloud_weights(publications(spark, sf), "abstract")
    return w.select("word", "count", F.round("weight", DIGITS).alias("weight"))


@register("sort_recent")
def q_sort_recent(spark, sf):
    # professor asc, year desc
    return clean.sort_recent(dated(spark, sf).select("pub_id", "professor", "pub_year"), "professor", "pub_year")
