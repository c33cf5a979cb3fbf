"""The three-level cluster tree as two tables.

``nodes``: one row per cluster node of every level with its size, TF-IDF
keywords and five leading professors; ``edges``: parent -> child. All nodes
come from one explode of each row to its node paths, so the three levels
share the same group-bys (the reference's nested loops are GROUPING SETS
((l1), (l1, l2), (l1, l2, l3))). Drawing and layout are left to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx
from . import keywords as K

TOP_PROFESSORS = 5
NODE_KEYWORDS = 10


def node_id(path_col: str = "path") -> F.Column:
    """``Cluster a.b.c``."""
    return F.concat(F.lit("Cluster "), F.col(path_col))


def parent_path(path_col: str = "path") -> F.Column:
    return F.when(F.col(path_col).contains("."), F.regexp_replace(F.col(path_col), r"\.[^.]*$", ""))


def top_professors(paths: DataFrame, people: DataFrame, n: int = TOP_PROFESSORS) -> DataFrame:
    """(level, path, top_professors) -- value counts, top n (count desc, name asc); a NULL name is none."""
    counts = paths.join(people.filter(F.col("professor").isNotNull()), "id").groupBy("level", "path", "professor").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("level", "path").orderBy(F.col("n").desc(), F.col("professor").asc())
    ranked = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    agg = ranked.groupBy("level", "path").agg(F.sort_array(F.collect_list(F.struct("rank", "professor", "n"))).alias("p"))
    return agg.select(
        "level",
        "path",
        tx.join_list(F.transform("p", lambda x: F.concat(x["professor"].cast("string"), F.lit(" ("), x["n"].cast("string"), F.lit(")")))).alias(
            "top_professors"
        ),
    )


def tree_nodes(df: DataFrame, id_col: str, text_col: str, prof_col: str, level_cols: list[str], n_keywords: int = NODE_KEYWORDS) -> DataFrame:
    """I24 nodes: (node_id, parent_id, level, size, keywords, top_professors)."""
    paths = K.node_paths(df, id_col, level_cols)
    people = df.select(F.col(id_col).alias("id"), F.col(prof_col).alias("professor"))
    nodes = K.node_keywords(df, id_col, text_col, level_cols, n_keywords).join(top_professors(paths, people), ["level", "path"], "left")
    pp = parent_path()
    return nodes.select(
        node_id().alias("node_id"),
        F.when(pp.isNotNull(), F.concat(F.lit("Cluster "), pp)).alias("parent_id"),
        "level",
        "size",
        "keywords",
        "top_professors",
    )


def tree_edges(df: DataFrame, id_col: str, level_cols: list[str]) -> DataFrame:
    """I24 edges: (src, dst) parent -> child, distinct."""
    paths = K.node_paths(df, id_col, level_cols).filter(F.col("level") > 1).select("path").distinct()
    return paths.select(F.concat(F.lit("Cluster "), parent_path()).alias("src"), node_id().alias("dst"))


def describe_node(nodes: DataFrame) -> DataFrame:
    """The node's hover text."""
    return nodes.withColumn(
        "description",
        F.concat_ws("\n", F.col("node_id"), F.concat(F.lit("Keywords: "), F.coalesce("keywords", F.lit(""))), F.concat(F.lit("Professors: "), F.coalesce("top_professors", F.lit("")))),
    )
