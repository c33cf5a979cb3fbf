"""Ward clustering by reciprocal nearest neighbours on a kNN graph.

Every round each cluster finds its nearest linked cluster by Ward's distance, in
closed form from sizes and means: sqrt(2 a b / (a + b)) |mean_a - mean_b|. All
pairs that are each other's nearest merge at once, and their links become links
of the merged cluster. Ward's distance is reducible, so on a complete graph the
merges are exactly those of the one-by-one algorithm; on a kNN graph a cluster
only merges with linked ones. When no links are left, the remaining clusters get
a new graph over their means, so the tree always ends in one root.

A round is joins and sums over the tables of clusters and links; nothing is
gathered. A link keeps its distance until one of its ends merges, so a round
fetches the means of merged clusters and those linked to them only. Ties are ordered by (distance, smaller id, larger id), a total order
on links, so every round merges at least the least link. Equal vectors are one
leaf with their number as weight (Ward merges them first, at distance 0), so a
large group of copies is no hub that merges one row a round.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffled
from . import similarity as S

#: Clusters up to which a round's tables may be broadcast; above, both sides of its joins are shuffled.
BROADCAST_CLUSTERS = 4096


class Tree(NamedTuple):
    """``leaves``: id, leaf (0 .. n-1). ``merges``: step (0 .. n-2), left,
    right, distance, size; a node is a leaf's number or n + step, as in the usual
    linkage tables. ``n`` is the number of leaves."""

    leaves: DataFrame
    merges: DataFrame
    n: int


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with ranks 0 .. n-1 in ``order`` (unique). Range-partitioned and
    sorted; one count per partition reaches the driver."""
    spark = df.sparkSession
    split = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the low 33 bits count the rows of a partition
    placed = cut_lineage(split.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    begin, offsets = 0, []
    for part, count in sorted(placed.groupBy("__part").agg(F.count("*")).collect()):
        offsets.append((part, begin))
        begin += count
    offset = F.broadcast(spark.createDataFrame(offsets, "__part int, __begin long"))
    return placed.join(offset, "__part").select(*df.columns, (F.col("__begin") + F.col("__at")).alias(out))


def _graph(clusters: DataFrame, neighbours: int) -> DataFrame:
    """Links (a < b) of each cluster to its nearest means."""
    near = S.knn(clusters.select("c", "mean"), "c", "mean", neighbours, include_self=False)
    return cut_lineage(near.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct())


def _ends(clusters: DataFrame, columns: tuple[str, ...]) -> list[DataFrame]:
    """The clusters as the a and as the b of a link, with ``columns`` of either."""
    return [clusters.select(F.col("c").alias(x), *(F.col(v).alias(f"{v}_{x}") for v in columns)) for x in ("a", "b")]


def _measured(links: DataFrame, clusters: DataFrame, side) -> DataFrame:
    """Links (a, b) with Ward's distance d of their ends."""
    a, b = _ends(clusters, ("n", "mean"))
    gap = F.aggregate(F.zip_with("mean_a", "mean_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    far = F.sqrt(F.lit(2.0) * F.col("n_a") * F.col("n_b") / (F.col("n_a") + F.col("n_b")) * gap)
    return links.join(side(a), "a").join(side(b), "b").select("a", "b", far.alias("d"))


def ward(df: DataFrame, id_col: str, vec_col: str, neighbours: int = 10) -> Tree:
    """The merge tree of all rows with a vector."""
    rows = df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda v: v.cast("double") + F.lit(0.0)).alias("vec"))
    groups = cut_lineage(rows.groupBy("vec").agg(F.min("id").alias("c"), F.count("*").alias("n")))
    leaves = cut_lineage(numbered(groups.select("c"), ["c"], "leaf"))
    n = leaves.count()
    clusters = cut_lineage(groups.join(shuffled(leaves), "c").select("c", "n", F.col("vec").alias("mean"), F.lit(0.0).alias("height"), F.concat(F.lit("l"), F.col("leaf")).alias("node")))
    merged: list[DataFrame] = []
    left, turn, links = n, 0, None
    while left > 1:
        side = shuffled if left > BROADCAST_CLUSTERS else lambda d: d
        if links is None or links.isEmpty():
            links = cut_lineage(_measured(_graph(clusters, neighbours), clusters, side))
        a, b = _ends(clusters, ("n", "mean", "height", "node"))
        key = F.struct("d", "a", "b").alias("key")
        best = links.select(key, F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.min("key").alias("key"))
        mutual = best.groupBy("key").agg(F.count("*").alias("ends")).where("ends = 2").select("key.*")
        pairs = mutual.join(side(a), "a").join(side(b), "b")
        size = F.col("n_a") + F.col("n_b")
        turned = cut_lineage(
            pairs.select(
                "a", "b", size.alias("n"),
                F.zip_with("mean_a", "mean_b", lambda x, y: x + (y - x) * (F.col("n_b") / size)).alias("mean"),
                F.greatest("d", "height_a", "height_b").alias("height"),
                F.concat_ws("/", F.lit("m"), F.lit(turn), "a").alias("node"),
                F.col("node_a").alias("left"), F.col("node_b").alias("right"), F.lit(turn).alias("turn"),
            )
        )
        merged.append(turned.select("node", "left", "right", F.col("height").alias("distance"), F.col("n").alias("size"), "turn"))
        name = turned.select(F.explode(F.array("a", "b")).alias("old"), F.col("a").alias("new"))
        kept = clusters.join(side(name.select(F.col("old").alias("c"))), "c", "left_anti")
        clusters = cut_lineage(kept.unionByName(turned.select(F.col("a").alias("c"), "n", "mean", "height", "node")))
        # only links of a merged cluster have a new distance
        still, moved = links, links.drop("d")
        for x in ("a", "b"):
            renamed = side(name.select(F.col("old").alias(x), F.col("new").alias(f"new_{x}")))
            still, moved = still.join(renamed, x, "left_anti"), moved.join(renamed, x, "left")
        moved = moved.where("new_a IS NOT NULL OR new_b IS NOT NULL").select(F.coalesce("new_a", "a").alias("a"), F.coalesce("new_b", "b").alias("b"))
        moved = moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = cut_lineage(still.select("a", "b", "d").unionByName(_measured(moved, clusters, side)))
        left, turn = clusters.count(), turn + 1
    everything = rows.join(shuffled(groups.join(shuffled(leaves), "c").select("vec", "leaf")), "vec").select("id", "leaf")
    empty = df.sparkSession.createDataFrame([], "step long, left long, right long, distance double, size long")
    if not merged:
        return Tree(everything, empty, n)
    table = merged[0]
    for m in merged[1:]:
        table = table.unionByName(m)
    steps = cut_lineage(numbered(table, ["distance", "turn", "node"], "step"))
    number = steps.select("node", (F.lit(n) + F.col("step")).alias("number")).unionByName(leaves.select(F.concat(F.lit("l"), F.col("leaf")).alias("node"), F.col("leaf").alias("number")))
    for end in ("left", "right"):
        steps = steps.join(shuffled(number.select(F.col("node").alias(end), F.col("number").alias(f"{end}_number"))), end)
    merges = steps.select("step", F.least("left_number", "right_number").alias("left"), F.greatest("left_number", "right_number").alias("right"), "distance", "size")
    return Tree(everything, cut_lineage(merges), n)


def top_levels(tree: Tree, levels: int = 5) -> DataFrame:
    """The merges at most ``levels`` below the root, with their depth."""
    at = tree.merges.where(F.col("step") == tree.n - 2).withColumn("depth", F.lit(0))
    out = at
    for depth in range(1, levels):
        below = at.select(F.explode(F.array("left", "right")).alias("node")).select((F.col("node") - tree.n).alias("step"))
        at = cut_lineage(tree.merges.join(F.broadcast(below), "step", "left_semi").withColumn("depth", F.lit(depth)))  # 2**depth rows at most
        out = out.unionByName(at)
    return out


def flat(tree: Tree, k: int, out: str = "label") -> DataFrame:
    """(id, label) of the k clusters that the last k - 1 merges join
    (fewer where there are fewer leaves); labels by the clusters' first leaf."""
    cut = tree.merges.where(F.col("step") < max(tree.n - k, 0))
    number = F.col("step") + tree.n
    up = cut_lineage(cut.select(F.explode(F.array("left", "right")).alias("node"), number.alias("top")))
    while True:  # pointer jumping: the distance to the top halves every round
        next_ = up.select(F.col("node").alias("top"), F.col("top").alias("above"))
        jumped = cut_lineage(up.join(shuffled(next_), "top", "left").select("node", F.coalesce("above", "top").alias("top"), F.col("above").isNotNull().alias("moved")))
        up = jumped.select("node", "top")
        if jumped.where("moved").isEmpty():
            break
    rows = tree.leaves.join(shuffled(up.withColumnRenamed("node", "leaf")), "leaf", "left").select("id", "leaf", F.coalesce("top", "leaf").alias("top"))
    tops = numbered(rows.groupBy("top").agg(F.min("leaf").alias("first")), ["first"], out)  # k rows
    return rows.join(F.broadcast(tops.select("top", F.col(out).cast("int").alias(out))), "top").select("id", out)
