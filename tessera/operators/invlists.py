"""Retrieval over a pruned index (I7-I9 for many questions): inverted lists with exact bounds.

``build`` stores the corpus partitioned by list: every row goes to the centre
with the smallest angle, and each list records the smallest and the largest
angle between its centre and its rows. Angles obey the triangle inequality, so
a row of a list is at least ``angle(question, centre) - largest`` and at least
``smallest - angle(question, centre)`` away from the question.

``search`` first reads, for each question, its nearest lists until they hold k
rows. The k-th similarity found there is a floor; the lists whose bound
reaches that floor are read in a second pass, all others are proven to
hold none of the k best. The result is that of a scan of all rows. List numbers
reach the scan as partition filters, so folders of other lists aren't opened.

Centres are fitted with k-means on a sample of about ``SAMPLE_PER_LIST`` rows a
list, drawn by a hash of the id; they decide how much is skipped, never what is
found. Every row is indexed.

Defined cases: rows whose vector is NULL, zero or not finite have no angle; they
are stored in list -1 and never found. Questions of that kind find nothing;
of repeated question ids the smallest vector is asked, a NULL id is not. Rows similarities are ranked by id; repeated rows count as rows of their own. An empty
corpus, or no question, gives an empty result. Vectors have one length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import vectors as V
from ..session import cut_lineage
from . import cluster
from . import similarity as S

# Fixed parameters.
CENTRE_BYTES = 32 << 20           # centres held by the driver and every task
BOUND_BYTES = 64 << 20            # angles between a slice of questions and all centres
SAMPLE_PER_LIST = 40              # rows the centres are fitted on, for each list
ROWS_PER_PART = 500_000           # rows of a list that go to one file; larger lists have more files
ANGLE_SLACK = 1e-7                # arccos near 1 is exact to about 1e-8


def n_lists(n_rows: int, dim: int) -> int:
    """The square root of the rows, as far as the centres' bytes allow."""
    return max(1, min(math.ceil(math.sqrt(max(n_rows, 1))), CENTRE_BYTES // (8 * max(dim, 1))))


def _angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1.0, 1.0))


def _searchable(vec_col: str):
    """Whether a vector has a direction."""
    norm = V.norm(vec_col)
    return F.coalesce((norm > 0) & (norm < float("inf")), F.lit(False))  # Spark orders NaN above infinity


def build(corpus: DataFrame, id_col: str, vec_col: str, path: str, lists: int | None = None, rows_per_part: int = ROWS_PER_PART) -> None:
    """Store (id, vec) below ``path/rows``, partitioned by list, and the lists
    (list, centre, n, lo, hi) below ``path/lists``, which is written last."""
    spark = corpus.sparkSession
    rows = corpus.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), _searchable(vec_col).alias("ok"))
    n = rows.filter("ok").count()
    dim = S.dimension(rows.filter("ok"), "vec")
    lists = lists or n_lists(n, dim)
    centres = _fit(rows.filter("ok").select("id", "vec"), n, lists) if n else np.zeros((0, 1))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        for b in batches:
            ok = b.column(2).to_numpy(zero_copy_only=False)
            number, angle = np.full(len(ok), -1, np.int32), np.zeros(len(ok))
            at = np.nonzero(ok)[0]
            units = S.unit_rows(S.matrix(b.column(1).filter(b.column(2))))[0]
            for lo in range(0, len(at), S.TILE_ROWS):
                d = _angles(units[lo : lo + S.TILE_ROWS], shared.value)
                near = d.argmin(axis=1)
                number[at[lo : lo + S.TILE_ROWS]] = near
                angle[at[lo : lo + S.TILE_ROWS]] = d[np.arange(len(near)), near]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(number), pa.array(angle)], names=["id", "vec", "list", "angle"])

    schema = T.StructType([rows.schema["id"], rows.schema["vec"], T.StructField("list", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    placed = cut_lineage(rows.mapInArrow(assign, schema))
    stats = cut_lineage(placed.groupBy("list").agg(F.count("*").alias("n"), F.min("angle").alias("lo"), F.max("angle").alias("hi")))
    # one row per list, so its size is that of the centres at most; a list of copies is dealt over several files
    parts = F.broadcast(stats.select("list", F.ceil(F.col("n") / rows_per_part).alias("parts")))
    dealt = placed.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("id", "vec"), F.col("parts")))
    files = dealt.repartition("list", "part").select("id", "vec", "list").write.mode("overwrite").option("maxRecordsPerFile", rows_per_part)
    files.partitionBy("list").parquet(f"{path}/rows")
    named = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "list int, centre array<double>")
    named.join(F.broadcast(stats), "list").write.mode("overwrite").parquet(f"{path}/lists")


def _fit(rows: DataFrame, n: int, lists: int) -> np.ndarray:
    """Unit centres by k-means on unit vectors of a sample drawn by a hash of the id."""
    share = min(1.0, lists * SAMPLE_PER_LIST / n)
    drawn = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else rows
    sample = cut_lineage(drawn.select("id", V.normalize("vec").alias("vec")))
    if sample.isEmpty():  # all rows share an id outside the sample
        sample = cut_lineage(rows.select("id", V.normalize("vec").alias("vec")).limit(lists))
    centres, ok = S.unit_rows(cluster.kmeans_model(sample, "id", "vec", lists)[1]) if lists > 1 else S.unit_rows(np.array([S.mean_vector(sample, "vec")]))
    return centres[ok] if ok.any() else np.eye(1, centres.shape[1])


def search(spark: SparkSession, path: str, questions: DataFrame, qid_col: str, qvec_col: str, k: int, digits: int = 6, query_bytes: int = S.QUERY_BYTES) -> tuple[DataFrame, DataFrame]:
    """The k rows with the largest cosine per question, exactly, and what was read.

    Returns (qid, id, similarity) and (qid, lists_read, rows_read). Questions
    are broadcast in slices of bounded bytes; a slice is two scans, each of the
    lists that some question of it needs. A task scores a row only against the
    questions routed to its list, and holds their running top k."""
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").collect()  # at most CENTRE_BYTES of centres
    found = spark.createDataFrame([], "qid long, id long, similarity double")
    report = spark.createDataFrame([], "qid long, lists_read long, rows_read long")
    if not lists:
        return found, report
    rows = spark.read.parquet(f"{path}/rows")
    asked = questions.filter(F.col(qid_col).isNotNull() & _searchable(qvec_col)).groupBy(F.col(qid_col).alias("qid")).agg(F.min(qvec_col).alias("vec"))
    number = np.array([r["list"] for r in lists])
    centres = np.array([r["centre"] for r in lists])
    size, low, high = (np.array([r[c] for r in lists]) for c in ("n", "lo", "hi"))
    limit = max(1, min(query_bytes, BOUND_BYTES // len(lists) * centres.shape[1]))
    for qids, units in S._slices(asked, "qid", "vec", limit):
        angle = _angles(units, centres)
        order = np.argsort(angle, axis=1, kind="stable")
        before = np.cumsum(size[order], axis=1) - size[order]
        first = np.zeros(angle.shape, bool)
        np.put_along_axis(first, order, before < k, axis=1)
        near = cut_lineage(_scan(rows, number, first, qids, units, np.full(len(qids), -np.inf), k, digits))
        kth = near.groupBy("qid").agg(F.count("*").alias("n"), F.min("similarity").alias("s")).filter(F.col("n") >= k).collect()
        floor = np.full(len(qids), -np.inf)
        at = {int(q): i for i, q in enumerate(qids)}
        for r in kth:
            floor[at[r["qid"]]] = r["s"]
        apart = np.maximum(0.0, np.maximum(angle - high, low - angle) - ANGLE_SLACK)
        second = (np.cos(apart) + 10.0**-digits >= floor[:, None]) & ~first
        parts = near
        if second.any():
            parts = near.unionByName(_scan(rows, number, second, qids, units, floor, k, digits))
        found = found.unionByName(parts)
        read = first | second
        report = report.unionByName(
            spark.createDataFrame([(int(q), int(c), int(s)) for q, c, s in zip(qids, read.sum(axis=1), read @ size)], report.schema)
        )
    return _best(found, k), report


def _best(df: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("similarity").desc(), F.col("id").asc())
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def _scan(rows: DataFrame, number, routed, qids, units, floor, k: int, digits: int) -> DataFrame:
    """Top k per question over the lists routed to it (``routed``: questions x lists)."""
    used = np.nonzero(routed.any(axis=0))[0]
    routes = {int(number[i]): np.nonzero(routed[:, i])[0] for i in used}
    shared = rows.sparkSession.sparkContext.broadcast((qids, units, routes, floor))

    def run(batches):
        qids, units, routes, start = shared.value
        least = start.copy()
        held = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        fresh, n_fresh = [held], 0

        def settle():
            q, s, i = S._keep_best(*(np.concatenate(x) for x in zip(*fresh)), k)
            begin = np.searchsorted(q, np.arange(len(qids)))
            full = np.bincount(q, minlength=len(qids)) >= k
            least[full] = np.maximum(start[full], s[begin[full] + k - 1])
            return q, s, i

        for b in batches:
            ids, of = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            m = S.unit_rows(S.matrix(b.column(1)))[0]
            for one in np.unique(of):
                mine, asked = np.nonzero(of == one)[0], routes[int(one)]
                for lo in range(0, len(mine), S.TILE_ROWS):
                    tile = mine[lo : lo + S.TILE_ROWS]
                    for c in range(0, len(asked), S.TILE_COLUMNS):
                        who = asked[c : c + S.TILE_COLUMNS]
                        sims = np.round(m[tile] @ units[who].T, digits) + 0.0  # no negative zero
                        r, q = np.nonzero(sims >= least[who])
                        fresh.append((who[q], sims[r, q], ids[tile][r]))
                        n_fresh += len(q)
                        if n_fresh > max(2 * k * len(qids), S.TILE_ROWS):
                            fresh, n_fresh = [settle()], 0
        q, s, i = settle()
        yield pa.RecordBatch.from_arrays([pa.array(qids[q]), pa.array(i.astype(np.int64)), pa.array(s)], names=["qid", "id", "similarity"])

    wanted = rows.filter(F.col("list").isin([int(number[i]) for i in used])).select("id", "vec", "list")
    return _best(wanted.mapInArrow(run, "qid long, id long, similarity double"), k)
