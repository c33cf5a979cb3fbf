"""Two-stage expert retrieval.

Stage 1 (coarse) ranks the whole corpus against the question's coarse
vector and keeps the top ``k1`` (default 500); stage 2 (fine) ranks only
those candidates with the fine vectors and keeps the top ``k2`` (default 5).
Both stages are ``orderBy(...).limit(k)`` -> ``TakeOrderedAndProject``: each
task keeps its own top k, so no full sort and no shuffle of the corpus.
Vectors are normalized once when the index is built, so the query side only
needs a dot product; the cosine here still divides by the norms so raw
vectors work too. The two scores are kept apart: ``coarse_similarity`` and
``similarity``.

For many questions at once use ``batch_two_stage`` on a stored index: one scan
of it finds the coarse candidates of all questions, and a join on their ids
reads the fine vectors of just those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import similarity as S

COARSE_K = 500
FINE_K = 5
#: Candidates of all questions (three numbers each) up to which they are broadcast; above, the join is shuffled.
BROADCAST_CANDIDATES = 250_000


def coarse(corpus: DataFrame, id_col: str, vec_col: str, query_vec, k: int = COARSE_K) -> DataFrame:
    """Top-k by cosine on the coarse (keyword) vectors."""
    return S.cosine_topk(corpus, id_col, vec_col, query_vec, k, out="coarse_similarity")


def fine(candidates: DataFrame, id_col: str, vec_col: str, query_vec, k: int = FINE_K) -> DataFrame:
    """I8: top-k by cosine on the fine (contextual) vectors."""
    return S.cosine_topk(candidates, id_col, vec_col, query_vec, k, out="similarity")


def two_stage(
    corpus: DataFrame,
    id_col: str,
    coarse_col: str,
    fine_col: str,
    q_coarse,
    q_fine,
    k1: int = COARSE_K,
    k2: int = FINE_K,
) -> DataFrame:
    """I9 = I8(I7(corpus)); the second stage sees only the first stage's rows."""
    return fine(coarse(corpus, id_col, coarse_col, q_coarse, k1), id_col, fine_col, q_fine, k2)


def batch_two_stage(
    corpus: DataFrame,
    id_col: str,
    coarse_col: str,
    fine_col: str,
    questions: DataFrame,
    qid_col: str,
    q_coarse_col: str,
    q_fine_col: str,
    k1: int = COARSE_K,
    k2: int = FINE_K,
) -> DataFrame:
    """I9 for a batch of questions: (qid, id, coarse_similarity, similarity).

    Stage-2 candidates are restricted with an equi-join on (qid, id) (C7), so
    no question ever meets a row outside its own top k1.
    """
    from pyspark.sql.window import Window

    from ..functions import vectors as V

    c = S.batch_topk(corpus, id_col, coarse_col, questions, qid_col, q_coarse_col, k1, out="coarse_similarity")
    # the candidates go to the stored vectors, not all vectors to the candidates, as long as they are few
    few = questions.count() * k1 <= BROADCAST_CANDIDATES
    cand = (F.broadcast(c) if few else c).join(corpus.select(F.col(id_col).cast("long").alias(id_col), F.col(fine_col)), id_col)
    qf = questions.select(F.col(qid_col).cast("long").alias("qid"), F.col(q_fine_col).alias("_qf"))
    scored = cand.join(qf, "qid").select(
        "qid", id_col, "coarse_similarity", (F.round(V.cosine(fine_col, "_qf"), 6) + 0.0).alias("similarity")
    ).filter(F.col("similarity").isNotNull())
    w = Window.partitionBy("qid").orderBy(F.col("similarity").desc(), F.col(id_col).asc())
    return scored.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k2).drop("_r")
