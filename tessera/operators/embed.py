"""Text -> vector operators (I1-I6, F5, H8, H17) with a pluggable encoder.

No model weights exist here, so the default encoder is a *hashed* bag of
words: each vectorizer token goes to bucket ``int(md5(token)[0:8], 16) % dim``
with sign ``+1`` if the 9th hex digit is < 8 else ``-1`` (md5, not an engine's own
hash, so DuckDB can reproduce it). Vectors are L2-normalized once, at build
time; a text without tokens has the zero vector.

A vector depends on its own row only, so encoding is row-local: tokens are an
array column, weighted, hashed and normalized inside an Arrow batch, with no
shuffle and no job at planning time.

The contextual variant (I2-I4) is conditioned on a reproducible sample of
the corpus: token idf over the sample, and the mean of the sample's
vectors, which is subtracted before the final normalization (a text without
tokens gets the normalized negative mean). The fitted context is bounded by the
sample; ``save_context`` / ``load_context`` store it beside the index.

A real encoder plugs in through ``encode_with`` (Arrow batches, model
loaded once per Python worker).

Role prefixes (H8) add the same tokens to every text, so for the hashed
encoders they are left out; they matter only to plugged models.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import text as tx
from ..functions.stopwords import KEYWORD_STOP_WORDS, stop_word_frame
from ..session import cut_lineage
from .skew import FREQUENT_ROWS, split_join, text_tasks

DIM = 256
SAMPLE_SIZE = 512
SAMPLE_SEED = "1"
KEYPHRASES = 5


def doc_tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tok, tf) over the whole text, counted where the texts are after a shuffle
    by id that gives every task a bounded number of their bytes."""
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).repartition(text_tasks(df, text_col), "id")
    t = texts.select("id", F.explode(tx.word_tokens("_text")).alias("tok"))
    return t.groupBy("id", "tok").agg(F.count(F.lit(1)).alias("tf"))


def sample_corpus(df: DataFrame, id_col: str, n: int = SAMPLE_SIZE, seed: str = SAMPLE_SEED) -> DataFrame:
    """exactly n rows (or all), reproducible, engine-independent: order by md5(seed:id)."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.withColumn("_k", key).orderBy("_k", id_col).limit(n).drop("_k")


@dataclass
class Context:
    idf: dict[str, float]  # idf of the sample's tokens
    idf_unseen: float      # idf of a token absent from the sample
    mean: list[float]      # mean of the sample's weighted vectors, length dim
    dim: int


def _hashed(tokens, dim: int, idf: dict[str, float] | None = None, unseen: float = 1.0):
    """Unit vectors (rows x dim) of an Arrow column of token lists."""
    import hashlib

    import numpy as np

    flat = tokens.flatten().dictionary_encode()
    names = flat.dictionary.to_pylist()
    digests = [hashlib.md5(t.encode()).hexdigest() for t in names]
    bucket = np.array([int(d[:8], 16) % dim for d in digests], dtype=np.int64)
    weight = np.array([(1.0 if int(d[8], 16) < 8 else -1.0) * (1.0 if idf is None else idf.get(t, unseen)) for t, d in zip(names, digests)])
    at = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(tokens)
    row = np.repeat(np.arange(n), np.diff(tokens.offsets.to_numpy()))
    v = np.bincount(row * dim + bucket[at], weight[at], n * dim).reshape(n, dim) if len(at) else np.zeros((n, dim))
    size = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / np.where(size > 0, size, 1)[:, None]


def _encode(df: DataFrame, tokens, out: str, dim: int, context: Context | None = None) -> DataFrame:
    """``df`` with the vector column ``out`` of a token-array expression."""
    fitted = context is not None
    shared = df.sparkSession.sparkContext.broadcast((context.idf, context.idf_unseen, context.mean)) if fitted else None  # bounded by the sample

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            if not fitted:
                v = _hashed(b.column(b.num_columns - 1), dim)
            else:
                idf, unseen, mean = shared.value
                v = _hashed(b.column(b.num_columns - 1), dim, idf, unseen) - np.array(mean)
                size = np.sqrt(np.einsum("ij,ij->i", v, v))
                v /= np.where(size > 0, size, 1)[:, None]
            vec = pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), dim).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], vec], names=[*b.schema.names[:-1], out])

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    return df.withColumn("_tokens", tokens).mapInArrow(run, schema)


def hashed_vectors(df: DataFrame, id_col: str, text_col: str, dim: int = DIM, out: str = "vec") -> DataFrame:
    """I1 default encoder: (id, vec), dense."""
    rows = df.select(id_col, F.col(text_col).alias("_text"))
    return _encode(rows, tx.word_tokens("_text"), out, dim).drop("_text")


def hashed_embedding(df: DataFrame, id_col: str, text_col: str, dim: int = DIM) -> DataFrame:
    """I1 in long form: (id, bucket, w) of the components that are not zero."""
    v = hashed_vectors(df, id_col, text_col, dim)
    return v.select(F.col(id_col).alias("id"), F.posexplode("vec").alias("bucket", "w")).filter(F.col("w") != 0)


def context_stats(sample: DataFrame, id_col: str, text_col: str, dim: int = DIM) -> Context:
    """Fit the context on the sample (idf per token, mean weighted vector)."""
    rows = sample.select(F.col(id_col).alias("id"), F.array_distinct(tx.word_tokens(text_col)).alias("terms"))
    s = rows.count()
    counts = rows.select(F.explode("terms").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df")).collect()  # bounded by the sample
    ctx = Context({r["tok"]: math.log((s + 1.0) / (r["df"] + 1.0)) + 1.0 for r in counts}, math.log(s + 1.0) + 1.0, [0.0] * dim, dim)
    texts = sample.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    weighted = _encode(texts, tx.word_tokens("_text"), "vec", dim, ctx).select(F.posexplode("vec").alias("bucket", "w"))
    sums = {r["bucket"]: r["m"] for r in weighted.groupBy("bucket").agg(F.sum("w").alias("m")).collect()}
    ctx.mean = [float(sums.get(b, 0.0)) / max(s, 1) for b in range(dim)]
    return ctx


def context_frame(spark: SparkSession, ctx: Context) -> DataFrame:
    """I2 as a table: (bucket, mean)."""
    return spark.createDataFrame(list(enumerate(ctx.mean)), "bucket int, mean double")


def save_context(spark: SparkSession, ctx: Context, path: str) -> None:
    """A4 for the fitted context: two small tables."""
    spark.createDataFrame(list(ctx.idf.items()), "tok string, idf double").write.mode("overwrite").parquet(f"{path}/idf")
    spark.createDataFrame([(ctx.idf_unseen, ctx.mean, ctx.dim)], "idf_unseen double, mean array<double>, dim int").write.mode("overwrite").parquet(f"{path}/context")


def load_context(spark: SparkSession, path: str) -> Context:
    """A2 for the fitted context."""
    row = spark.read.parquet(f"{path}/context").first()
    return Context({r["tok"]: r["idf"] for r in spark.read.parquet(f"{path}/idf").collect()}, row["idf_unseen"], list(row["mean"]), row["dim"])


def context_embedding(df: DataFrame, id_col: str, text_col: str, ctx: Context, out: str = "vec") -> DataFrame:
    """(id, vec) = normalize(idf-weighted hashed vector - context mean)."""
    rows = df.select(id_col, F.col(text_col).alias("_text"))
    return _encode(rows, tx.word_tokens("_text"), out, ctx.dim, ctx).drop("_text")


def keyphrases(df: DataFrame, id_col: str, text_col: str, n: int = KEYPHRASES, frequent_rows: int = FREQUENT_ROWS) -> DataFrame:
    """I5 (re-aimed): per document, the n terms with the highest tf-idf over the corpus
    (stop words removed; ties term asc), joined ', ' in rank order: (id, keywords);
    '' for a document without terms."""
    toks = doc_tokens(df, id_col, text_col)
    # read by the frequencies and by the scores: written once, so texts are tokenized once
    toks = cut_lineage(toks.join(F.broadcast(stop_word_frame(df.sparkSession, KEYWORD_STOP_WORDS, "tok")), "tok", "left_anti"))
    n_val = df.count()  # corpus size: one scalar
    dfreq = toks.groupBy("tok").agg(F.count(F.lit(1)).alias("rows"))
    dfreq = cut_lineage(dfreq.withColumn("idf", F.log((F.lit(n_val) + 1.0) / (F.col("rows") + 1.0)) + 1.0))
    # a token of every document meets its rows by broadcast, not as one key of a shuffle
    scored = split_join(toks, dfreq, ["tok"], "rows", frequent_rows).select("id", "tok", F.round(F.col("tf") * F.col("idf"), 6).alias("score"))
    w = Window.partitionBy("id").orderBy(F.col("score").desc(), F.col("tok").asc())
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    agg = top.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "tok"))).alias("k"))
    found = agg.select("id", tx.join_list(F.transform("k", lambda x: x["tok"])).alias("keywords"))
    ids = df.select(F.col(id_col).alias("id"))
    return ids.join(found, "id", "left").select(F.col("id").alias(id_col), F.coalesce("keywords", F.lit("")).alias("keywords"))


def encode_with(df: DataFrame, id_col: str, text_col: str, make_encoder: Callable[[], Callable], dim: int, prefix: str = "", batch_rows: int = 64) -> DataFrame:
    """I1/K1/K2 plug-in: run a per-batch encoder (e.g. a sentence model) over Arrow batches.

    ``make_encoder()`` is called once per task and returns a function from
    a list of texts to a rows x dim array; texts get ``prefix`` (H8), NULL -> ''.
    """
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("vec", T.ArrayType(T.FloatType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        enc = make_encoder()
        for b in batches:
            texts = [prefix + (t or "") for t in b.column(1).to_pylist()]
            vecs = [np.asarray(enc(texts[i : i + batch_rows]), dtype=np.float32).reshape(-1, dim) for i in range(0, len(texts), batch_rows)]
            flat = np.concatenate(vecs).ravel() if vecs else np.zeros(0, np.float32)
            arr = pa.FixedSizeListArray.from_arrays(pa.array(flat), dim).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0), arr], names=[id_col, "vec"])

    return df.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def index_table(df: DataFrame, id_col: str, text_col: str, keep: list[str], ctx: Context, dim: int = DIM) -> DataFrame:
    """(id, *keep, keywords, doc_vec, kw_vec) -- keyphrases, contextual document
    vectors and hashed keyphrase vectors, all unit length. Write it once with ``save_index``."""
    rows = df.select(id_col, *keep, F.col(text_col).alias("_text"))
    rows = _encode(rows, tx.word_tokens("_text"), "doc_vec", ctx.dim, ctx).drop("_text")
    both = rows.join(keyphrases(df, id_col, text_col), id_col)
    return _encode(both, tx.word_tokens("keywords"), "kw_vec", dim).select(id_col, *keep, "keywords", "doc_vec", "kw_vec")


def save_index(df: DataFrame, id_col: str, text_col: str, keep: list[str], path: str, n: int = SAMPLE_SIZE) -> None:
    """Fit the context on the corpus sample, build the index, and store both (A4)."""
    ctx = context_stats(sample_corpus(df, id_col, n), id_col, text_col)
    save_context(df.sparkSession, ctx, path)
    index_table(df, id_col, text_col, keep, ctx).write.mode("overwrite").parquet(f"{path}/index")


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, Context]:
    """The stored index and its context (A2)."""
    return spark.read.parquet(f"{path}/index"), load_context(spark, path)


def question_vectors(questions: DataFrame, qid_col: str, text_col: str, ctx: Context) -> DataFrame:
    """(qid, coarse, fine): questions through both encoders."""
    rows = questions.select(F.col(qid_col).cast("long").alias("qid"), F.col(text_col).alias("_text"))
    coarse = _encode(rows, tx.word_tokens("_text"), "coarse", ctx.dim)
    return _encode(coarse, tx.word_tokens("_text"), "fine", ctx.dim, ctx).drop("_text")
