"""B2: language identification and the English filter.

A character-trigram naive Bayes model:

* text -> lower -> runs of non-letters become one space -> padded with a
  space on both sides -> every trigram of the whole text (JVM expressions);
* trigrams are counted and scored inside the task that reads the document
  (NumPy over code points, a bounded piece of a batch at a time), so neither
  texts nor (doc, trigram) pairs are shuffled;
* fit: ``n(lang, g)`` by a partial + final aggregate; per language
  ``w(lang, g) = ln(n + 1)`` and ``base(lang) = -ln(total(lang) + V)``;
* score(doc, lang) = sum_g c(doc, g) * w(lang, g) + N(doc) * base(lang),
  i.e. ``sum_g c * ln((n + 1) / (total + V))`` with add-one smoothing;
* prediction = highest score rounded to 6 places, ties by language asc.

Texts with no letters have no trigram, hence no language, and are not
English. The fitted weights are broadcast while they have at most
``MAX_WEIGHTS`` rows; a larger model is joined on the trigram instead, with the
same result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NON_LETTER_RUN
from ..session import cut_lineage

# Smoothing vocabulary size and score rounding.
VOCAB = 5000
SCORE_DIGITS = 6
ALL_SPACE_GRAM = "   "
TOTAL_ROW = -1  # marker row carrying N(doc); trigram codes are never negative

# a trigram is encoded as one int64: three Unicode code points (< 2**21 each)
_SHIFT = 21
_SPACE_CODE = (32 << 42) | (32 << 21) | 32

MAX_WEIGHTS = 4_000_000

#: Bytes of text whose trigrams are held at a time (a longer text is a piece of its own).
PIECE_BYTES = 1 << 20


def _pieces(text, limit: int | None = None):
    """(first row, rows) of the pieces of an Arrow string column, each of whole
    texts and at most ``limit`` bytes: an Arrow batch counts rows, and the arrays
    of its trigrams take some hundred bytes a character."""
    import numpy as np
    import pyarrow.compute as pc

    end = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, before = 0, 0
    while at < len(end):
        to = max(at + 1, int(np.searchsorted(end, before + (limit or PIECE_BYTES), "right")))
        yield at, to - at
        at, before = to, end[to - 1]


def _batch_trigrams(text):
    """(row, trigram code) of every trigram of an Arrow string column but the all-space one."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    text = pc.fill_null(text, "")
    size = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b"".join(s.encode("utf-32-le") for s in text.to_pylist())
    cp = np.frombuffer(joined, dtype=np.uint32).astype(np.int64)
    if len(cp) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    tri = (cp[:-2] << 42) | (cp[1:-1] << 21) | cp[2:]
    ok = (row[2:] == row[:-2]) & (tri != _SPACE_CODE)
    return row[:-2][ok], tri[ok]


def _count_by_language(batches):
    """(lang, gram, c) summed over each batch."""
    import numpy as np
    import pyarrow as pa

    for b in (b.slice(*piece) for b in batches for piece in _pieces(b.column(1))):
        lang = b.column(0).dictionary_encode()
        row, tri = _batch_trigrams(b.column(1))
        code = lang.indices.to_numpy(zero_copy_only=False)[row]
        for k, name in enumerate(lang.dictionary.to_pylist()):
            g, c = np.unique(tri[code == k], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(g), pa.string()), pa.array(g), pa.array(c.astype(np.int64))], names=["lang", "gram", "c"])


def _count_by_row(batches):
    """(id, gram, c) of each document, and one marker row with its total."""
    import numpy as np
    import pyarrow as pa

    for b in (b.slice(*piece) for b in batches for piece in _pieces(b.column(1))):
        row, tri = _batch_trigrams(b.column(1))
        order = np.lexsort((tri, row))
        row, tri = row[order], tri[order]
        new = np.r_[True, (row[1:] != row[:-1]) | (tri[1:] != tri[:-1])] if len(row) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        have, total = np.unique(row, return_counts=True)
        rows = np.r_[row[at], have]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(rows)), pa.array(np.r_[tri[at], np.full(len(have), TOTAL_ROW)]), pa.array(np.r_[np.diff(np.r_[at, len(row)]), total].astype(np.int64))],
            names=["id", "gram", "c"],
        )


def decode_gram(code: int) -> str:
    """The three characters of a trigram code (for inspecting a model)."""
    return chr((code >> 42) & 0x1FFFFF) + chr((code >> 21) & 0x1FFFFF) + chr(code & 0x1FFFFF)


def _prepared(text_col: str):
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col(text_col)), NON_LETTER_RUN, " "), F.lit(" "))


@dataclass
class LanguageModel:
    weights: DataFrame          # (lang, gram, w)
    bases: dict[str, float]     # lang -> -ln(total + V)


def train(df: DataFrame, id_col: str, text_col: str, lang_col: str, vocab: int = VOCAB) -> LanguageModel:
    """Fit on rows with a known language; the counts are written once."""
    rows = df.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), _prepared(text_col).alias("s"))
    counts = cut_lineage(rows.mapInArrow(_count_by_language, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("n")))
    weights = counts.select("lang", "gram", F.log(F.col("n") + 1.0).alias("w"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()
    return LanguageModel(weights, {r["lang"]: -math.log(float(r["total"]) + float(vocab)) for r in totals})


def _best_of_scores(df: DataFrame, id_col: str, text_col: str, model: LanguageModel) -> DataFrame:
    """(id, lang_pred) through joins on the trigram, for a model too large to broadcast."""
    rows = df.select(F.col(id_col).alias("id"), _prepared(text_col).alias("s"))
    g = rows.mapInArrow(_count_by_row, T.StructType([rows.schema["id"], *T.StructType.fromDDL("gram long, c long").fields]))
    seen = g.filter(F.col("gram") != TOTAL_ROW).join(model.weights, "gram").select("id", "lang", (F.col("c") * F.col("w")).alias("part"))
    bases = F.array(*[F.struct(F.lit(k).alias("lang"), F.lit(model.bases[k]).alias("base")) for k in sorted(model.bases)])
    base = g.filter(F.col("gram") == TOTAL_ROW).select("id", "c", F.explode(bases).alias("b")).select("id", "b.lang", (F.col("c") * F.col("b.base")).alias("part"))
    score = seen.unionByName(base).groupBy("id", "lang").agg(F.round(F.sum("part"), SCORE_DIGITS).alias("score"))
    return score.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("k"), "lang"))["lang"].alias("lang_pred"))


def with_language(df: DataFrame, id_col: str, text_col: str, model: LanguageModel, max_weights: int = MAX_WEIGHTS) -> DataFrame:
    """Attach ``lang_pred`` (NULL when no letters) to every row of ``df``, in one
    pass over the rows."""
    if not model.bases:
        return df.withColumn("lang_pred", F.lit(None).cast("string"))
    if model.weights.limit(max_weights + 1).count() > max_weights:
        found = _best_of_scores(df, id_col, text_col, model).withColumnRenamed("id", id_col)
        return df.join(found, id_col, "left")
    langs = sorted(model.bases)
    table = model.weights.toPandas()  # max_weights rows at most
    grams = np.unique(table["gram"].to_numpy())
    weight = np.zeros((len(grams) + 1, len(langs)))  # the last row is that of unseen trigrams
    weight[np.searchsorted(grams, table["gram"].to_numpy()), np.searchsorted(langs, table["lang"].to_numpy())] = table["w"].to_numpy()
    shared = df.sparkSession.sparkContext.broadcast((langs, grams, weight, np.array([model.bases[k] for k in langs])))

    def score(batches):
        import numpy as np
        import pyarrow as pa

        names, known, w, base = shared.value
        for b in (b.slice(*piece) for b in batches for piece in _pieces(b.column(b.num_columns - 1))):
            row, tri = _batch_trigrams(b.column(b.num_columns - 1))
            at = np.minimum(np.searchsorted(known, tri), len(known) - 1)
            at = np.where(known[at] == tri, at, len(known))
            n = np.bincount(row, minlength=b.num_rows)
            total = np.stack([np.bincount(row, w[at, k], b.num_rows) + n * base[k] for k in range(len(names))], axis=1)
            best = np.round(total, SCORE_DIGITS).argmax(1)  # the first of equals: languages are sorted
            pred = pa.array([names[k] if c else None for k, c in zip(best, n)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pred], names=[*b.schema.names[:-1], "lang_pred"])

    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType())])
    return df.withColumn("_prepared", _prepared(text_col)).mapInArrow(score, schema)


def detect(df: DataFrame, id_col: str, text_col: str, model: LanguageModel) -> DataFrame:
    """(id_col, lang_pred): best language per document that has one (score desc, lang asc)."""
    return with_language(df.select(id_col, text_col), id_col, text_col, model).filter(F.col("lang_pred").isNotNull()).select(id_col, "lang_pred")


def keep_english(df: DataFrame, id_col: str, text_col: str, model: LanguageModel) -> DataFrame:
    """B2: keep rows whose predicted language is English."""
    return with_language(df, id_col, text_col, model).filter(F.col("lang_pred") == "en").drop("lang_pred")
