"""Exploration tables.

The reference draws bar and line charts; here each chart's *table* is a
DataFrame. Every aggregate has a partial (map-side) stage, so a hot key
costs one row per map task on the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import text as tx
from ..functions.stopwords import EXPLORE_STOP_WORDS, stop_word_frame
from .clean import as_number


def top_n_per_group(df: DataFrame, group_cols: list[str], score_col: str, key_col: str, n: int, rank_col: str = "rank") -> DataFrame:
    """Top-n per group by score desc, key asc (planned with a partial WindowGroupLimit)."""
    w = Window.partitionBy(*group_cols).orderBy(F.col(score_col).desc(), F.col(key_col).asc())
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top_authors(df: DataFrame, col: str = "professor", n: int = 30) -> DataFrame:
    """Publications per author, top n (count desc, name asc); NULL is no author."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_pubs")).orderBy(F.col("n_pubs").desc(), F.col(col)).limit(n)


def pubs_per_year(df: DataFrame, year_col: str) -> DataFrame:
    """Non-null -> numeric -> count per year -> sorted by year."""
    y = df.filter(F.col(year_col).isNotNull()).select(as_number(F.col(year_col), "int").alias("year"))
    return y.filter(F.col("year").isNotNull()).groupBy("year").agg(F.count(F.lit(1)).alias("n_pubs")).orderBy("year")


def _stop_anti(tokens: DataFrame, spark, stop_words: list[str], col: str = "word") -> DataFrame:
    # H7: anti-join against a small fixed table (AQE broadcasts it)
    return tokens.join(F.broadcast(stop_word_frame(spark, stop_words, col)), col, "left_anti")


def word_counts(df: DataFrame, text_col: str, stop_words: list[str] = EXPLORE_STOP_WORDS) -> DataFrame:
    """Vectorizer-token counts over the corpus: (word, n)."""
    toks = df.select(F.col(text_col).alias("_text")).select(F.explode(tx.word_tokens("_text")).alias("word"))
    toks = _stop_anti(toks, df.sparkSession, stop_words)
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def common_words(df: DataFrame, text_col: str, n: int = 40, stop_words: list[str] = EXPLORE_STOP_WORDS) -> DataFrame:
    """The n most frequent vectorizer tokens (count desc, word asc)."""
    return word_counts(df, text_col, stop_words).orderBy(F.col("n").desc(), F.col("word")).limit(n)


def words_by_year(df: DataFrame, year_col: str, text_col: str, stop_words: list[str] = EXPLORE_STOP_WORDS) -> DataFrame:
    """Whitespace tokens (punctuation kept) minus stop words, counted per (year, word).

    Rows with a NULL year drop out, as in a pandas group-by; NULL text gives no token.
    """
    src = df.filter(F.col(year_col).isNotNull()).select(F.col(year_col).alias("year"), F.col(text_col).alias("_text"))
    toks = src.select("year", F.explode(tx.whitespace_tokens("_text")).alias("word"))
    toks = _stop_anti(toks, df.sparkSession, stop_words)
    return toks.groupBy("year", "word").agg(F.count(F.lit(1)).alias("n"))


def top_words_in_year(freq: DataFrame, year, n: int = 10) -> DataFrame:
    """Top n words of one year (unknown year -> empty)."""
    return freq.filter(F.col("year") == F.lit(year)).orderBy(F.col("n").desc(), F.col("word")).limit(n)


def top_words_per_year(freq: DataFrame, n: int = 10) -> DataFrame:
    """D5 for all years at once (row_number per year)."""
    return top_n_per_group(freq, ["year"], "n", "word", n)


def _numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


QUANTILES = (0.25, 0.5, 0.75)
BINS = 512


def _value(df: DataFrame, col: str) -> F.Column:
    """A column as double; NaN is missing."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def order_statistics(df: DataFrame, cols: list[str], need: dict[int, set[int]], low: list, high: list, bins: int = BINS) -> dict[tuple[int, int], float]:
    """Exact values at the given ranks (0-based) of several columns.

    Each round counts the rows of every still open interval in ``bins`` equal
    parts, in one scan for all columns, with each part's smallest and largest
    value; the part that holds a rank is the next interval, until its smallest
    and largest value agree. Only counts reach the driver, ``bins`` per interval,
    whatever the table's size; a round narrows an interval by ``bins``."""
    found: dict[tuple[int, int], float] = {}
    # (column, low, high) -> ranks counted from the interval's first row
    open_: dict[tuple[int, float, float], dict[int, int]] = {(i, float(low[i]), float(high[i])): {r: r for r in ranks} for i, ranks in need.items() if ranks}
    while open_:
        for (i, lo, hi), ranks in list(open_.items()):
            if lo == hi:
                found |= {(i, r): lo for r in ranks}
                del open_[i, lo, hi]
        if not open_:
            break
        keys = list(open_)
        items = [F.struct(F.lit(k).alias("k"), _value(df, cols[i]).alias("v"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for k, (i, lo, hi) in enumerate(keys)]
        inside = df.select(F.explode(F.filter(F.array(*items), lambda t: (t["v"] >= t["lo"]) & (t["v"] <= t["hi"]))).alias("t")).select("t.*")
        # halves first: hi - lo may overflow
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        part = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
        rows = inside.groupBy("k", part.alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        parts: dict[int, list] = {}
        for r in rows:
            parts.setdefault(r["k"], []).append((r["part"], r["n"], r["lo"], r["hi"]))
        after: dict[tuple[int, float, float], dict[int, int]] = {}
        for k, key in enumerate(keys):
            own = sorted(parts[k])
            for r, at in open_[key].items():
                for _, n, lo, hi in own:
                    if at < n:
                        after.setdefault((key[0], lo, hi), {})[r] = at
                        break
                    at -= n
        open_ = after
    return found


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min, exact quartiles (linear interpolation), max per
    numeric column, long form. NULL and NaN are missing. One scan for the
    moments, and a few for the quartiles (``order_statistics``)."""
    cols = cols or _numeric_cols(df)
    aggs = []
    for i, c in enumerate(cols):
        x = _value(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    base = df.agg(*aggs).first()
    at = {i: [q * (base[f"n{i}"] - 1) for q in QUANTILES] for i in range(len(cols)) if base[f"n{i}"]}
    need = {i: {r for x in pos for r in (math.floor(x), math.ceil(x))} for i, pos in at.items()}
    bounds = [[base[f"{k}{i}"] for i in range(len(cols))] for k in ("min", "max")]
    value = order_statistics(df, cols, need, *bounds)
    rows = []
    for i, c in enumerate(cols):
        q = [value[i, math.floor(x)] + (x - math.floor(x)) * (value[i, math.ceil(x)] - value[i, math.floor(x)]) for x in at[i]] if i in at else [None] * 3
        rows.append((c, base[f"n{i}"], base[f"mean{i}"], base[f"std{i}"], base[f"min{i}"], *q, base[f"max{i}"]))
    names = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return df.sparkSession.createDataFrame(rows, T.StructType([T.StructField("column", T.StringType()), T.StructField("count", T.LongType()), *(T.StructField(n, T.DoubleType()) for n in names)]))


def profile_columns(df: DataFrame) -> DataFrame:
    """``df.info()`` as a table (position, column, dtype, non_null), one scan."""
    one = df.agg(*[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), F.col(f"_c{i}").alias("non_null"))
        for i, f in enumerate(df.schema.fields)
    ]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, all columns in one scan."""
    one = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"_c{i}"), F.lit(0).cast("bigint")).alias("n_null")) for i, c in enumerate(df.columns)]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def duplicate_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """``duplicated().sum()`` -- every copy after the first counts.

    Strings are grouped by their SHA-256, so whole texts are never shuffled."""
    kind = dict(df.dtypes)
    keys = [(F.sha2(F.col(c).cast("binary"), 256) if kind[c] == "string" else F.col(c)).alias(f"k{i}") for i, c in enumerate(subset or df.columns)]
    g = df.select(*keys).groupBy(*(f"k{i}" for i in range(len(keys)))).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))
