"""Cleaning operators.

Each is one lazy DataFrame transformation; a pipeline of them stays one plan,
so filters reach the parquet scan and only the needed columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Sentinels the landed records use for missing fields.
SENTINELS = {
    "year": ["No year"],
    "authors": ["No authors"],
    "citations": ["N/A"],
    "title": ["No title"],
    "abstract": ["N/A"],
}


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """B1."""
    return df.drop(*cols)


def drop_missing(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose ``col`` is NULL."""
    return df.na.drop(subset=[col])


def drop_missing_any(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column."""
    return df.na.drop(how="any")


def coerce_numeric(df: DataFrame, col: str, to: str = "int", out: str | None = None) -> DataFrame:
    """``to_numeric(errors='coerce')`` -- unparsable text becomes NULL, never an error."""
    return df.withColumn(out or col, as_number(F.col(col), to))


def as_number(c: Column, to: str = "int") -> Column:
    """Text or number as ``to``; also the form ``'2019.0'`` that a float column is
    written in. NaN, and a fraction where ``to`` is whole, give NULL."""
    x = c.cast("string").try_cast("double")
    x = F.when(~F.isnan(x), x)
    if to in ("double", "float"):
        return x.cast(to)
    return F.coalesce(c.cast("string").try_cast(to), F.when(x == F.floor(x), x).try_cast(to))


def null_sentinels(df: DataFrame, mapping: Mapping[str, Iterable[str]]) -> DataFrame:
    """B10 (ingest side): sentinel strings such as ``'No year'`` become NULL."""
    for col, values in mapping.items():
        vals = list(values)
        df = df.withColumn(col, F.when(F.col(col).isin(vals), F.lit(None)).otherwise(F.col(col)))
    return df


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """B10 (encoder side): ``fillna`` per column."""
    return df.na.fill(dict(values))


def select_cluster(df: DataFrame, **levels) -> DataFrame:
    """Rows of one cluster path, e.g. ``select_cluster(df, level_1=3, level_2=0)``."""
    cond: Column = F.lit(True)
    for col, value in levels.items():
        cond = cond & (F.col(col) == F.lit(value))
    return df.filter(cond)


def preview(df: DataFrame, n: int = 5, order_by: str | list[str] | None = None) -> DataFrame:
    """``head(n)`` made deterministic by an explicit order (TakeOrderedAndProject)."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by or df.columns[:1])
    return df.orderBy(*keys).limit(n)


def recency_key(year_col: str, id_col: str) -> Column:
    """Order for "most recent first": year desc with NULL last, then id asc."""
    return F.struct(
        F.col(year_col).isNull().alias("_no_year"),
        (-F.col(year_col)).alias("_neg_year"),
        F.col(id_col).alias("_id"),
    )


def keep_recent(df: DataFrame, keys: list[str], year_col: str, id_col: str) -> DataFrame:
    """First row per ``keys`` by year desc (NULL last), ties by ``id_col``.

    Written as an aggregate (``min_by`` over a struct) rather than a window:
    the partial aggregate collapses every key to one row per map task
    before the shuffle, so a professor holding a third of all rows costs
    one row per task on the wire instead of a third of the table in a
    single window partition.
    """
    cols = df.columns
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), recency_key(year_col, id_col)).alias("_row")
    )
    return picked.select(*[F.col("_row." + c).alias(c) for c in cols])


def sort_recent(df: DataFrame, key: str, year_col: str) -> DataFrame:
    """key asc, year desc."""
    return df.orderBy(F.col(key).asc(), F.col(year_col).desc())


def clean_pipeline(
    df: DataFrame,
    *,
    id_col: str,
    text_col: str,
    year_col: str,
    keys: list[str],
    drop: list[str],
    is_english: Column,
) -> DataFrame:
    """B1 -> B2 -> B3 -> E1 as one lazy plan.

    ``is_english`` is a boolean column already on ``df`` (see
    ``tessera.operators.language.with_language``), so the language step is a
    filter and the whole chain is a single job.
    """
    out = drop_columns(df, *drop)
    out = out.filter(is_english)
    out = drop_missing(out, year_col)
    return keep_recent(out, keys, year_col, id_col)


def write_clean(
    df: DataFrame,
    path: str,
    *,
    id_col: str,
    year_col: str,
    keys: list[str],
    drop: list[str],
    is_english: Column,
) -> dict[str, int]:
    """I25 written to ``path`` with B9 from the same job: the rows removed by each
    step, counted by ``DataFrame.observe`` while the rows pass, so the table is
    read once.

    The counts are those of ``clean_audit``. A map task that runs again after an
    executor is lost counts its rows again, which makes them upper bounds; the
    written rows are right in any case, and ``clean_audit`` counts exactly, by
    a scan of its own. Where Spark finds at run time that no row is left it drops
    the rest of the plan with its counts, and ``clean_audit`` is called instead.
    An empty table gives zeros."""
    counts = {step: Observation() for step in ("in", "english", "dated", "out")}

    def counted(rows: DataFrame, step: str) -> DataFrame:
        return rows.observe(counts[step], F.count(F.lit(1)).alias("n"))

    out = counted(drop_columns(df, *drop), "in")
    out = counted(out.filter(is_english), "english")
    out = counted(drop_missing(out, year_col), "dated")
    counted(keep_recent(out, keys, year_col, id_col), "out").write.mode("overwrite").parquet(path)
    seen = {step: dict(c._jo.getAsJava()) for step, c in counts.items()}
    if not all(seen.values()):  # Spark leaves out steps that it finds empty, and their counts
        audit = clean_audit(df, year_col=year_col, keys=keys, is_english=is_english).first().asDict()
        return {step: value or 0 for step, value in audit.items()}
    n = {step: int(c["n"]) for step, c in seen.items()}
    return {
        "rows_in": n["in"],
        "dropped_language": n["in"] - n["english"],
        "dropped_missing_year": n["english"] - n["dated"],
        "dropped_duplicates": n["dated"] - n["out"],
        "rows_out": n["out"],
    }


def clean_audit(df: DataFrame, *, year_col: str, keys: list[str], is_english: Column) -> DataFrame:
    """Rows removed by each cleaning step, from one scan (no count() per step).

    One aggregation per dedup key gives the number of surviving rows and the
    number of groups; a second tiny aggregation sums them.
    """
    flagged = df.select(
        *[F.col(k) for k in keys],
        F.coalesce(is_english, F.lit(False)).alias("_en"),
        F.col(year_col).isNotNull().alias("_has_year"),
    )
    per_key = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(~F.col("_en"), 1).otherwise(0)).alias("_lang"),
        F.sum(F.when(F.col("_en") & ~F.col("_has_year"), 1).otherwise(0)).alias("_year"),
        F.sum(F.when(F.col("_en") & F.col("_has_year"), 1).otherwise(0)).alias("_kept"),
    )
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("rows_in"),
        F.sum("_lang").cast("bigint").alias("dropped_language"),
        F.sum("_year").cast("bigint").alias("dropped_missing_year"),
        F.sum(F.greatest(F.col("_kept") - 1, F.lit(0))).cast("bigint").alias("dropped_duplicates"),
        F.sum(F.when(F.col("_kept") > 0, 1).otherwise(0)).cast("bigint").alias("rows_out"),
    )
