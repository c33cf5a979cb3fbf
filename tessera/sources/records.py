"""Landed publication records -> publication table.

The reference crawls a scholar site and calls a paper-lookup service; here
the work starts from *landed* records (JSON lines or a JSON text column) and
landed lookup candidates, and everything after landing is a DataFrame job:
``from_json`` with an explicit schema -> ``explode_outer`` -> ``coalesce``
defaults -> filter untitled -> join abstracts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

# Defaults the landed form writes for missing fields.
NO_YEAR = "No year"
NO_AUTHORS = "No authors"
NO_CITATIONS = "N/A"
NO_ABSTRACT = "N/A"
NO_TITLE = "No title"

BIB = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("pub_year", T.StringType()),
        T.StructField("author", T.StringType()),
    ]
)
# ``error`` marks a publication whose details could not be fetched
PUBLICATION = T.StructType([T.StructField("bib", BIB), T.StructField("num_citations", T.StringType()), T.StructField("error", T.StringType())])
RAW_RECORD = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("publications", T.ArrayType(PUBLICATION)),
    ]
)
CANDIDATE = T.StructType([T.StructField("title", T.VariantType()), T.StructField("abstract", T.VariantType())])
LOOKUP = T.StructType([T.StructField("data", T.ArrayType(CANDIDATE))])


def parse_json(df: DataFrame, col: str, schema: T.StructType, out: str = "rec") -> DataFrame:
    """H3: schema'd, permissive parse; malformed text gives NULL fields, never an error.

    A string field takes any scalar as text; declare it a variant and read it
    with ``string_or_null`` where only a string will do."""
    return df.withColumn(out, F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}))


def string_or_null(variant: F.Column) -> F.Column:
    """H4: the value if it is a string; numbers, objects and the like give NULL."""
    return F.when(F.schema_of_variant(variant) == "STRING", F.try_variant_get(variant, "$", "string"))


def flatten_records(df: DataFrame, json_col: str = "value", professor_col: str | None = None) -> DataFrame:
    """A5 + B8: one row per titled publication:
    (professor, title, pub_year, authors, citations) with the landed defaults.

    A publication that failed to load (``error``) yields its title, or the
    default title, and defaults for all else. A record that fails to parse, or
    has no publications, yields no row.
    """
    p = parse_json(df, json_col, RAW_RECORD)
    prof = F.col(professor_col) if professor_col else F.col("rec.name")
    pubs = p.select(prof.alias("professor"), F.explode_outer("rec.publications").alias("pub"))
    failed = F.col("pub.error").isNotNull()
    pub = F.when(~failed, F.col("pub"))
    flat = pubs.select(
        "professor",
        F.coalesce(F.col("pub.bib.title"), F.when(failed, F.lit(NO_TITLE))).alias("title"),
        tx.nested_get(pub["bib"], "pub_year", NO_YEAR).alias("pub_year"),
        tx.nested_get(pub["bib"], "author", NO_AUTHORS).alias("authors"),
        tx.nested_get(pub, "num_citations", NO_CITATIONS).alias("citations"),
    )
    return flat.filter(F.col("title").isNotNull() & (F.col("title") != ""))


def first_match(papers: DataFrame, title_col: str, candidates: DataFrame, cand_title_col: str, cand_abstract_col: str, rank_col: str) -> DataFrame:
    """Abstract of the first candidate (lowest rank) whose normalized title
    equals the paper's; no candidate -> 'N/A'; non-ASCII stripped. Ties of rank
    go to the smallest text.

    Candidates are reduced to one row per key with a minimum (partial aggregate:
    a key with a huge candidate list costs one row per task). Keys are SHA-256 of
    the normalized titles, so that no title is shuffled, however long.
    """
    best = candidates.select(
        title_key(tx.clean_title(cand_title_col)).alias("_key"), F.col(cand_abstract_col).alias("_abs"), F.col(rank_col).alias("_rank")
    ).groupBy("_key").agg(F.min(F.struct(F.col("_rank"), F.col("_abs")))["_abs"].alias("_first"))
    p = papers.withColumn("_key", title_key(tx.clean_title(title_col)))
    out = p.join(best, "_key", "left")
    return out.withColumn("abstract", F.coalesce(tx.clean_text("_first"), F.lit(NO_ABSTRACT))).drop("_key", "_first")


def title_key(title: F.Column) -> F.Column:
    """32 bytes that stand for a title in shuffles (NULL for NULL)."""
    return F.unhex(F.sha2(title.cast("binary"), 256))


def merge_abstracts(papers: DataFrame, title_col: str, lookup: DataFrame, key_col: str, abstract_col: str, seq_col: str) -> DataFrame:
    """``papers[title].map(dict)``: left equi-join on the title; for a title
    landed twice the last value (highest seq, then largest text) wins; absent -> NULL.
    Titles meet by their SHA-256."""
    last = lookup.groupBy(title_key(F.col(key_col)).alias("_t")).agg(F.max(F.struct(F.col(seq_col).alias("s"), F.col(abstract_col).alias("a")))["a"].alias("abstract"))
    return papers.withColumn("_t", title_key(F.col(title_col))).join(last, "_t", "left").drop("_t")


def build_snapshot(records: DataFrame, json_col: str, lookups: DataFrame) -> DataFrame:
    """Landed records + landed lookup responses -> merged publication table.

    ``lookups``: (title, response JSON, seq); the first candidate of each
    response gives the abstract (A6), the latest response per title wins (C1).
    """
    papers = flatten_records(records, json_col)
    resp = parse_json(lookups, "response", LOOKUP).select(
        F.col("title").alias("_t"), F.col("seq"), string_or_null(F.get(F.col("rec.data"), F.lit(0))["abstract"]).alias("_abs")
    )
    resp = resp.withColumn("_abs", F.coalesce(tx.clean_text("_abs"), F.lit(NO_ABSTRACT)))
    merged = merge_abstracts(papers, "title", resp, "_t", "_abs", "seq")
    return merged.withColumn("abstract", F.coalesce("abstract", F.lit(NO_ABSTRACT)))
