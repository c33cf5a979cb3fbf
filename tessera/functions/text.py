"""Scalar text functions (H1-H9) as Column expressions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Regular expressions whose matches must equal the reference's.
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"          # vectorizer default: 2+ word characters
# the Unicode white space that str.split() and str.strip() know
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SPACE_RUN = SPACE + "+"
EDGE_SPACE = f"^{SPACE}+|{SPACE}+$"
NON_PRINTABLE_RUN = r"[^\x20-\x7E]+"       # outside printable ASCII
NON_LETTER_RUN = r"[^\p{L}]+"

# Role prefixes of the contextual encoder.
DOCUMENT_PREFIX = "search_document: "
QUERY_PREFIX = "Query: "
MAX_TOKENS = 512


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Python ``str.strip()`` (Spark ``trim`` only drops spaces)."""
    return F.regexp_replace(_c(c), EDGE_SPACE, "")


def clean_title(c: str | Column) -> Column:
    """H1: text before the first ':', stripped, lower-cased."""
    return F.lower(strip(F.split_part(_c(c), F.lit(":"), F.lit(1))))


def clean_text(c: str | Column) -> Column:
    """H2: drop every run of characters outside printable ASCII (newlines and tabs too)."""
    return F.regexp_replace(_c(c), NON_PRINTABLE_RUN, "")


def nested_get(c: str | Column, field: str, default) -> Column:
    """H3: ``d.get(field, default)`` on a struct column."""
    return F.coalesce(_c(c).getField(field), F.lit(default))


def whitespace_tokens(c: str | Column) -> Column:
    """H5: ``[w.lower() for w in str(x).split()]``; NULL text gives an empty array."""
    parts = F.split(F.lower(_c(c)), SPACE_RUN)
    return F.filter(F.coalesce(parts, F.array().cast("array<string>")), lambda w: w != "")


def word_tokens(c: str | Column) -> Column:
    """H6: vectorizer tokens, lower-cased runs of 2+ letters/digits/underscores."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(_c(c)), F.lit(WORD_TOKEN), 0),
        F.array().cast("array<string>"),
    )


def with_prefix(c: str | Column, prefix: str) -> Column:
    """H8: role prefix."""
    return F.concat(F.lit(prefix), F.coalesce(_c(c), F.lit("")))


def truncate_tokens(tokens: str | Column, n: int = MAX_TOKENS) -> Column:
    """H9: keep the first n tokens of an encoder input."""
    return F.slice(_c(tokens), 1, n)


def join_list(arr: str | Column, sep: str = ", ") -> Column:
    """H14."""
    return F.concat_ws(sep, _c(arr))


def path_label(*levels: str | Column) -> Column:
    """``Cluster a.b.c`` (NULL levels are skipped)."""
    return F.concat(F.lit("Cluster "), F.concat_ws(".", *[_c(x).cast("string") for x in levels]))
