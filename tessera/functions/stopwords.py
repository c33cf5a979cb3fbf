"""Stop-word tables (data, not logic).

The general English list is Spark's own ``StopWordsRemover`` English list
(``StopWordsRemover.loadDefaultStopWords("english")``), shipped here as data
so that the DuckDB oracle can be handed the very same words.
"""

from __future__ import annotations

# Spark MLlib default English stop words (181 words), in Spark's order.
SPARK_ENGLISH = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more "
    "most other some such no nor not only own same so than too very s t can will just don "
    "should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm "
    "you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't "
    "mustn't can't couldn't cannot could here's how's let's ought that's there's what's "
    "when's where's who's why's would"
).split()

# The exploration stage's extra stop words (22 entries, source order).
EXPLORE_CUSTOM = [
    "using", "via", "based", "model", "design", "impact", "state", "efficient", "method",
    "study", "©", "2023", "however,", "results", "high", "use", "used", "show", "approach",
    "system", "new", "two",
]

# The keyword stage's extra stop words (24 entries, source order).
KEYWORD_CUSTOM = EXPLORE_CUSTOM + ["article", "research"]


def union(*lists: list[str]) -> list[str]:
    """G1: set union of stop-word lists, returned sorted (deterministic)."""
    out: set[str] = set()
    for words in lists:
        out.update(words)
    return sorted(out)


EXPLORE_STOP_WORDS = union(SPARK_ENGLISH, EXPLORE_CUSTOM)
KEYWORD_STOP_WORDS = union(SPARK_ENGLISH, KEYWORD_CUSTOM)


def stop_word_frame(spark, words: list[str], col: str = "word"):
    """A one-column DataFrame of stop words: a small, size-bounded broadcast side."""
    from pyspark.sql import types as T

    return spark.createDataFrame([(w,) for w in words], T.StructType([T.StructField(col, T.StringType(), False)]))


def sql_values(words: list[str]) -> str:
    """Render a list as an SQL ``VALUES`` body: ``('a'), ('b')``."""
    return ", ".join("('" + w.replace("'", "''") + "')" for w in words)
