"""Benchmark decontamination as a prefix-filtered set join (DataFrame operations only).

A window is ``width`` consecutive words of a benchmark item, or the whole item
where it is shorter. A window is contained in a document only if all its words
are, so with a window's words ordered by their frequency in the documents the
necessary prefix is its rarest word. Documents meet windows on that word alone;
positional and length bounds follow from where it stands in the window, and
every meeting is verified word by word against the document's context.

The set of rarest words is part of the documents' pass when it has at most
``LITERAL_WORDS`` entries: each document is then read once and no text is
shuffled. Beyond that the meeting is a shuffled join on the word, followed by
a join back to the texts. Both give the same rows (tested).

Defined cases: a null or wordless text has no words and no hits; a null or
wordless item has no windows; items that share an id are one item; a null
item id counts as the empty string. Repeated document rows give a row each.
Extra columns are not read. Empty tables give no rows or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_small, lower_ascii, stored

#: Rarest words that the documents' pass may hold as a literal set.
LITERAL_WORDS = 50_000


def words(text: Column) -> Column:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` once A-Z are lower case."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def windows(items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: window (words, space-joined), len, items (ids as strings)."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    each = w.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, width))).alias("w"))
    return each.groupBy(F.array_join("w", " ").alias("window")).agg(F.first(F.size("w")).alias("len"), F.sort_array(F.collect_set("item")).alias("items"))


def _signatures(win: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """Each window with its rarest word in the documents and where it stands."""
    each = win.select("window", F.posexplode(F.split("window", " ")).alias("offset", "word"))
    vocabulary = stored(each.select("word").distinct(), "vocabulary")
    found = join_small(docs.select(F.explode(words(F.col(text_col))).alias("word")), vocabulary, "word")
    rarity = stored(vocabulary.join(found.groupBy("word").agg(F.count("*").alias("n")), "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n")), "rarity")
    first = each.join(rarity, "word").groupBy("window").agg(F.min(F.struct("n", "word", "offset")).alias("s"))
    # a word that no document has can't be met
    return stored(first.where("s.n > 0").join(win, "window").select("window", "len", "items", "s.word", "s.offset"), "signatures")


def _matches(met: DataFrame, signatures: DataFrame, how: str) -> DataFrame:
    """Verify meetings (word, pos, from_pos, context) against the windows."""
    start = F.col("pos") - F.col("offset")
    same = F.array_join(F.slice("context", start - F.col("from_pos") + 1, F.col("len")), " ") == F.col("window")
    return join_small(met, signatures, "word", how).withColumn("start", F.when((start >= 0) & (start + F.col("len") <= F.col("n_words")), start)).withColumn(
        "hit", F.coalesce(F.col("start").isNotNull() & same, F.lit(False))
    )


def _context(w: Column, pos: Column, width: int) -> Column:
    """The words that a window over ``pos`` can reach, and where they begin."""
    low = F.greatest(pos - (width - 1), F.lit(0))
    return F.struct(low.alias("from_pos"), F.slice(w, low + 1, pos - low + width).alias("context"))


def _summary(matched: DataFrame, keys: list[str]) -> DataFrame:
    hit = F.when(F.col("hit"), F.struct("start", "len"))
    grouped = matched.groupBy("row", *keys, "n_words").agg(F.collect_list(hit).alias("at"), F.collect_list(F.when(F.col("hit"), F.col("items"))).alias("items"))
    places = F.flatten(F.transform("at", lambda x: F.sequence(x["start"], x["start"] + x["len"] - 1)))
    return grouped.select(
        *keys,
        F.col("n_words").cast("long").alias("n_words"),
        F.size(F.array_distinct(places)).cast("long").alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"),
    )


def scan(
    docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", literal_words: int = LITERAL_WORDS
) -> DataFrame:
    """One row per document: ``id_col``, n_words, n_hit (words inside any
    occurrence of a window), items (ids of items with an occurring window)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signatures = _signatures(stored(windows(items, width, item_col, item_text), "windows"), rows, "text")
    head = signatures.select("word").distinct().limit(literal_words + 1).collect()
    if len(head) <= literal_words:
        rare = [r[0] for r in head]
        w = rows.select(F.monotonically_increasing_id().alias("row"), "id", words(F.col("text")).alias("w"))
        placed = F.filter(F.transform("w", lambda x, k: F.struct(x.alias("word"), k.alias("pos"))), lambda s: s["word"].isin(rare) if rare else F.lit(False))
        context = F.transform(placed, lambda s: F.struct(s["word"].alias("word"), s["pos"].alias("pos"), _context(F.col("w"), s["pos"], width).alias("c")))
        met = w.select("row", "id", F.size("w").alias("n_words"), F.explode_outer(context).alias("m"))
        met = met.select("row", "id", "n_words", "m.word", "m.pos", "m.c.from_pos", "m.c.context")
        matched = _matches(met, signatures, "left")
    else:
        kept = stored(rows.withColumn("row", F.monotonically_increasing_id()), "documents")
        each = kept.select("row", F.posexplode(words(F.col("text"))).alias("pos", "word"))
        places = each.join(signatures.select("word").distinct(), "word").groupBy("row").agg(F.collect_list(F.struct("word", "pos")).alias("placed"))
        w = kept.join(places, "row", "left").select("row", "id", words(F.col("text")).alias("w"), "placed")
        context = F.transform("placed", lambda s: F.struct(s["word"].alias("word"), s["pos"].alias("pos"), _context(F.col("w"), s["pos"], width).alias("c")))
        met = w.select("row", "id", F.size("w").alias("n_words"), F.explode_outer(context).alias("m"))
        matched = _matches(met.select("row", "id", "n_words", "m.word", "m.pos", "m.c.from_pos", "m.c.context"), signatures, "left")
    return _summary(matched, ["id"]).withColumnRenamed("id", id_col)


def clean(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark window, all columns unchanged.

    Rows that share an id and a text are judged alike, so the rows to drop are
    named by (id, text hash)."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    at = dict(zip(docs.columns, plain.columns, strict=True))
    key = F.struct(F.col(at[id_col]).isNull().alias("none"), F.coalesce(F.col(at[id_col]).cast("long"), F.lit(0)).alias("id"), F.xxhash64(F.coalesce(F.col(at[text_col]).cast("string"), F.lit(""))).alias("h"))
    found = scan(plain.select(key.alias("key"), F.col(at[text_col]).alias("text")), items, width, "key", "text")
    drop = stored(found.where("n_hit > 0").select("key.none", "key.id", "key.h").distinct(), "contaminated")
    marked = plain.select("*", key.alias("key")).select(*plain.columns, "key.none", "key.id", "key.h")
    return join_small(marked, drop, ["none", "id", "h"], "left_anti").select(*(F.col(c).alias(name) for name, c in at.items()))
