"""Registered queries of this subpackage: each applies one operator to its
whole table and returns the columns that its contract names; ``SQL`` has the
DuckDB form where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import align, contentsort, decontam, langid, licenses, mixing, packing, quality, simhash, toxicity, urlgraph, veccode, warc
from .common import crc_fold, stored

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


def with_language(docs: DataFrame) -> DataFrame:
    """Documents with lang_pred and score, learned from the rows not held out."""
    return langid.predict(docs, langid.fit(docs.where(~langid.held_out("doc_id"))))


@register("op1_language_mixture")
def op1_language_mixture(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score", "languages"
    )


#: Parameters of op2.
TOKENIZER, END_ID, CAPACITY = public_tokenizers.path("byte_bpe_50k.json"), 2, 1024


def packed_documents(docs: DataFrame) -> DataFrame:
    parts = packing.pieces(docs, TOKENIZER, END_ID, CAPACITY).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(parts, CAPACITY)


@register("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf):
    return packed_documents(table(spark, sf, "documents"))


@register("op4_content_sort")
def op4_content_sort(spark, sf):
    return contentsort.dedup(table(spark, sf, "documents"), keep="largest")


SQL["op4_content_sort"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@register("op7_simhash")
def op7_simhash(spark, sf):
    return simhash.groups(table(spark, sf, "documents"), shingle=3, max_bits=3)


@register("op5_decontaminate")
def op5_decontaminate(spark, sf):
    found = decontam.scan(table(spark, sf, "documents"), table(spark, sf, "benchmark"), width=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SQL["op5_decontaminate"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
),
own AS (
  SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS t
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
hit AS (SELECT r, s, n, item FROM own JOIN win USING (n, t)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN found USING (r)
"""


def _held_out():
    """The fold that labels may not be learned from (op3, op10)."""
    return crc_fold("doc_id", 4) == 2


@register("op10_toxic_segments")
def op10_toxic_segments(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.where(~_held_out()), "toxic")
    found = toxicity.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


@register("op3_attention_quality")
def op3_attention_quality(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit(docs, labels.where(~_held_out()), "quality")
    found = quality.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("attention").alias("n_passages"))


@register("op6_license_templates")
def op6_license_templates(spark, sf):
    return licenses.summary(licenses.scan(table(spark, sf, "documents").select("doc_id", "text")))


def _phrase_places(phrase: str) -> str:
    n = len(phrase.split())
    return f"list_filter(range(1, len(w) + 1), lambda i: array_to_string(w[i : i + {n - 1}], ' ') = '{phrase}')"


_BASE = [(f"p{k}", phrase, label) for k, (phrase, label) in enumerate(licenses.PHRASES)]
_MORE = [(licenses.as_pattern(markup), label) for markup, label in licenses.TEMPLATES]
_LABELS = ", ".join(f"CASE WHEN len({p}) > 0 THEN '{label}' END" for p, _, label in _BASE)
_OWN = ", ".join(f"CASE WHEN regexp_matches(t, ' {pattern}') THEN '{label}' END" for pattern, label in _MORE)

SQL["op6_license_templates"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
found AS (
  SELECT doc_id, len(w) AS n, {", ".join(f"{_phrase_places(phrase)} AS {p}" for p, phrase, _ in _BASE)},
         ' ' || array_to_string(w, ' ') || ' ' AS t
  FROM d
),
named AS (
  SELECT *, flatten([{", ".join(p for p, _, _ in _BASE)}]) AS places,
         list_filter([{_LABELS}], lambda x: x IS NOT NULL) AS base, list_filter([{_OWN}], lambda x: x IS NOT NULL) AS own
  FROM found
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, own))), ',') AS labels,
       CAST(CASE WHEN len(own) > 0 THEN 1 WHEN len(base) > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score
FROM named
"""


@register("op8_warc_archives")
def op8_warc_archives(spark, sf):
    files = warc.write(table(spark, sf, "pages"), min_bytes=0)
    return warc.read(files, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: base32 of a hex digest: five hex digits are four base32 digits
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = " || ".join(f"substr('{_BASE32}', 1 + ((x >> {s}) & 31), 1)" for s in (15, 10, 5, 0))

SQL["op8_warc_archives"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS keep FROM p)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda k: list_transform([CAST('0x' || substr(s, CAST(5 * k + 1 AS INT), 5) AS INT)], lambda x: {_DIGITS})[1]), '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM g
"""


#: Rules of op9: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@register("op9_url_graph")
def op9_url_graph(spark, sf):
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    found = urlgraph.judge(table(spark, sf, "pages"), rules)
    return found.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), "rule", "verdict")


def _url_graph_sql() -> str:
    rounds, d = urlgraph.ROUNDS, urlgraph.DAMPING
    low = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = urlgraph.LINK.replace("'", "''")
    rules = ", ".join(str(r) for r in URL_RULES)
    steps = "".join(
        f""",
s{k} AS MATERIALIZED (
  SELECT host, sum(t) AS t, sum(b) AS b FROM (
    SELECT host, t, b FROM s0
    UNION ALL SELECT dst, t * fwd * {d}, 0 FROM share JOIN s{k - 1} ON src = host
    UNION ALL SELECT src, 0, b * back * {d} FROM share JOIN s{k - 1} ON dst = host
  ) GROUP BY host
)"""
        for k in range(1, rounds + 1)
    )
    return f"""
WITH u AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
p AS (
  SELECT page_id, html, {low("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
),
r(verdict, rhost, rpath) AS (VALUES {rules}),
fit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN r ON (host = rhost OR suffix(host, '.' || rhost)) AND prefix(path, rpath) GROUP BY page_id
),
j AS (SELECT p.*, rule, verdict FROM p LEFT JOIN fit USING (page_id)),
s0 AS MATERIALIZED (
  SELECT host, {1 - d} * avg(CASE WHEN verdict = 'allow' THEN 1.0 ELSE 0 END) AS t, {1 - d} * avg(CASE WHEN verdict = 'block' THEN 1.0 ELSE 0 END) AS b
  FROM j GROUP BY host
),
link AS (SELECT host AS src, {low("unnest(regexp_extract_all(coalesce(html, ''), '" + link + "', 1))")} AS dst FROM p),
edge AS (SELECT src, dst, count(*) AS n FROM link WHERE src <> dst AND src <> '' GROUP BY src, dst),
share AS MATERIALIZED (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS fwd, n / sum(n) OVER (PARTITION BY dst) AS back FROM edge){steps}
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN b > t AND b >= {urlgraph.THRESHOLD * (1 - d)} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN s{rounds} USING (host)
"""


SQL["op9_url_graph"] = _url_graph_sql()


#: The tokenizers of op11.
SIDE_A, SIDE_B = ("byte_bpe", TOKENIZER), ("piece", public_tokenizers.path("piece_bpe_32k.model"))


def alignment_digest(docs: DataFrame, frequent: int = align.FREQUENT_ROWS) -> DataFrame:
    found = align.align(docs, SIDE_A, SIDE_B)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    kept = stored(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return align.with_counts(kept, frequent).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@register("op11_token_alignment")
def op11_token_alignment(spark, sf):
    return alignment_digest(table(spark, sf, "documents"))


#: Parameters of op13: weights in turn, the most passes over a source, words of a block.
MIX_WEIGHTS, MIX_PASSES, MIX_BLOCK = (5, 2, 1), 3, 256


@register("op13_source_schedule")
def op13_source_schedule(spark, sf):
    return mixing.taken(mixing.mix(table(spark, sf, "documents"), MIX_WEIGHTS, MIX_PASSES, MIX_BLOCK))


SQL["op13_source_schedule"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source
),
w AS (SELECT *, CAST({list(MIX_WEIGHTS)}[(k - 1) % {len(MIX_WEIGHTS)} + 1] AS BIGINT) AS weight, {MIX_PASSES} * source_size AS most FROM s),
-- by limit per weight: what is left for a source and those after it, by weight
o AS (
  SELECT *, sum(source_size) OVER () - sum(most) OVER up + most AS rest, sum(weight) OVER () - sum(weight) OVER up + weight AS among,
         row_number() OVER up AS nth
  FROM w WINDOW up AS (ORDER BY most / weight, k ROWS UNBOUNDED PRECEDING)
),
level AS (SELECT arg_min(CAST(rest AS DOUBLE) / CAST(among AS DOUBLE), nth) AS per FROM o WHERE most > weight * (CAST(rest AS DOUBLE) / CAST(among AS DOUBLE))),
t AS (SELECT source, k, source_size, CAST(coalesce(least(most, weight * per), most) AS DOUBLE) AS target FROM w, level),
p AS (
  SELECT r, size, floor(target + 0.5) AS take,
         sum(size) OVER (PARTITION BY k ORDER BY pass, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || pass), 1, 15) AS BIGINT),
                         doc_id, size, r ROWS UNBOUNDED PRECEDING) - size AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (SELECT unnest(range(0, {MIX_PASSES})) AS pass)
),
got AS (SELECT r, CAST(sum(greatest(least(place + size, take) - place, 0)) AS BIGINT) AS taken FROM p GROUP BY r)
SELECT doc_id, size, source_size, target, taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN got USING (r)
"""


#: Parameters of op12.
CODE_PARTS, CODE_ENTRIES, CODE_ROUNDS, CODE_SCALE = 16, 64, 2, 256


@register("op12_vector_codes")
def op12_vector_codes(spark, sf):
    coded = veccode.encode(table(spark, sf, "embeddings"), CODE_PARTS, CODE_ENTRIES, CODE_ROUNDS, CODE_SCALE)
    digest = hashlib.sha256(",".join(map(str, coded.codebooks.ravel().tolist())).encode()).hexdigest()
    return veccode.with_label_error(coded).select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _codes_sql() -> str:
    near = """
a{k} AS MATERIALIZED (
  SELECT r, part, min({{'d': list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v) + list_inner_product(c.v, c.v), 'e': entry}}) AS m
  FROM p JOIN c{k} c USING (part) GROUP BY r, part
)"""
    mean = """,
m{k} AS (
  SELECT part, m.e AS entry, j, floor(sum(v[j]) / count(*)) AS x FROM a{k} JOIN p USING (r, part), (SELECT unnest(range(1, size + 1)) AS j FROM dim) GROUP BY ALL
),
c{n} AS MATERIALIZED (
  SELECT part, entry, coalesce(u.v, c{k}.v) AS v
  FROM c{k} LEFT JOIN (SELECT part, entry, list(x ORDER BY j) AS v FROM m{k} GROUP BY part, entry) u USING (part, entry)
),"""
    rounds = "".join(near.format(k=k) + mean.format(k=k, n=k + 1) for k in range(CODE_ROUNDS)) + near.format(k=CODE_ROUNDS)
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({CODE_SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
dim AS (SELECT arg_min(len(x), vec_id) // {CODE_PARTS} AS size FROM e),
p AS MATERIALIZED (SELECT r, vec_id, x, part, x[part * size + 1 : part * size + size] AS v FROM e, dim, (SELECT unnest(range({CODE_PARTS})) AS part) WHERE len(x) = {CODE_PARTS} * size),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id, x) - 1 AS entry, v FROM p WHERE vec_id IS NOT NULL QUALIFY entry < {CODE_ENTRIES}),{rounds},
found AS (SELECT r, string_agg(format('{{:02x}}', m.e), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{CODE_ROUNDS} GROUP BY r),
books AS (
  SELECT sha256(string_agg(CAST(CAST(v[j] AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, j)) AS codebooks_sha256
  FROM c{CODE_ROUNDS}, (SELECT unnest(range(1, size + 1)) AS j FROM dim)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM found JOIN e USING (r), books
"""


SQL["op12_vector_codes"] = _codes_sql()
