"""DuckDB oracle SQL for each registered query (same column names as Spark).

The views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are registered
by the caller. Stop-word lists come from the same Python data as the Spark
side, so both engines use identical words.
"""

from __future__ import annotations

from ..functions.stopwords import EXPLORE_STOP_WORDS, sql_values

SQL: dict[str, str] = {}

# the white space of str.split() and str.strip()
SPACE = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

STOP_CTE = f"stop(word) AS (VALUES {sql_values(EXPLORE_STOP_WORDS)})"

PUBS_YEAR = "CAST(1995 + doc_id % 7 AS INTEGER)"

# language model CTEs: prep -> grams -> counts -> weights/bases -> pred(doc_id, lang_pred)
LANG_CTES = r"""
prep AS (
  SELECT doc_id, lang, ' ' || regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g') || ' ' AS s FROM documents
),
grams AS (
  SELECT doc_id, gram, count(*) AS c FROM (
    SELECT doc_id, substring(s, i, 3) AS gram
    FROM (SELECT doc_id, s, unnest(range(1, length(s) - 1)) AS i FROM prep)
  ) WHERE gram <> '   ' GROUP BY doc_id, gram
),
counts AS (
  SELECT p.lang, g.gram, sum(g.c) AS n FROM grams g JOIN prep p ON g.doc_id = p.doc_id
  WHERE p.lang IS NOT NULL GROUP BY p.lang, g.gram
),
weights AS (SELECT lang, gram, ln(n + 1.0) AS w FROM counts),
bases AS (SELECT lang, -ln(sum(n) + 5000.0) AS base FROM counts GROUP BY lang),
totals AS (SELECT doc_id, sum(c) AS n_doc FROM grams GROUP BY doc_id),
parts AS (
  SELECT g.doc_id, w.lang, g.c * w.w AS part FROM grams g JOIN weights w ON g.gram = w.gram
  UNION ALL
  SELECT t.doc_id, b.lang, t.n_doc * b.base AS part FROM totals t, bases b
),
scores AS (SELECT doc_id, lang, sum(part) AS score FROM parts GROUP BY doc_id, lang),
pred AS (
  SELECT doc_id, lang AS lang_pred FROM (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 6) DESC, lang) AS rn
    FROM scores) WHERE rn = 1
)
"""

DOCS_LABELS = "(SELECT d.doc_id, d.source, d.lang, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"

SQL["drop_columns"] = "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders"

SQL["drop_na"] = f"SELECT doc_id, source, quality, toxic FROM {DOCS_LABELS} WHERE quality IS NOT NULL"

SQL["drop_na_any"] = f"""
SELECT doc_id, source, lang, quality, toxic FROM {DOCS_LABELS}
WHERE doc_id IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL
"""

SQL["coerce_year"] = f"""
SELECT doc_id, citations_text, CAST(TRY_CAST(citations_text AS DOUBLE) AS INTEGER) AS citations FROM (
  SELECT doc_id, coalesce(CAST(quality AS VARCHAR) || CASE WHEN doc_id % 3 = 0 THEN '.0' ELSE '' END, 'N/A') AS citations_text FROM {DOCS_LABELS})
"""

SQL["fill_missing"] = f"SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM {DOCS_LABELS}"

SQL["cluster_rows"] = "SELECT vec_id, label FROM embeddings WHERE label = 3"

SQL["preview"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5"

SQL["keep_recent"] = """
SELECT pub_id, professor, authors, pub_year FROM (
  SELECT o_orderkey AS pub_id, o_custkey AS professor, o_orderpriority AS authors,
         CAST(year(o_orderdate) AS INTEGER) AS pub_year,
         row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                            ORDER BY year(o_orderdate) DESC NULLS LAST, o_orderkey) AS rn
  FROM orders) WHERE rn = 1
"""

SQL["language_id"] = f"WITH {LANG_CTES} SELECT doc_id, lang_pred FROM pred"

SQL["keep_english"] = f"""
WITH {LANG_CTES}
SELECT d.doc_id, d.source FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM pred WHERE lang_pred = 'en')
"""

PUBS_FLAGGED = f"""
pubs AS (
  SELECT d.doc_id AS pub_id, d.source AS professor, l.quality, l.toxic,
         CASE WHEN l.toxic IS NOT NULL THEN CAST(1995 + d.doc_id % 7 AS INTEGER) END AS pub_year,
         p.lang_pred
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN pred p ON d.doc_id = p.doc_id
)
"""

SQL["clean_pipeline"] = f"""
WITH {LANG_CTES}, {PUBS_FLAGGED}
SELECT pub_id, professor, quality, pub_year FROM (
  SELECT *, row_number() OVER (PARTITION BY professor, quality ORDER BY pub_year DESC NULLS LAST, pub_id) AS rn
  FROM pubs WHERE lang_pred = 'en' AND pub_year IS NOT NULL) WHERE rn = 1
"""

SQL["clean_audit"] = f"""
WITH {LANG_CTES}, {PUBS_FLAGGED},
flags AS (SELECT professor, quality, coalesce(lang_pred = 'en', false) AS en, pub_year IS NOT NULL AS has_year FROM pubs),
per_key AS (
  SELECT professor, quality, count(*) AS n,
         sum(CASE WHEN NOT en THEN 1 ELSE 0 END) AS lang_d,
         sum(CASE WHEN en AND NOT has_year THEN 1 ELSE 0 END) AS year_d,
         sum(CASE WHEN en AND has_year THEN 1 ELSE 0 END) AS kept
  FROM flags GROUP BY professor, quality)
SELECT CAST(sum(n) AS BIGINT) AS rows_in, CAST(sum(lang_d) AS BIGINT) AS dropped_language,
       CAST(sum(year_d) AS BIGINT) AS dropped_missing_year,
       CAST(sum(greatest(kept - 1, 0)) AS BIGINT) AS dropped_duplicates,
       CAST(sum(CASE WHEN kept > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_out
FROM per_key
"""

SQL["write_clean"] = SQL["clean_audit"]

TITLE_KEY = f"lower(regexp_replace(split_part(text, ':', 1), '^{SPACE}+|{SPACE}+$', '', 'g'))"

SQL["clean_title"] = f"SELECT doc_id, {TITLE_KEY} AS title_key FROM documents"

SQL["encoder_tokens"] = f"""
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower('search_document: ' || coalesce(text, '')), '{SPACE}+'), lambda w: w <> '')[1:512] AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, t[1] AS first_token, t[-1] AS last_token FROM t
"""

SQL["clean_text"] = r"SELECT page_id, regexp_replace(html, '[^\x20-\x7E]+', '', 'g') AS clean_html FROM pages"

SQL["top_authors"] = "SELECT source AS professor, count(*) AS n_pubs FROM documents WHERE source IS NOT NULL AND doc_id % 11 <> 0 GROUP BY source ORDER BY n_pubs DESC, professor LIMIT 30"

SQL["pubs_per_year"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_pubs FROM orders
WHERE o_orderdate IS NOT NULL GROUP BY 1 ORDER BY 1
"""

WORD_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"

SQL["common_words"] = f"""
WITH {STOP_CTE},
toks AS (SELECT unnest({WORD_TOKENS}) AS word FROM documents)
SELECT word, count(*) AS n FROM toks WHERE word NOT IN (SELECT word FROM stop)
GROUP BY word ORDER BY n DESC, word LIMIT 40
"""

WORDS_BY_YEAR = f"""
{STOP_CTE},
toks AS (
  SELECT {PUBS_YEAR} AS year, unnest(regexp_split_to_array(lower(text), '{SPACE}+')) AS word FROM documents),
freq AS (
  SELECT year, word, count(*) AS n FROM toks WHERE word <> '' AND word NOT IN (SELECT word FROM stop) GROUP BY year, word)
"""

SQL["words_by_year"] = f"WITH {WORDS_BY_YEAR} SELECT year, word, n FROM freq"

SQL["top_words_in_year"] = f"WITH {WORDS_BY_YEAR} SELECT year, word, n FROM freq WHERE year = 1998 ORDER BY n DESC, word LIMIT 10"

SQL["top_words_per_year"] = f"""
WITH {WORDS_BY_YEAR}
SELECT * FROM (SELECT year, word, n, row_number() OVER (PARTITION BY year ORDER BY n DESC, word) AS "rank" FROM freq)
WHERE "rank" <= 10
"""


def _describe_one(col: str) -> str:
    value = "CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END" if col == "o_totalprice" else col
    return f"""
SELECT '{col}' AS "column", count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
       round(quantile_cont(x, 0.75), 6) AS p75, round(max(x), 6) AS max
FROM (SELECT CAST({value} AS DOUBLE) AS x FROM orders)"""


SQL["describe"] = " UNION ALL ".join(_describe_one(c) for c in ["o_orderkey", "o_custkey", "o_totalprice"])

_DL_COLS = [("doc_id", "bigint"), ("source", "string"), ("lang", "string"), ("text", "string"), ("quality", "int"), ("toxic", "int")]

SQL["profile_columns"] = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM {DOCS_LABELS}"
    for i, (c, t) in enumerate(_DL_COLS)
)

SQL["null_counts"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM {DOCS_LABELS}"
    for c, _ in _DL_COLS
)

SQL["duplicate_rows"] = """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM documents GROUP BY source, text)
"""

# ---------------------------------------------------------------- vectors and quality

EV = """ev AS (
  SELECT vec_id AS id, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim,
         CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings)"""

SQL["cluster_ids"] = "SELECT DISTINCT label FROM embeddings WHERE label IS NOT NULL"

SQL["cluster_sizes"] = """
SELECT label, count(*) AS size, count(*) >= 6 AS can_split FROM embeddings WHERE label IS NOT NULL GROUP BY label
"""

SQL["cluster_centroids"] = f"WITH {EV} SELECT label, dim, round(avg(x), 6) AS mean FROM ev WHERE label IS NOT NULL GROUP BY label, dim"

SQL["unit_vectors"] = """
SELECT vec_id, CASE WHEN nrm = 0 OR nrm IS NULL THEN NULL
                    ELSE list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) / nrm, 6)) END AS unit
FROM (SELECT vec_id, embedding,
             sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm
      FROM embeddings)
"""

COSINE_TO_0 = f"""{EV},
q AS (SELECT dim, x AS qx FROM ev WHERE id = 0),
s AS (SELECT e.id, sum(e.x * q.qx) / (sqrt(sum(e.x * e.x)) * sqrt(sum(q.qx * q.qx))) AS sim
      FROM ev e JOIN q ON e.dim = q.dim GROUP BY e.id)"""

SQL["cosine_topk"] = f"""
WITH {COSINE_TO_0}
SELECT id AS vec_id, round(sim, 6) AS similarity FROM s WHERE sim IS NOT NULL ORDER BY similarity DESC, vec_id LIMIT 10
"""

SQL["retrieve_coarse"] = f"""
WITH {COSINE_TO_0}
SELECT t.doc_id, d.source, t.coarse_similarity FROM (
  SELECT id AS doc_id, round(sim, 6) AS coarse_similarity FROM s WHERE sim IS NOT NULL
  ORDER BY coarse_similarity DESC, doc_id LIMIT 500) t LEFT JOIN documents d ON d.doc_id = t.doc_id
"""

SQL["pairwise_similarity"] = f"""
WITH {EV},
s AS (SELECT a.id AS id_a, b.id AS id_b,
             round(sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x))), 6) AS similarity
      FROM ev a JOIN ev b ON a.dim = b.dim AND a.id < b.id GROUP BY a.id, b.id)
SELECT id_a, id_b, similarity FROM s WHERE similarity >= 0.4
"""

PAIR_DIST = f"""{EV},
pd AS (SELECT a.id AS src, b.id AS dst, sqrt(sum((a.x - b.x) * (a.x - b.x))) AS dist
       FROM ev a JOIN ev b ON a.dim = b.dim GROUP BY a.id, b.id)"""

SQL["knn_graph"] = f"""
WITH {PAIR_DIST},
r AS (SELECT src, dst FROM (
        SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY round(dist, 8), dst) AS rn FROM pd)
      WHERE rn <= 10),
u AS (SELECT src, dst, 0.5 AS w FROM r UNION ALL SELECT dst AS src, src AS dst, 0.5 AS w FROM r)
SELECT src, dst, CAST(sum(w) AS DOUBLE) AS weight FROM u GROUP BY src, dst
"""

SQL["assign_nearest"] = f"""
WITH {EV},
cent AS (SELECT label, dim, avg(x) AS m FROM ev WHERE label IS NOT NULL GROUP BY label, dim),
d AS (SELECT e.id, c.label AS c, round(sqrt(sum((e.x - c.m) * (e.x - c.m))), 8) AS distance
      FROM ev e JOIN cent c ON e.dim = c.dim GROUP BY e.id, c.label)
SELECT id AS vec_id, CAST(c AS INTEGER) AS nearest, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, c) AS rn FROM d) WHERE rn = 1
"""

SQL["silhouette"] = f"""
WITH {PAIR_DIST},
lab AS (SELECT vec_id AS id, label FROM embeddings WHERE label IS NOT NULL),
sums AS (SELECT p.src AS id, li.label, lj.label AS other_label, sum(p.dist) AS sum_dist, count(*) AS n
         FROM pd p JOIN lab li ON p.src = li.id JOIN lab lj ON p.dst = lj.id GROUP BY 1, 2, 3),
own AS (SELECT id, n AS n_own, CASE WHEN n > 1 THEN sum_dist / (n - 1) END AS a FROM sums WHERE label = other_label),
oth AS (SELECT id, min(sum_dist / n) AS b FROM sums WHERE label <> other_label GROUP BY id),
per AS (SELECT CASE WHEN o.n_own <= 1 OR t.b IS NULL THEN 0.0 ELSE (t.b - o.a) / greatest(o.a, t.b) END AS s
        FROM own o LEFT JOIN oth t ON o.id = t.id)
SELECT round(avg(s), 6) AS silhouette FROM per
"""

CLUSTER_SUMS = f"""{EV},
cs AS (SELECT label, count(DISTINCT id) AS n, sum(x * x) AS sq FROM ev WHERE label IS NOT NULL GROUP BY label),
fs AS (SELECT label, dim, sum(x) AS vsum FROM ev WHERE label IS NOT NULL GROUP BY label, dim)"""

SQL["silhouette_sq"] = f"""
WITH {CLUSTER_SUMS},
xn AS (SELECT id, label, sum(x * x) AS xn FROM ev WHERE label IS NOT NULL GROUP BY id, label),
dots AS (SELECT e.id, f.label AS c, sum(e.x * f.vsum) AS dot FROM ev e JOIN fs f ON e.dim = f.dim
         WHERE e.label IS NOT NULL GROUP BY e.id, f.label),
dd AS (SELECT x.id, x.label, d.c, cs.n AS nc, x.xn + cs.sq / cs.n - 2 * d.dot / cs.n AS d
       FROM xn x JOIN dots d ON x.id = d.id JOIN cs ON cs.label = d.c),
own AS (SELECT id, nc AS n_own, d * nc / greatest(nc - 1, 1) AS a FROM dd WHERE label = c),
oth AS (SELECT id, min(d) AS b FROM dd WHERE label <> c GROUP BY id),
per AS (SELECT CASE WHEN o.n_own <= 1 OR t.b IS NULL THEN 0.0
                    WHEN o.a < t.b THEN 1 - o.a / t.b WHEN o.a > t.b THEN t.b / o.a - 1 ELSE 0.0 END AS s
        FROM own o LEFT JOIN oth t ON o.id = t.id)
SELECT round(avg(s), 6) AS silhouette_sq FROM per
"""

SQL["calinski_harabasz"] = f"""
WITH {CLUSTER_SUMS},
v AS (SELECT f.label, f.dim, f.vsum, c.n FROM fs f JOIN cs c ON f.label = c.label),
g AS (SELECT dim, sum(vsum) AS g, sum(n) AS n_tot, count(*) AS k_tot FROM v GROUP BY dim),
t AS (SELECT sum(v.vsum * v.vsum / v.n) AS fn, sum(v.n * pow(v.vsum / v.n - g.g / g.n_tot, 2)) AS between_ss,
             max(g.n_tot) AS n_tot, max(g.k_tot) AS k_tot FROM v JOIN g ON v.dim = g.dim),
sq AS (SELECT sum(sq) AS sq FROM cs)
SELECT round((t.between_ss / (t.k_tot - 1)) / ((sq.sq - t.fn) / (t.n_tot - t.k_tot)), 6) AS calinski_harabasz FROM t, sq
"""

# ---------------------------------------------------------------- keywords and tree

from ..functions.stopwords import KEYWORD_STOP_WORDS  # noqa: E402

LEVELED = rf"""
kstop(term) AS (VALUES {sql_values(KEYWORD_STOP_WORDS)}),
base AS (
  SELECT d.doc_id AS id, CASE WHEN d.doc_id % 11 <> 0 THEN d.source END AS professor, d.text,
         CAST(coalesce(e.label, 10 + d.doc_id % 2) AS INTEGER) AS l1,
         CAST(d.doc_id % 3 AS INTEGER) AS l2, CASE WHEN d.doc_id % 5 <> 0 THEN CAST(d.doc_id % 2 AS INTEGER) END AS l3
  FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id),
terms AS (
  SELECT id, term, count(*) AS tf FROM (
    SELECT id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM base)
  WHERE term NOT IN (SELECT term FROM kstop) GROUP BY id, term),
paths AS (
  SELECT id, 1 AS level, CAST(l1 AS VARCHAR) AS path FROM base WHERE l1 IS NOT NULL
  UNION ALL SELECT id, 2 AS level, l1 || '.' || l2 AS path FROM base WHERE l1 IS NOT NULL AND l2 IS NOT NULL
  UNION ALL SELECT id, 3 AS level, l1 || '.' || l2 || '.' || l3 AS path FROM base
            WHERE l1 IS NOT NULL AND l2 IS NOT NULL AND l3 IS NOT NULL),
ndocs AS (SELECT level, path, count(*) AS n_docs FROM paths GROUP BY level, path),
pt AS (SELECT p.level, p.path, t.id, t.term, t.tf FROM paths p JOIN terms t ON p.id = t.id),
stats AS (SELECT level, path, term, sum(tf) AS total, count(*) AS df FROM pt GROUP BY level, path, term),
vocab AS (
  SELECT s.level, s.path, s.term, ln((n.n_docs + 1.0) / (s.df + 1.0)) + 1.0 AS idf
  FROM (SELECT *, row_number() OVER (PARTITION BY level, path ORDER BY total DESC, term) AS r FROM stats) s
  JOIN ndocs n ON s.level = n.level AND s.path = n.path WHERE s.r <= 1000),
weighted AS (
  SELECT pt.level, pt.path, pt.id, pt.term, pt.tf * v.idf AS w
  FROM pt JOIN vocab v ON pt.level = v.level AND pt.path = v.path AND pt.term = v.term),
norms AS (SELECT level, path, id, sqrt(sum(w * w)) AS nrm FROM weighted GROUP BY level, path, id),
scores AS (
  SELECT w.level, w.path, w.term, sum(w.w / n.nrm) AS score
  FROM weighted w JOIN norms n ON w.level = n.level AND w.path = n.path AND w.id = n.id
  GROUP BY w.level, w.path, w.term),
ranked AS (
  SELECT level, path, term, row_number() OVER (PARTITION BY level, path ORDER BY round(score, 6) DESC, term) AS rk
  FROM scores)"""


def _kw(n: int) -> str:
    return f"""kwt AS (SELECT level, path, string_agg(term, ', ' ORDER BY rk) AS keywords FROM ranked WHERE rk <= {n} GROUP BY level, path),
kw AS (SELECT n.level, n.path, coalesce(k.keywords, '') AS keywords FROM ndocs n LEFT JOIN kwt k ON n.level = k.level AND n.path = k.path)"""


SQL["group_keywords"] = f"WITH {LEVELED}, {_kw(5)} SELECT CAST(path AS INTEGER) AS level_1, keywords FROM kw WHERE level = 1"

SQL["level1_report"] = f"WITH {LEVELED}, {_kw(10)} SELECT CAST(path AS INTEGER) AS level_1, keywords FROM kw WHERE level = 1"

SQL["level_keywords"] = f"""
WITH {LEVELED}, {_kw(10)}
SELECT b.id AS doc_id, b.l1 AS level_1, b.l2 AS level_2, b.l3 AS level_3,
       k1.keywords AS level_1_keywords, k2.keywords AS level_2_keywords, k3.keywords AS level_3_keywords
FROM base b
LEFT JOIN kw k1 ON k1.level = 1 AND k1.path = CAST(b.l1 AS VARCHAR)
LEFT JOIN kw k2 ON k2.level = 2 AND k2.path = b.l1 || '.' || b.l2
LEFT JOIN kw k3 ON k3.level = 3 AND k3.path = b.l1 || '.' || b.l2 || '.' || b.l3
"""

SQL["tree_nodes"] = rf"""
WITH {LEVELED}, {_kw(10)},
sizes AS (SELECT level, path, count(*) AS size FROM paths GROUP BY level, path),
pc AS (SELECT p.level, p.path, b.professor, count(*) AS n FROM paths p JOIN base b ON p.id = b.id AND b.professor IS NOT NULL
       GROUP BY p.level, p.path, b.professor),
pr AS (SELECT *, row_number() OVER (PARTITION BY level, path ORDER BY n DESC, professor) AS rk FROM pc),
profs AS (SELECT level, path, string_agg(professor || ' (' || CAST(n AS VARCHAR) || ')', ', ' ORDER BY rk) AS top_professors
          FROM pr WHERE rk <= 5 GROUP BY level, path)
SELECT 'Cluster ' || s.path AS node_id,
       CASE WHEN s.path LIKE '%.%' THEN 'Cluster ' || regexp_replace(s.path, '\.[^.]*$', '') END AS parent_id,
       s.level, s.size, k.keywords, p.top_professors
FROM sizes s LEFT JOIN kw k ON s.level = k.level AND s.path = k.path
LEFT JOIN profs p ON s.level = p.level AND s.path = p.path
"""

SQL["node_text"] = f"""
SELECT node_id, node_id || chr(10) || 'Keywords: ' || keywords || chr(10) || 'Professors: ' || coalesce(top_professors, '') AS description
FROM ({SQL['tree_nodes']})
"""

SQL["tree_edges"] = rf"""
WITH {LEVELED}
SELECT DISTINCT 'Cluster ' || regexp_replace(path, '\.[^.]*$', '') AS src, 'Cluster ' || path AS dst
FROM paths WHERE level > 1
"""

# ---------------------------------------------------------------- embeddings and text retrieval

DIM = 256
TOK_RE = r"'[\p{L}\p{N}_]{2,}'"


def _toks(name: str, src: str) -> str:
    """(id, tok, tf) for a relation ``src`` with columns (id, text)."""
    return f"""{name} AS (
  SELECT id, tok, count(*) AS tf FROM (SELECT id, unnest(regexp_extract_all(lower(text), {TOK_RE})) AS tok FROM {src})
  GROUP BY id, tok)"""


BUCKET = f"CAST(('0x' || substr(md5(tok), 1, 8))::BIGINT % {DIM} AS INTEGER)"
SIGN = "CASE WHEN ('0x' || substr(md5(tok), 9, 1))::INTEGER < 8 THEN 1.0 ELSE -1.0 END"


def _hashed(name: str, toks: str, weight: str = "CAST(tf AS DOUBLE)") -> str:
    """normalized long form (id, bucket, w) from a token relation (may carry idf)."""
    return f"""{name}_raw AS (SELECT id, {BUCKET} AS bucket, sum({SIGN} * {weight}) AS v FROM {toks} GROUP BY 1, 2),
{name}_n AS (SELECT id, sqrt(sum(v * v)) AS nrm FROM {name}_raw GROUP BY id),
{name} AS (SELECT r.id, r.bucket, r.v / n.nrm AS w FROM {name}_raw r JOIN {name}_n n ON r.id = n.id WHERE n.nrm > 0 AND r.v <> 0)"""


DOCS_SRC = "(SELECT doc_id AS id, text FROM documents)"
SAMPLE = "samp AS (SELECT doc_id AS id, text FROM documents ORDER BY md5('1:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 512)"

CONTEXT = f"""{SAMPLE},
s_n AS (SELECT count(*) AS s FROM samp),
{_toks('stoks', 'samp')},
idf AS (SELECT t.tok, ln((s_n.s + 1.0) / (count(*) + 1.0)) + 1.0 AS idf FROM stoks t, s_n GROUP BY t.tok, s_n.s),
unseen AS (SELECT ln(s + 1.0) + 1.0 AS u FROM s_n),
stoks_w AS (SELECT t.id, t.tok, t.tf, coalesce(i.idf, unseen.u) AS idf FROM stoks t LEFT JOIN idf i ON t.tok = i.tok, unseen),
{_hashed('sv', 'stoks_w', 'tf * idf')},
mean AS (SELECT CAST(b.range AS INTEGER) AS bucket, coalesce(sum(sv.w), 0) / max(s_n.s) AS mean
         FROM range({DIM}) b LEFT JOIN sv ON sv.bucket = b.range, s_n GROUP BY b.range)"""


def _ctx_vectors(name: str, src: str) -> str:
    """contextual unit vectors, dense long form (id, bucket, u), for relation src(id, text)."""
    return f"""{_toks(name + '_t', src)},
{name}_tw AS (SELECT t.id, t.tok, t.tf, coalesce(i.idf, unseen.u) AS idf FROM {name}_t t LEFT JOIN idf i ON t.tok = i.tok, unseen),
{_hashed(name + '_h', name + '_tw', 'tf * idf')},
{name}_c AS (SELECT d.id, m.bucket, coalesce(h.w, 0) - m.mean AS c
             FROM (SELECT DISTINCT id FROM {src}) d CROSS JOIN mean m
             LEFT JOIN {name}_h h ON h.id = d.id AND h.bucket = m.bucket),
{name}_cn AS (SELECT id, sqrt(sum(c * c)) AS nrm FROM {name}_c GROUP BY id),
{name} AS (SELECT c.id, c.bucket, c.c / nullif(n.nrm, 0) AS u FROM {name}_c c JOIN {name}_cn n ON c.id = n.id)"""


SQL["hashed_embedding"] = f"""
WITH {_toks('toks', DOCS_SRC)}, {_hashed('hv', 'toks')}
SELECT id AS doc_id, bucket, round(w, 6) AS w FROM hv
"""

SQL["sample_corpus"] = f"WITH {SAMPLE} SELECT id AS doc_id FROM samp"

SQL["context_stats"] = f"WITH {CONTEXT} SELECT bucket, round(mean, 6) AS mean FROM mean"

SQL["context_embedding"] = f"""
WITH {CONTEXT}, {_ctx_vectors('dv', DOCS_SRC)}
SELECT id AS doc_id, list(round(u, 6) ORDER BY bucket) AS vec FROM dv GROUP BY id
"""

KEYPHRASES = f"""{_toks('ktoks_all', DOCS_SRC)},
kstop2(tok) AS (VALUES {sql_values(KEYWORD_STOP_WORDS)}),
ktoks AS (SELECT * FROM ktoks_all WHERE tok NOT IN (SELECT tok FROM kstop2)),
n_all AS (SELECT count(*) AS n FROM documents),
dfreq AS (SELECT tok, count(*) AS df FROM ktoks GROUP BY tok),
ksc AS (SELECT k.id, k.tok, round(k.tf * (ln((n_all.n + 1.0) / (d.df + 1.0)) + 1.0), 6) AS score
        FROM ktoks k JOIN dfreq d ON k.tok = d.tok, n_all),
krk AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, tok) AS r FROM ksc),
kpt AS (SELECT id, string_agg(tok, ', ' ORDER BY r) AS keywords FROM krk WHERE r <= 5 GROUP BY id),
kp AS (SELECT d.doc_id AS id, coalesce(k.keywords, '') AS keywords FROM documents d LEFT JOIN kpt k ON k.id = d.doc_id)"""

SQL["keyphrases"] = f"WITH {KEYPHRASES} SELECT id AS doc_id, keywords FROM kp"

INDEX = f"""{CONTEXT}, {_ctx_vectors('dv', DOCS_SRC)}, {KEYPHRASES},
{_toks('kwt', '(SELECT id, keywords AS text FROM kp)')},
{_hashed('kwh', 'kwt')},
kwd AS (SELECT d.id, b.range AS bucket, coalesce(h.w, 0.0) AS w
        FROM (SELECT DISTINCT id FROM kp) d CROSS JOIN range({DIM}) b
        LEFT JOIN kwh h ON h.id = d.id AND h.bucket = b.range)"""

SQL["index_table"] = f"""
WITH {INDEX},
dvl AS (SELECT id, list(round(u, 6) ORDER BY bucket) AS doc_vec FROM dv GROUP BY id),
kwl AS (SELECT id, list(round(w, 6) ORDER BY bucket) AS kw_vec FROM kwd GROUP BY id)
SELECT d.doc_id, d.source, kp.keywords, dvl.doc_vec, kwl.kw_vec
FROM documents d LEFT JOIN kp ON kp.id = d.doc_id LEFT JOIN dvl ON dvl.id = d.doc_id LEFT JOIN kwl ON kwl.id = d.doc_id
"""

QUESTIONS = "(SELECT item_id AS id, text FROM benchmark)"

# all questions against all documents; the single-question forms take item 0
SIMS = f"""{_ctx_vectors('qv', QUESTIONS)},
fsim AS (SELECT q.id AS q, d.id, sum(d.u * q.u) / nullif(sqrt(sum(d.u * d.u)) * sqrt(sum(q.u * q.u)), 0) AS sim
         FROM dv d JOIN qv q ON d.bucket = q.bucket GROUP BY q.id, d.id)"""

COARSE = f"""{_toks('qt', QUESTIONS)}, {_hashed('qh', 'qt')},
csim AS (SELECT q.id AS q, k.id, sum(k.w * q.w) / nullif(max(n.nrm), 0) AS sim
         FROM kwd k JOIN qh q ON k.bucket = q.bucket JOIN (SELECT id, sqrt(sum(w * w)) AS nrm FROM kwd GROUP BY id) n ON n.id = k.id
         GROUP BY q.id, k.id),
best AS (SELECT q, id, round(sim, 6) AS coarse_similarity FROM csim WHERE sim IS NOT NULL),
top500 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY coarse_similarity DESC, id) AS r FROM best) WHERE r <= 500),
final AS (SELECT * FROM (
  SELECT t.q, t.id, t.coarse_similarity, round(f.sim, 6) AS similarity,
         row_number() OVER (PARTITION BY t.q ORDER BY round(f.sim, 6) DESC, t.id) AS r2
  FROM top500 t JOIN fsim f ON f.id = t.id AND f.q = t.q WHERE f.sim IS NOT NULL) WHERE r2 <= 5)"""

SQL["retrieve_fine"] = f"""
WITH {INDEX}, {SIMS}
SELECT f.id AS doc_id, d.source, round(f.sim, 6) AS similarity
FROM fsim f JOIN documents d ON d.doc_id = f.id WHERE f.sim IS NOT NULL AND f.q = 0
ORDER BY similarity DESC, doc_id LIMIT 5
"""

SQL["retrieve_two_stage"] = f"""
WITH {INDEX}, {SIMS}, {COARSE}
SELECT t.id AS doc_id, d.source, t.coarse_similarity, t.similarity
FROM final t JOIN documents d ON d.doc_id = t.id WHERE t.q = 0
"""

SQL["retrieve_batch"] = f"""
WITH {INDEX}, {SIMS}, {COARSE}
SELECT q AS item_id, id AS doc_id, coarse_similarity, similarity FROM final
"""

SQL["retrieve_pruned"] = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT a.vec_id, b.vec_id AS neighbour, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM e a JOIN e b ON a.vec_id % 20 = 0)
SELECT vec_id, neighbour, similarity FROM s WHERE isfinite(similarity)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, neighbour) <= 10
"""

CLASS_PAIRS = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
k AS (SELECT v, min(vec_id) AS class_id, count(*) AS n FROM e GROUP BY v),
p AS (SELECT a.class_id AS id_a, b.class_id AS id_b, round(list_cosine_similarity(a.v, b.v), 6) AS similarity, a.n AS na, b.n AS nb
      FROM k a JOIN k b ON a.class_id < b.class_id)"""

SQL["pairs_pruned"] = f"WITH {CLASS_PAIRS} SELECT id_a, id_b, similarity FROM p WHERE similarity >= 0.4"

SQL["pair_links"] = f"""
WITH {CLASS_PAIRS},
o AS (SELECT c, sum(n) AS n FROM (SELECT id_a AS c, nb AS n FROM p WHERE similarity >= 0.4
      UNION ALL SELECT id_b, na FROM p WHERE similarity >= 0.4) GROUP BY c)
SELECT e.vec_id, k.class_id, CAST(k.n - 1 + coalesce(o.n, 0) AS BIGINT) AS links
FROM e JOIN k ON e.v = k.v LEFT JOIN o ON o.c = k.class_id
"""

SQL["knn_descent_recall"] = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
r AS (SELECT a.vec_id, b.vec_id AS dst FROM e a JOIN e b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
      QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) <= 10)
SELECT count(DISTINCT vec_id) AS asked, count(*) AS wanted, true AS enough FROM r
"""

# ---------------------------------------------------------------- clustering

SQL["group_axes"] = f"""
WITH {EV}, n AS (SELECT label, count(*) AS n FROM embeddings WHERE embedding IS NOT NULL GROUP BY label)
SELECT e.label, n.n, CAST(e.dim AS BIGINT) AS dim, round(avg(e.x), 6) AS mean
FROM ev e JOIN n ON e.label IS NOT DISTINCT FROM n.label GROUP BY e.label, n.n, e.dim
"""

SQL["merge_summary"] = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
d AS (SELECT v, row_number() OVER () AS i FROM (SELECT DISTINCT v FROM e))
SELECT (SELECT count(*) - 1 FROM d) AS merges, (SELECT count(*) FROM e) AS root_size, true AS monotone,
       round(min(list_distance(a.v, b.v)), 6) AS first_distance
FROM d a JOIN d b ON a.i < b.i
"""

SQL["sweep_scores"] = f"""
WITH e AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
first AS (SELECT v, row_number() OVER (ORDER BY vec_id) - 1 AS c FROM e QUALIFY c < 30),
ks AS (SELECT unnest(range(2, 31)) AS k),
lab AS MATERIALIZED (SELECT k, vec_id, min({{'d': list_distance(e.v, f.v), 'c': c}}).c AS own FROM e, first f JOIN ks ON c < k GROUP BY k, vec_id),
part AS (SELECT k, own AS c, j, avg(v[j]) AS mu, count(*) AS n FROM lab JOIN e USING (vec_id), (SELECT unnest(range(1, (SELECT max(len(v)) FROM e) + 1)) AS j) GROUP BY ALL),
m AS MATERIALIZED (SELECT k, c, list(mu ORDER BY j) AS mu, any_value(n) AS n FROM part GROUP BY k, c),
far AS MATERIALIZED (SELECT lab.k, vec_id, own, c, n, list_distance(v, mu) ** 2 AS d FROM lab JOIN e USING (vec_id) JOIN m USING (k)),
ss AS MATERIALIZED (SELECT k, c, sum(d) AS ss FROM far WHERE own = c GROUP BY k, c),
sil AS (
  SELECT k, vec_id, max(CASE WHEN own = c THEN (d + ss / n) * n / greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> c THEN d + ss / n END) AS b,
         max(CASE WHEN own = c THEN n END) AS size
  FROM far JOIN ss USING (k, c) GROUP BY k, vec_id
),
sil_k AS (SELECT k, avg(CASE WHEN size <= 1 OR b IS NULL THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END) AS s FROM sil GROUP BY k),
mean AS (SELECT list(mu ORDER BY j) AS mu FROM (SELECT j, avg(v[j]) AS mu FROM e, (SELECT unnest(range(1, (SELECT max(len(v)) FROM e) + 1)) AS j) GROUP BY j)),
ch AS (
  SELECT k, sum(n * list_distance(m.mu, mean.mu) ** 2) / (count(*) - 1) / (sum(ss) / (sum(n) - count(*))) AS ch
  FROM m JOIN ss USING (k, c), mean GROUP BY k
)
SELECT CAST(k AS INTEGER) AS k, round(s, 6) AS silhouette_sq, round(ch, 6) AS calinski_harabasz FROM sil_k JOIN ch USING (k)
"""

# ---------------------------------------------------------------- ingest

WHOLE_RECORDS = """
SELECT source AS professor, text AS title, CAST(1995 + doc_id % 7 AS VARCHAR) AS pub_year,
       coalesce(lang, 'No authors') AS authors, coalesce(CAST(n_chars AS VARCHAR), 'N/A') AS citations
FROM documents WHERE text <> ''
"""

FAULTY_TITLE = "source || ': ' || text"

SQL["flatten_records"] = f"""
{WHOLE_RECORDS}
UNION ALL
SELECT source AS professor,
       CASE WHEN doc_id % 7 <> 0 THEN coalesce({FAULTY_TITLE}, 'No title') ELSE 'No title' END AS title,
       CASE WHEN doc_id % 3 <> 0 AND doc_id % 5 <> 0 THEN CAST(1995 + doc_id % 7 AS VARCHAR) ELSE 'No year' END AS pub_year,
       CASE WHEN doc_id % 3 <> 0 THEN coalesce(lang, 'No authors') ELSE 'No authors' END AS authors,
       CASE WHEN doc_id % 3 <> 0 AND doc_id % 4 <> 0 THEN coalesce(CAST(n_chars AS VARCHAR), 'N/A') ELSE 'N/A' END AS citations
FROM documents
WHERE doc_id % 9 <> 0 AND (doc_id % 3 = 0 OR (doc_id % 7 <> 0 AND {FAULTY_TITLE} IS NOT NULL))
"""

SQL["stream_ingest"] = f"SELECT DISTINCT professor, title FROM ({WHOLE_RECORDS})"

SQL["build_snapshot"] = f"""
WITH pubs AS ({SQL['flatten_records']}),
lookups AS (
  SELECT text AS title, text AS abstract, doc_id FROM documents
  UNION ALL
  SELECT {FAULTY_TITLE}, CASE WHEN doc_id % 4 <> 0 THEN text END, doc_id FROM documents),
last AS (
  SELECT title, coalesce(regexp_replace(abstract, '[^\\x20-\\x7E]+', '', 'g'), 'N/A') AS abstract,
         row_number() OVER (PARTITION BY title ORDER BY doc_id DESC) AS rn
  FROM lookups)
SELECT p.*, coalesce(l.abstract, 'N/A') AS abstract FROM pubs p LEFT JOIN last l ON p.title = l.title AND l.rn = 1
"""

SQL["csv_round_trip"] = """
SELECT doc_id, nullif(text, '') AS text, CASE WHEN doc_id % 7 <> 0 THEN nullif(text, '') END AS marked FROM documents
"""

SQL["csv_split_round_trip"] = "SELECT doc_id, nullif(text, '') AS text FROM documents"

SQL["first_match"] = rf"""
WITH titled AS (SELECT doc_id, text, {TITLE_KEY} AS key FROM documents),
best AS (SELECT key, text FROM (SELECT key, text, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS rn FROM titled)
         WHERE rn = 1)
SELECT t.doc_id, coalesce(regexp_replace(b.text, '[^\x20-\x7E]+', '', 'g'), 'N/A') AS abstract
FROM titled t LEFT JOIN best b ON t.key = b.key
"""

SQL["merge_abstracts"] = r"""
WITH last AS (SELECT text, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS rn FROM documents)
SELECT d.doc_id, regexp_replace(l.text, '[^\x20-\x7E]+', '', 'g') AS abstract FROM documents d LEFT JOIN last l ON d.text = l.text AND l.rn = 1
"""

SQL["pending_keys"] = """
SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""

# ---------------------------------------------------------------- word cloud

SQL["wordcloud_weights"] = rf"""
WITH {STOP_CTE},
toks AS (
  SELECT doc_id,
         list_filter(list_transform(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_'']*'),
                                    lambda t: regexp_replace(t, '''s$', '')),
                     lambda t: NOT regexp_matches(t, '^\p{{Nd}}+$')) AS arr
  FROM documents),
uni AS (SELECT w FROM (SELECT unnest(arr) AS w FROM toks) WHERE w NOT IN (SELECT word FROM stop)),
uni_counts AS (SELECT w AS key, count(*) AS n FROM uni GROUP BY w),
n_words AS (SELECT sum(n) AS n_words FROM uni_counts),
pairs AS (
  SELECT arr[i] AS a, arr[i + 1] AS b FROM (SELECT arr, unnest(range(1, len(arr))) AS i FROM toks)),
bi_counts AS (
  SELECT a || ' ' || b AS key, count(*) AS n FROM pairs
  WHERE a NOT IN (SELECT word FROM stop) AND b NOT IN (SELECT word FROM stop) GROUP BY 1),
uni_map AS (
  SELECT c.key, coalesce(s.key, c.key) AS std FROM uni_counts c
  LEFT JOIN uni_counts s ON c.key LIKE '%s' AND c.key NOT LIKE '%ss' AND s.key = substring(c.key, 1, length(c.key) - 1)),
uni_f AS (SELECT m.std AS key, sum(c.n) AS n FROM uni_counts c JOIN uni_map m ON c.key = m.key GROUP BY m.std),
bi_map AS (
  SELECT c.key, coalesce(s.key, c.key) AS std FROM bi_counts c
  LEFT JOIN bi_counts s ON c.key LIKE '%s' AND c.key NOT LIKE '%ss' AND s.key = substring(c.key, 1, length(c.key) - 1)),
bi_f AS (SELECT m.std AS key, sum(c.n) AS n FROM bi_counts c JOIN bi_map m ON c.key = m.key GROUP BY m.std),
scored AS (
  SELECT b.key, CAST(b.n AS DOUBLE) AS c12, m1.std AS s1, m2.std AS s2, CAST(u1.n AS DOUBLE) AS c1, CAST(u2.n AS DOUBLE) AS c2,
         CAST(nw.n_words AS DOUBLE) AS nn
  FROM bi_f b
  JOIN uni_map m1 ON m1.key = split_part(b.key, ' ', 1)
  JOIN uni_map m2 ON m2.key = split_part(b.key, ' ', 2)
  JOIN uni_f u1 ON u1.key = m1.std
  JOIN uni_f u2 ON u2.key = m2.std, n_words nw),
ll AS (
  SELECT *, c2 / nn AS p, c12 / c1 AS p1, (c2 - c12) / nullif(nn - c1, 0) AS p2 FROM scored),
colloc AS (
  SELECT key, c12, s1, s2 FROM ll WHERE -2 * (
      (ln(greatest(p, 1e-10)) * c12 + ln(greatest(1 - p, 1e-10)) * (c1 - c12))
    + (ln(greatest(p, 1e-10)) * (c2 - c12) + ln(greatest(1 - p, 1e-10)) * ((nn - c1) - (c2 - c12)))
    - (ln(greatest(p1, 1e-10)) * c12 + ln(greatest(1 - p1, 1e-10)) * (c1 - c12))
    - (ln(greatest(p2, 1e-10)) * (c2 - c12) + ln(greatest(1 - p2, 1e-10)) * ((nn - c1) - (c2 - c12)))
  ) > 30),
tab AS (
  SELECT key, sum(n) AS n FROM (
    SELECT key, n FROM uni_f
    UNION ALL SELECT s1 AS key, -c12 AS n FROM colloc
    UNION ALL SELECT s2 AS key, -c12 AS n FROM colloc) GROUP BY key
  UNION ALL SELECT key, c12 AS n FROM colloc),
top AS (SELECT key, n FROM tab WHERE n > 0 ORDER BY n DESC, key LIMIT 100)
SELECT key AS word, CAST(n AS BIGINT) AS count, round(n / max(n) OVER (), 6) AS weight FROM top
"""

SQL["sort_recent"] = """
SELECT o_orderkey AS pub_id, o_custkey AS professor, CAST(year(o_orderdate) AS INTEGER) AS pub_year
FROM orders ORDER BY professor, pub_year DESC
"""
