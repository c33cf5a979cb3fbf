import collections
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, urlgraph

RULES = queries.URL_RULES


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path, rules):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), default=None)


def brute(pages, rules, damping=urlgraph.DAMPING, rounds=urlgraph.ROUNDS, threshold=urlgraph.THRESHOLD):
    at = [split(u) for _, u, _ in pages]
    rule = [rule_of(h, p, rules) for h, p in at]
    by_host = collections.defaultdict(list)
    for (h, _), r in zip(at, rule):
        by_host[h].append(r and r[0])
    n = collections.Counter()
    for (h, _), (_, _, html) in zip(at, pages):
        for dst in re.findall(urlgraph.LINK, html or ""):
            if h and lower(dst) != h:
                n[h, lower(dst)] += 1
    hosts = set(by_host) | {x for e in n for x in e}
    start = {h: [(1 - damping) * by_host[h].count(v) / max(len(by_host[h]), 1) if h in by_host else 0.0 for v in ("allow", "block")] for h in hosts}
    out, into = collections.Counter(), collections.Counter()
    for (a, b), k in n.items():
        out[a] += k
        into[b] += k
    state = {h: list(v) for h, v in start.items()}
    for _ in range(rounds):
        new = {h: list(v) for h, v in start.items()}
        for (a, b), k in n.items():
            new[b][0] += damping * state[a][0] * k / out[a]
            new[a][1] += damping * state[b][1] * k / into[b]
        state = new
    res = []
    for (i, _, _), (h, p), r in zip(pages, at, rule):
        t, b = state[h]
        res.append((i, h, p, r and r[1] + r[2], r[0] if r else "block" if b > t and b >= threshold * (1 - damping) else "allow"))
    return sorted(res, key=repr), state


@pytest.fixture(scope="module")
def pages():
    rnd = random.Random(2)
    hosts = [f"{p}{n}.example.{t}" for p in ("", "www.", "Blog.") for n in ("a", "b", "c") for t in ("com", "net", "org")] + ["example.com", "www.example.com", "x.org", "y.org", "net"]
    rows = []
    for k in range(150):
        url = f"http{rnd.choice(['', 's'])}://{rnd.choice(hosts)}{rnd.choice(['', '/', '/en/1', '/es/2', '/fr/', '/es', '?q=/en/', '#x'])}"
        html = "".join(f"<a {rnd.choice(['href', 'HREF', 'href '])}={rnd.choice(QUOTES)}{rnd.choice(['http://', 'https://', '//'])}{rnd.choice(hosts)}/x'>" for _ in range(rnd.randint(0, 4)))
        rows.append((k, url, html + '<a href="/local">' if k % 5 else None))
    return rows + [(None, None, None), (900, "no scheme", "<a href='http://x.org/'>"), (901, "", ""), (902, "http://", None), (902, "http://HOST.ORG/A?b#c", ""), (902, "a://b://c/d", ""), (903, "x://é.net/es/ü", "")]


QUOTES = ['"', "'", ""]


@pytest.mark.parametrize("rules", [RULES, RULES + [("block", "b.example.org", "/"), ("allow", "y.org", ""), ("block", "x.org", "")], []])
def test_judgements_equal_brute_force(spark, pages, rules):
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, host int").repartition(3)
    r = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = urlgraph.judge(df, r)
    assert got.columns == ["page_id", "url", "host", "url_host", "url_path", "rule", "verdict", "trust", "distrust"]
    want, state = brute(pages, rules)
    rows = got.collect()
    assert sorted(((x.page_id, x.url_host, x.url_path, x.rule, x.verdict) for x in rows), key=repr) == want
    for x in rows:
        assert abs(x.trust - state[x.url_host][0]) < 1e-9 and abs(x.distrust - state[x.url_host][1]) < 1e-9
    if len(rules) > 5:  # the graph decides some without a rule
        assert {x.verdict for x in rows if x.rule is None} == {"allow", "block"}


def test_sql_says_the_same_on_linked_pages(spark, pages, tmp_path):
    rows = [p for p in pages if p[0] is not None and p[0] < 900]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    rel = con.sql(queries.SQL["op9_url_graph"])
    got = queries.REGISTRY["op9_url_graph"](spark, str(tmp_path))
    assert got.columns == rel.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rel.fetchall(), key=repr)


def test_empty_table(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").where(F.lit(False))
    assert urlgraph.judge(df, spark.createDataFrame(RULES, "verdict string, host string, path string")).count() == 0
