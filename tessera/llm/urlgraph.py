"""URL filters with link-graph propagation.

Rules judge urls by host (with all subdomains) and path prefix; the longest
wins. For urls without a rule the link graph between hosts decides:
personalised PageRank carries trust from hosts whose pages rules allow along
the links, and distrust from hosts whose pages rules block against them (who
links to blocked hosts is suspect). A host is blocked where its distrust is
above its trust and reaches ``threshold`` of what a host has whose own pages
are all blocked. All of it is DataFrame joins and sums over distinct host pairs;
each few rounds' scores are a written table.

Defined cases: a null url or one without ``://`` has an empty host and path, fits
no rule, and is allowed unless its (empty) host is not; null html has no links.
Links without a host of their own, and links of a host to itself, do not count.
Rules of equal length: the longer host wins, then block. Repeated or null ids
are judged by their url like any other. Extra columns are kept; one that is named
like a result column (in any case) gives way to it. Empty tables
give empty results; without rules all is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_small, lower_ascii, stored

DAMPING, ROUNDS, THRESHOLD = 0.85, 20, 0.5
#: Rounds between written tables.
KEEP_EVERY = 4
#: Absolute or scheme-relative link targets in HTML.
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower case."""
    after = F.substring(url, F.length(F.substring_index(url, "://", 1)) + 4, F.lit(1 << 30))
    return F.when(F.locate("://", url) > 0, lower_ascii(F.regexp_extract(after, "^[^/?#]*", 0))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    after = F.substring(url, F.length(F.substring_index(url, "://", 1)) + 4, F.lit(1 << 30))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and the domains above it."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules that fit each host (column ``host``, distinct), longest first.

    rules: host, path, verdict ('allow' or 'block')."""
    r = rules.select(lower_ascii(F.col("host")).alias("suffix"), F.col("path").alias("rule_path"), "verdict")
    fit = join_small(hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("suffix")), r, "suffix")
    rule = F.struct(
        (-F.length(F.concat("suffix", "rule_path"))).alias("order"),
        (-F.length("suffix")).alias("order2"),
        (F.col("verdict") != "block").alias("order3"),
        F.concat("suffix", "rule_path").alias("rule"),
        F.col("rule_path").alias("path"),
        "verdict",
    )
    return fit.groupBy("host").agg(F.sort_array(F.collect_list(rule)).alias("rules"))


def links(pages: DataFrame, host: Column, html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts."""
    target = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1))
    each = pages.select(host.alias("src"), F.explode(target).alias("dst")).select("src", lower_ascii(F.col("dst")).alias("dst"))
    return each.where("src <> dst and src <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` of personalised PageRank: trust
    along the edges (src, dst, n), distrust against them. seeds: host, trust,
    distrust in 0..1. Hosts that only links name take part."""
    start = seeds.select("host", (F.col("trust") * (1 - damping)).alias("trust"), (F.col("distrust") * (1 - damping)).alias("distrust"))
    if edges.limit(1).count() == 0:
        return start
    out, into = edges.groupBy("src").agg(F.sum("n").alias("out_n")), edges.groupBy("dst").agg(F.sum("n").alias("in_n"))
    shares = stored(edges.join(out, "src").join(into, "dst").select("src", "dst", (F.col("n") / F.col("out_n")).alias("on"), (F.col("n") / F.col("in_n")).alias("back")), "edges")
    start = stored(start, "seeds")
    state = start
    for k in range(1, rounds + 1):
        trust = shares.join(state.select(F.col("host").alias("src"), "trust"), "src").where("trust > 0")
        distrust = shares.join(state.select(F.col("host").alias("dst"), "distrust"), "dst").where("distrust > 0")
        moved = trust.select(F.col("dst").alias("host"), (F.col("trust") * F.col("on") * damping).alias("trust"), F.lit(0.0).alias("distrust")).unionByName(
            distrust.select(F.col("src").alias("host"), F.lit(0.0).alias("trust"), (F.col("distrust") * F.col("back") * damping).alias("distrust"))
        )
        state = start.unionByName(moved).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if k % KEEP_EVERY == 0 or k == rounds:
            state = stored(state, "scores")
    return state


#: Columns that ``judge`` adds; a column of the pages that is named like one gives way to it.
ADDED = ("url_host", "url_path", "rule", "verdict", "trust", "distrust")


def judge(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", html_col: str = "html", damping: float = DAMPING, rounds: int = ROUNDS, threshold: float = THRESHOLD
) -> DataFrame:
    """All columns of ``pages`` but ``html_col`` with url_host, url_path, rule
    (null where none fits), verdict, trust and distrust of the host."""
    at = {c: f"c{k}" for k, c in enumerate(pages.columns)}
    plain = pages.toDF(*at.values())
    url = F.coalesce(F.col(at[url_col]).cast("string"), F.lit(""))
    rows = plain.drop(at[html_col]).withColumn("host", host_of(url)).withColumn("path", path_of(url))
    known = stored(host_rules(rows.select("host").distinct(), rules), "rules")
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["path"]))
    ruled = join_small(rows, known, "host", "left").withColumn("fit", F.try_element_at(fits, F.lit(1)))
    count = lambda v: F.avg(F.coalesce(F.col("fit.verdict") == v, F.lit(False)).cast("double"))
    seeds = stored(ruled.groupBy("host").agg(count("allow").alias("trust"), count("block").alias("distrust")), "seeds")
    edges = stored(links(plain.select(url.alias("u"), F.col(at[html_col]).alias("html")), host_of(F.col("u"))), "links")
    score = stored(propagate(seeds, edges, damping, rounds), "scores")
    own = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= threshold * (1 - damping))
    found = join_small(ruled, score, "host", "left")
    return found.select(
        *(F.col(c).alias(name) for name, c in at.items() if name != html_col and name.lower() not in ADDED),
        F.col("host").alias("url_host"),
        F.col("path").alias("url_path"),
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(own, "block").otherwise("allow")).alias("verdict"),
        "trust",
        "distrust",
    )
