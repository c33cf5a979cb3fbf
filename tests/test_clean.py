from pyspark.sql import functions as F

from tessera.operators import clean, explore


def pubs(spark):
    rows = [
        (1, "p1", "No year", "a1", "N/A"),
        (2, "p1", "2019", "a1", "3"),
        (3, "p1", "2019", "a1", "5"),  # tie on year: lower id wins
        (4, "p1", None, "No authors", "1"),
        (5, "p2", "2001", "a2", "7"),
        (6, "p2", "2005", "a2", "2"),
    ]
    return spark.createDataFrame(rows, "pub_id int, professor string, year string, authors string, citations string")


def test_sentinels_coerce_keep_recent(spark):
    df = clean.null_sentinels(pubs(spark), {"year": ["No year"], "authors": ["No authors"], "citations": ["N/A"]})
    df = clean.coerce_numeric(df, "year", "int")
    df = clean.coerce_numeric(df, "citations", "int")
    assert df.filter(F.col("year").isNull()).count() == 2
    kept = clean.keep_recent(clean.drop_missing(df, "year"), ["professor", "authors"], "year", "pub_id")
    assert sorted(r["pub_id"] for r in kept.collect()) == [2, 6]


def test_keep_recent_nulls_last(spark):
    df = clean.null_sentinels(pubs(spark), {"year": ["No year"]})
    df = clean.coerce_numeric(df, "year", "int")
    kept = clean.keep_recent(df, ["professor"], "year", "pub_id")
    assert sorted(r["pub_id"] for r in kept.collect()) == [2, 6]


def test_audit_and_profiles(spark):
    df = clean.coerce_numeric(clean.null_sentinels(pubs(spark), {"year": ["No year"]}), "year", "int")
    audit = clean.clean_audit(df, year_col="year", keys=["professor", "authors"], is_english=F.col("pub_id") != 5).first()
    assert audit["rows_in"] == 6 and audit["dropped_language"] == 1
    assert audit["dropped_missing_year"] == 2 and audit["dropped_duplicates"] == 1 and audit["rows_out"] == 2
    nulls = {r["column"]: r["n_null"] for r in explore.null_counts(df).collect()}
    assert nulls["year"] == 2 and nulls["pub_id"] == 0
    assert explore.duplicate_rows(df, ["professor", "authors"]).first()[0] == 3


def test_describe_matches_pandas(spark):
    import pandas as pd

    vals = [1.0, 2.0, 2.0, 7.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = explore.describe(df).first()
    s = pd.Series(vals).describe()
    assert abs(d["mean"] - s["mean"]) < 1e-12 and abs(d["std"] - s["std"]) < 1e-12
    assert (d["p25"], d["p50"], d["p75"]) == (s["25%"], s["50%"], s["75%"])


def test_results_unchanged_by_repartition(spark):
    from tessera.operators import embed, keywords

    rows = [(i, f"alpha beta{i % 3} gamma{i % 5} delta", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, text string, g int")

    def snap(d):
        return sorted(tuple(r) for r in d.collect())

    for fn in (
        lambda d: keywords.group_keywords(d, "id", "text", "g", 3),
        lambda d: embed.sample_corpus(d, "id", 7).select("id"),
        lambda d: clean.keep_recent(d, ["g"], "id", "id"),
    ):
        assert snap(fn(df)) == snap(fn(df.repartition(5)))


def test_order_statistics_and_describe_are_exact(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    wide = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), [1e300, -1e300, np.nan, np.nan]])  # a hot value, far outliers
    whole = rng.integers(-5, 5, size=len(wide)).astype(float)
    df = spark.createDataFrame([(float(a), int(b), None) for a, b in zip(wide, whole)], "x double, y long, z double").repartition(6)
    got = {r["column"]: r for r in explore.describe(df).collect()}
    want = pd.DataFrame({"x": wide, "y": whole}).describe()
    for c in ("x", "y"):
        for ours, theirs in zip(("count", "min", "p25", "p50", "p75", "max"), ("count", "min", "25%", "50%", "75%", "max")):
            assert got[c][ours] == want[c][theirs], (c, ours)
    assert abs(got["y"]["mean"] - whole.mean()) < 1e-12 and abs(got["y"]["std"] - whole.std(ddof=1)) < 1e-9
    assert got["z"]["count"] == 0 and got["z"]["p50"] is None
    few = explore.order_statistics(df, ["x"], {0: {0, 17, 3100}}, [-1e300], [1e300], bins=3)
    ranked = np.sort(wide[~np.isnan(wide)])
    assert few == {(0, r): ranked[r] for r in (0, 17, 3100)}


def test_describe_of_no_rows(spark):
    got = explore.describe(spark.createDataFrame([], "x double")).collect()
    assert [(r["count"], r["p50"], r["max"]) for r in got] == [(0, None, None)]


def test_null_names_and_year_text(spark):
    df = spark.createDataFrame([("a", "2019.0"), (None, "2019"), (None, "nan"), ("a", "2019.5"), ("b", None)], "professor string, y string")
    assert [tuple(r) for r in explore.top_authors(df, "professor", 5).collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in explore.pubs_per_year(df, "y").collect()] == [(2019, 2)]
    assert [r["n"] for r in clean.coerce_numeric(df, "y", "int", "n").collect()] == [2019, 2019, None, None, None]
    assert [r["n"] for r in clean.coerce_numeric(df, "y", "double", "n").collect()] == [2019.0, 2019.0, None, 2019.5, None]


def test_written_table_and_counts_from_one_job(spark, tmp_path):
    df = clean.null_sentinels(pubs(spark), {"year": ["No year"], "authors": ["No authors"]})
    how = dict(id_col="pub_id", year_col="year", keys=["professor", "authors"], drop=["citations"])
    cases = {"all": (df, F.col("pub_id") != 5), "none_english": (df, F.lit(False)), "none_dated": (df.withColumn("year", F.lit(None).cast("string")), F.lit(True)),
             "empty": (df.filter("pub_id < 0"), F.lit(True)), "unknown": (df, F.lit(None).cast("boolean"))}
    for name, (rows, english) in cases.items():
        counts = clean.write_clean(rows, str(tmp_path / name), is_english=english, **how)
        audit = clean.clean_audit(rows, year_col="year", keys=["professor", "authors"], is_english=english).first().asDict()
        assert counts == {k: v or 0 for k, v in audit.items()}, name
        want = clean.clean_pipeline(rows, text_col="title", is_english=english, **how)
        assert sorted(map(repr, spark.read.parquet(str(tmp_path / name)).collect())) == sorted(map(repr, want.collect())), name


def test_trigrams_of_a_bounded_piece_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    from tessera.operators import language

    texts = ["the cat sat on the mat " * 3, None, "", "der hund", "x" * 50, "the dog and the cat"]
    column = pa.array(texts, pa.string())
    assert list(language._pieces(column, 20)) == [(0, 1), (1, 3), (4, 1), (5, 1)]
    assert list(language._pieces(column)) == [(0, 6)] and list(language._pieces(pa.array([], pa.string()))) == []
    monkeypatch.setattr(language, "PIECE_BYTES", 20)
    held, inner = [], language._batch_trigrams
    monkeypatch.setattr(language, "_batch_trigrams", lambda t: held.append(t.nbytes) or inner(t))
    batch = pa.record_batch([pa.array(["en", None, "en", "de", "en", "en"]), column], names=["lang", "s"])
    counts = {}
    for b in language._count_by_language([batch]):
        for r in b.to_pylist():
            counts[r["lang"], r["gram"]] = counts.get((r["lang"], r["gram"]), 0) + r["c"]
    want = {}
    for lang, t in zip(["en", None, "en", "de", "en", "en"], texts):
        for i in range(len(t or "") - 2):
            if t[i : i + 3] != "   ":
                key = lang, t[i : i + 3]
                want[key] = want.get(key, 0) + 1
    assert {(k, language.decode_gram(g)): c for (k, g), c in counts.items()} == want
    assert len(held) == 4
    rows = [r for b in language._count_by_row([pa.record_batch([pa.array(range(6)), column], names=["id", "s"])]) for r in b.to_pylist()]
    assert sum(r["c"] for r in rows if r["gram"] == language.TOTAL_ROW) == sum(want.values())
