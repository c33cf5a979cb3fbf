import pytest

from tessera.llm import common, langid, licenses, quality, toxicity, urlgraph

DOC = "doc_id long, text string, "


def check(found, added, kept):
    """No name is doubled, and the clashing columns hold the results."""
    names = [c.lower() for c in found.columns]
    assert len(set(names)) == len(names) and set(added) | set(kept) <= set(names)
    rows = found.select(*added, *kept).collect()
    assert all(r[a] != "old" for r in rows for a in added) and all(r[k] == "kept" for r in rows for k in kept)


def docs(spark, names):
    rows = [(k, "some plain words to read here", *["old"] * len(names), "kept") for k in range(4)]
    return spark.createDataFrame(rows, DOC + ", ".join(f"{n} string" for n in names) + ", other string")


def labels(spark, name):
    return spark.createDataFrame([(0, 1), (1, 0), (2, 0)], f"doc_id long, {name} int")


def test_licenses(spark):
    check(licenses.scan(docs(spark, ["N_words", "spans"])), ["n_words", "spans"], ["other"])


def test_language(spark):
    table = docs(spark, ["Score", "lang_pred", "languages"]).withColumnRenamed("other", "lang")
    model = langid.fit(table)
    check(langid.predict(table.withColumnRenamed("lang", "other"), model), ["lang_pred", "score", "languages"], ["other"])


@pytest.mark.parametrize("operator, label, out", [(quality, "quality", "attention"), (toxicity, "toxic", "passages")])
def test_classifiers(spark, operator, label, out):
    table = docs(spark, ["score", out.upper()])
    model = operator.fit(table, labels(spark, label), label)
    check(operator.predict(table, model), ["score", out], ["other"])


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "", "old", "old", "kept")], "page_id long, url string, html string, Verdict string, trust string, other string")
    rules = spark.createDataFrame([("allow", "com", "/")], "verdict string, host string, path string")
    check(urlgraph.judge(pages, rules), ["verdict", "trust", "url_host"], ["other"])


def test_contradicting_labels_count_as_one(spark):
    rows = [(1, 1), (1, 0), (2, 0), (2, 0), (3, 1), (None, 1), (4, 7), (5, 0), (5, 1)]
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "doc_id long, y int")
        assert {r.id: r.y for r in common.known_labels(table, "y").collect()} == {1: 1, 2: 0, 3: 1, 5: 1}
        assert common.class_counts(table, "y") == {0: 1, 1: 3}


MIT = next(m for m, label in licenses.TEMPLATES if label == "mit-text")


def filled(markup):
    text = licenses._MARK.sub(lambda m: " the authors " if m[1].startswith("var") else " ", markup)
    return "Copyright someone. " + text + ". The end"


@pytest.mark.parametrize("label", ["mit-text", "isc-text", "bsd-2-clause", "bsd-3-clause", "unlicense"])
def test_altered_and_truncated_texts_are_refused(spark, label):
    whole = filled(next(m for m, x in licenses.TEMPLATES if x == label))
    words = whole.split()
    altered = whole.replace(" the software ", " the softwares ", 1).replace(" this software ", " this ware ", 1).replace("SOFTWARE", "SOFTWARES", 1)
    texts = [whole, " ".join(words[: len(words) // 2]) + " but only on Tuesdays", altered, whole.replace("DAMAGES", "all damages", 1)]
    found = licenses.summary(licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).orderBy("doc_id").collect()
    assert [label in r.labels.split(",") for r in found] == [True, False, False, False]
    assert [r.score for r in found] == [1.0, 0.0, 0.0, 0.0]
