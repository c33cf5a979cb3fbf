import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs.where(~langid.held_out("doc_id")))


def test_held_out_accuracy(docs, model):
    got = langid.predict(docs.where(langid.held_out("doc_id")), model)
    right, n = got.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right / n > 0.98


def brute_trigrams(text):
    out = {}
    data = "".join(c.lower() for c in text).encode()
    data = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in data)
    for k in range(len(data) - 2):
        if data[k : k + 2] != b"  " and data[k + 1 : k + 3] != b"  ":
            gram = data[k] | data[k + 1] << 8 | data[k + 2] << 16
            b = (gram * 2654435761 % (1 << 32)) >> 16
            out[b] = out.get(b, 0) + 1
    return out


def brute_shares(text, model):
    """One document, plain loops over sets of languages."""
    grams = brute_trigrams(text)
    if not grams:
        return None
    p = model.likelihood[list(grams)].astype(float)
    c = np.array(list(grams.values()), float)

    def em(share):
        for _ in range(langid.ROUNDS):
            w = p * share
            new = (w / w.sum(1, keepdims=True) * c[:, None]).sum(0) / c.sum()
            small = abs(new - share).max() <= langid.TOLERANCE
            share = new
            if small:
                break
        return share, float((c * np.log(p @ share)).sum())

    share, fit = em(np.full(p.shape[1], 1 / p.shape[1]))
    while (share > 0).sum() > 1:
        trial = share.copy()
        trial[np.where(share > 0, share, np.inf).argmin()] = 0
        trial, less = em(trial / trial.sum())
        if fit - less >= langid.PENALTY * np.log(c.sum() + 1):
            break
        share, fit = trial, less
    return share


def test_equals_one_by_one(docs, model):
    texts = [r.text for r in docs.limit(150).collect()] + ["", "a", "ab c", "...", "und der die", "Ünd\nthe of"]
    row, gram = langid._trigrams(pa.array(texts))
    got = langid.infer(row, gram, len(texts), model.likelihood)
    for t, g in zip(texts, got, strict=True):
        want = brute_shares(t, model)
        assert np.allclose(g, 0 if want is None else want, atol=2e-3), t[:80]


def test_mixed_document_names_both_languages(docs, model, spark):
    half = {r.lang: r.t for r in docs.where("n_chars > 1500").groupBy("lang").agg(F.min(F.substring("text", 1, 900)).alias("t")).collect()}
    mixed = spark.createDataFrame([(1, half["de"] + "\n" + half["es"])], "doc_id long, text string")
    found = langid.predict(mixed, model).first().languages
    assert {x.lang for x in found} == {"de", "es"} and all(0.3 < x.share < 0.7 for x in found)


def test_odd_texts_and_clashing_columns(spark, model):
    rows = [(1, None, "a"), (2, "", "a"), (3, "123 !!", "a"), (4, "the", "a"), (None, "the and of that with", None), (4, "the", "a"), (5, "日本語", "a"), (6, "der und die " * 30_000, "a")]
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string, c1 string"), model, out=("lang_pred", "score", "mix"))
    assert got.columns == ["doc_id", "text", "c1", "lang_pred", "score", "mix"]
    by = {(r.doc_id, r.text and r.text[:10]): r for r in got.collect()}
    assert got.count() == len(rows)
    for k in ((1, None), (2, ""), (3, "123 !!")):
        assert by[k].lang_pred == "und" and by[k].score == 0 and by[k].mix == []
    assert by[(6, "der und di")].lang_pred == "de" and by[(None, "the and of")].lang_pred == "en"
    assert 0 <= by[(5, "日本語")].score <= 1 and by[(5, "日本語")].lang_pred in model.languages


def test_empty_tables(docs, model):
    none = docs.where(F.lit(False))
    assert langid.predict(none, model).count() == 0
    nothing = langid.fit(none)
    assert nothing.languages == [] and langid.predict(none, nothing).count() == 0
    assert {(r.lang_pred, r.score) for r in langid.predict(docs.limit(5), nothing).collect()} == {("und", 0.0)}
