import math
import random
import re
from collections import Counter

from tessera.functions.stopwords import EXPLORE_STOP_WORDS
from tessera.operators import wordcloud


def brute(texts, stop, max_words=100):
    stop = set(stop)
    docs = []
    for t in texts:
        words = re.findall(r"[^\W][\w']*", t.lower())
        words = [w[:-2] if w.endswith("'s") else w for w in words]
        words = [w for w in words if not re.fullmatch(r"\d+", w)]
        docs.append(words)
    uni = Counter(w for d in docs for w in d if w not in stop)
    bi = Counter(f"{a} {b}" for d in docs for a, b in zip(d, d[1:]) if a not in stop and b not in stop)
    n_words = sum(uni.values())

    def fold(c):
        std = {k: (k[:-1] if k.endswith("s") and not k.endswith("ss") and k[:-1] in c else k) for k in c}
        out = Counter()
        for k, v in c.items():
            out[std[k]] += v
        return out, std

    uf, ustd = fold(uni)
    bf, _ = fold(bi)

    def ll(k, n, x):
        return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (n - k)

    table = Counter(uf)
    for key, c12 in bf.items():
        w1, w2 = key.split(" ")
        s1, s2 = ustd[w1], ustd[w2]
        c1, c2 = uf[s1], uf[s2]
        if n_words - c1 == 0:
            continue
        p, p1, p2 = c2 / n_words, c12 / c1, (c2 - c12) / (n_words - c1)
        score = -2 * (ll(c12, c1, p) + ll(c2 - c12, n_words - c1, p) - ll(c12, c1, p1) - ll(c2 - c12, n_words - c1, p2))
        if score > 30:
            table[s1] -= c12
            table[s2] -= c12
            table[key] = c12
    items = sorted(((k, v) for k, v in table.items() if v > 0), key=lambda kv: (-kv[1], kv[0]))[:max_words]
    mx = items[0][1]
    return {k: (v, round(v / mx, 6)) for k, v in items}


def test_wordcloud_matches_brute_force(spark):
    rng = random.Random(11)
    vocab = ["graph", "graphs", "mining", "data", "network", "networks", "deep", "learning", "the", "of", "kernel", "2023", "ann's"]
    texts = []
    for _ in range(40):
        words = []
        for _ in range(rng.randint(5, 40)):
            words.append("deep learning" if rng.random() < 0.25 else rng.choice(vocab))
        texts.append(" ".join(words))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["word"]: (r["count"], round(r["weight"], 6)) for r in wordcloud.wordcloud_weights(df, "text", EXPLORE_STOP_WORDS, 20).collect()}
    want = brute(texts, EXPLORE_STOP_WORDS, 20)
    assert got == want
    assert "deep learning" in got  # the planted collocation is found


def test_texts_are_tokenized_once(spark, monkeypatch):
    plans, inner = [], wordcloud.cut_lineage
    monkeypatch.setattr(wordcloud, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or inner(df))
    df = spark.createDataFrame([("red cats see red cat's cats",), ("12 red",), (None,), ("",), ("cat",)], "text string")
    out = {r["word"]: r["count"] for r in wordcloud.wordcloud_weights(df, "text", stop_words=["see"]).collect()}
    assert out == {"red": 3, "cat": 4}
    assert sum("regexp_extract_all" in p for p in plans) == 1
