import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            for win in {tuple(v[k : k + width]) for k in range(max(len(v) - width, 0) + 1)} - {()}:
                for s in range(len(w) - len(win) + 1):
                    if tuple(w[s : s + len(win)]) == win:
                        hit |= set(range(s, s + len(win)))
                        found.add("" if item is None else str(item))
        out.append((repr(i), len(w), len(hit), sorted(found)))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    vocab = "the of and é ß wind stone River blue 12 x y z q".split()
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 25)))) for k in range(12)]
    items += [(3, "second text of item three with many words in it indeed yes"), (None, "a null id has a text that is long enough"), (20, None), (21, " .. "), (22, "THE"), (10, items[0][1])]
    docs = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60)))) for k in range(60)]
    docs += [(100 + k, f"start {t} , middle. {t} end") for k, (_, t) in enumerate(items)]
    docs += [(None, "the"), (5, "the"), (5, "the"), (6, None), (7, ""), (8, "..."), (9, "wind " * 5000), (10, "The-OF,and É ß")]
    return docs, items


@pytest.mark.parametrize("width,literal", [(10, 1000), (10, 0), (3, 1000), (1, 0)])
def test_equals_brute_force_on_both_paths(spark, rows, width, literal):
    docs, items = rows
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("window", F.lit("w")).withColumn("row", F.lit(1)).repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("len", F.lit(1))
    got = decontam.scan(d, b, width, literal_words=literal).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == brute(docs, items, width)


def test_no_python_in_the_plan(spark, rows, capfd):
    docs, items = rows
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    decontam.scan(d, b).explain()
    plan = capfd.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_clean_keeps_the_rest_unchanged(spark, rows):
    docs, items = rows
    d = spark.createDataFrame([(i, t, "n", 4) for i, t in docs], "doc_id long, text string, none string, h int")
    got = decontam.clean(d, spark.createDataFrame(items, "item_id long, text string"))
    bad = {k for (k, _, hit, _), in zip(brute(docs, items, 10)) if hit}
    assert got.columns == d.columns
    hits = [brute([x], items, 10)[0][2] for x in docs]
    want = [(i, t, "n", 4) for (i, t), n in zip(docs, hits) if not n]
    assert bad and sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())


def test_empty_tables(spark, rows):
    docs, items = rows
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    none = F.lit(False)
    assert decontam.scan(d.where(none), b).count() == 0
    got = decontam.scan(d, b.where(none)).collect()
    assert len(got) == len(docs) and all(r.n_hit == 0 and r["items"] == [] for r in got)
    assert decontam.clean(d, b.where(none)).count() == len(docs)
