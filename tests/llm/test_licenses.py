import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates):
    """(label, first, longest length) from every word, by a regular expression per template."""
    w = words(text)
    out = []
    for k in range(len(w)):
        rest = "".join(x + " " for x in w[k:])
        for markup, label in templates:
            ends = [n for n in range(1, len(w) - k + 1) if re.fullmatch(licenses.as_pattern(markup), "".join(x + " " for x in w[k : k + n]))] if re.match(licenses.as_pattern(markup), rest) else []
            if ends:
                out.append((label, k, max(ends)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(40))
def test_automaton_equals_regular_expressions(seed):
    rnd = random.Random(seed)

    def markup(depth=0):
        parts = ["abc"[rnd.randrange(3)]] if depth == 0 else []
        for _ in range(rnd.randint(1, 4)):
            kind = rnd.random()
            if kind < 0.6 or depth > 1:
                parts.append("abc"[rnd.randrange(3)])
            elif kind < 0.8:
                parts.append(f"<<beginOptional>>{markup(depth + 1)}<<endOptional>>")
            else:
                low = rnd.randint(0, 2)
                parts.append(f"<<var;match={low}..{low + rnd.randint(0, 2)}>>")
        return " ".join(parts)

    templates = [(markup(), str(k)) for k in range(4)]
    automaton = licenses.Automaton(templates)
    for _ in range(10):
        text = " ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 14)))
        got = sorted((automaton.labels[t], k, n) for t, k, n in automaton.scan(licenses.words(text)))
        assert got == brute(text, templates), (templates, text)


def test_templates_that_cannot_be_compiled():
    for markup in ("<<beginOptional>>a", "a<<endOptional>>", "<<var;match=0..1>> a", "<<beginOptional>>a<<endOptional>>", ""):
        with pytest.raises(ValueError):
            licenses.Automaton([(markup, "x")])


def test_query_columns_equal_brute_force(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
             "under the mit license under the mit license", "cc by nc cc BY NC", "apache license version 3", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, and/or sell copies of the Software"]
    rows = [(k, f"Ab é1 ... {a}\nmore {b}", 1) for k, (a, b) in enumerate((a, b) for a in lines for b in ["", *lines[:3]])]
    rows += [(None, None, 1), (900, "", 1), (901, "!!", 1), (902, "word " * 100_000 + lines[0], 1), (903, lines[0], 1), (903, lines[0], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int").withColumnRenamed("n_words", "spans2")
    got = sorted(map(tuple, licenses.summary(licenses.scan(docs)).collect()), key=repr)
    want = []
    for i, text, _ in rows:
        w = words(text)
        small = text if len(w) < 1000 else lines[0]
        shift = len(w) - len(words(small))
        base = [(label, k + shift) for label, k, _ in brute(small, licenses.PHRASES)]
        more = {label for label, _, _ in brute(small, licenses.TEMPLATES)}
        starts = [k for _, k in base]
        names = {label for label, _ in base}
        want.append((i, len(w), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(names)), ",".join(sorted(names | more)), 1.0 if more else 0.5 if base else 0.0))
    assert got == sorted(want, key=repr)


def test_columns_are_kept_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x", 2)], "doc_id long, text string, c0 int")
    assert licenses.scan(docs).columns == ["doc_id", "text", "c0", "n_words", "spans"]
    assert licenses.summary(licenses.scan(docs.where(F.lit(False)))).count() == 0
