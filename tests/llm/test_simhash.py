import random

import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash


def brute_fingerprint(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    parts = [" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] if len(words) >= shingle else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, max_bits=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= max_bits:
                group[find(a)] = find(b)
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            first[find(k)] = min(first.get(find(k), i), i)
    return sorted((repr(i), f"{fp:016x}", first.get(find(k))) for k, ((i, _), fp) in enumerate(zip(rows, fps)))


def texts():
    rnd = random.Random(5)
    out = [None, "", " \n\t ", "one", "one two", "One two x", "ÀB c d e", "a\x0bb\x0cc d"]
    for _ in range(12):
        base = [rnd.choice("the of and light wind stone river blue high under".split()) + rnd.choice(["", "s", "er"]) for _ in range(rnd.randint(20, 400))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
        out += [" ".join(base)] * 3
    return out


def test_groups_equal_all_pairs(spark):
    rows = [(900 - k, t) for k, t in enumerate(texts())] + [(None, "one two"), (5, "one two"), (5, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1)).repartition(5)
    got = sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in simhash.groups(docs).collect())
    assert got == brute_groups(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({g for _, _, g in got})


def test_a_fingerprint_of_many_rows(spark):
    rows = [(k, "the same words in each of these rows") for k in range(5, 1400)] + [(3, "other text that links with nothing at all"), (1, "")]
    got = simhash.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (3, 3)] + [(k, 5) for k in range(5, 1400)]


def test_links_equal_all_pairs(spark):
    rnd = random.Random(1)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        fp = rnd.getrandbits(64)
        fps.add(fp)
        for _ in range(6):
            fps.add(fp := fp ^ (1 << rnd.randrange(64)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    for bits, hot in ((0, 0), (1, 0), (3, 512), (3, 0), (3, 1), (5, 512), (5, 0)):  # hot: entries that are split once more
        want = {(min(a, b), max(a, b)) for (a,) in signed for (b,) in signed if a != b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits}
        got = [tuple(r) for r in simhash.links(df, bits, hot).collect()]
        assert len(got) == len(want) and set(got) == want


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1000, k) for k in range(2000, 2300)] + [(-5, 1000)]
    got = dict(tuple(r) for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 100 for k in range(100, 161)} | {k: -5 for k in [-5, 1000, *range(2000, 2300)]}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0
