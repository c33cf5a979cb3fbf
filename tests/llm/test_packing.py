import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit_bins(lengths, capacity):
    """One document at a time: the tightest open bin that takes it."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = min((b for b in range(len(bins)) if bins[b] >= n), key=lambda b: bins[b], default=None)
        if fit is None:
            bins.append(capacity)
            fit = len(bins) - 1
        bins[fit] -= n
    return sorted(bins)


def expand(runs, histogram, capacity):
    """(bin, offset, length) of every piece of a plan."""
    out = []
    for length, count in histogram.items():
        own = sorted(r for r in runs if r[0] == length)
        for rank in range(count):
            _, first, b, per, offset = next(r for r in reversed(own) if r[1] <= rank)
            out.append((b + (rank - first) // per, offset + (rank - first) % per * length, length))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_one_by_one_best_fit(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 20, 64])
    lengths = [rnd.randint(1, capacity) if rnd.random() < 0.6 else rnd.choice([1, 2, capacity]) for _ in range(rnd.randint(0, 150))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    placed = expand(packing.plan(histogram, capacity), histogram, capacity)
    used = {}
    for b, offset, n in sorted(placed):
        assert offset == used.get(b, 0)
        used[b] = offset + n
    assert sorted(capacity - u for u in used.values()) == best_fit_bins(lengths, capacity)


def test_plan_rejects_a_piece_that_fits_nowhere():
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)


def test_tokenizer_ids_equal_the_library(spark):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    texts = ["", " ", "a  b\n\n c\t", "It's we'll 12345 x²", "naïve Größe 日本語 👩‍🚀 ", "<|endoftext|> in a text", "  x\r\n", "a\x00b\x7f́"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encode = packing.load_tokenizer(PATH)
    assert [encode(x) for x in texts] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("text", ["x" + "\n" * 1_200_000, " " * 1_200_000 + "x", "x" + "\n" * 1_200_000 + " y  z"])
def test_long_white_space_equals_the_library(text):
    assert packing.load_tokenizer(PATH)(text) == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_ids_are_equal_on_both_sides_of_the_long_space_limit():
    t = Tokenizer.from_file(PATH)
    for n in (packing.LONG_SPACE - 1, packing.LONG_SPACE, packing.LONG_SPACE + 1):
        for text in (" \n" * (n // 2) + " " * (n % 2) + "x", "a" + "\u3000" * n + "b"):
            assert packing.load_tokenizer(PATH)(text) == t.encode(text, add_special_tokens=False).ids


def test_special_tokens_equal_the_library_defaults(spark):
    t = Tokenizer.from_file(PATH)
    e = "<|endoftext|>"
    texts = [f"one {e} two", e, e + e, f"a \n {e}  b", f"x{e}'s", "<|endoftext|", f"<{e}>", f"{e} " + " " * packing.LONG_SPACE + f"{e}y"]
    want = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [505, 220, 50256, 734]
    encode = packing.load_tokenizer(PATH, special=True)
    assert [encode(x) for x in texts] == want
    parts = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH, 2, 200_000)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in parts.collect()}
    assert got == {k: [*ids, 2] for k, ids in enumerate(want)}


def test_pack_documents(spark):
    text = "the quick brown fox " * 40
    rows = [(k, text if k % 3 == 0 else "word " * (k % 11), 5) for k in range(120)] + [(None, None, 1), (7, "again", 1), (7, "again", 1), (200, "long text " * 700, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(5)
    parts = packing.pieces(docs, PATH, 2, 64)
    packed = packing.pack(parts, 64).collect()
    t = Tokenizer.from_file(PATH)
    docs_of = {}
    for i, x, _ in rows:
        docs_of.setdefault(i, []).append(np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4"))
    want = []
    for i, many in docs_of.items():
        for ids in many:
            cut = [0] + list(range(len(ids) % 64 or 64, len(ids), 64)) if len(ids) > 64 else [0]
            want += [(i or -1, k, a, zlib.crc32(ids[a : b].tobytes())) for k, (a, b) in enumerate(zip(cut, [*cut[1:], len(ids)]))]
    assert sorted((r.doc_id or -1, r.piece, r.start, zlib.crc32(r.ids)) for r in packed) == sorted(want)
    used = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0) and len(r.ids) == 4 * r.length
        used[r.sequence_id] = r.offset + r.length
    assert sorted(64 - u for u in used.values()) == best_fit_bins([r.length for r in packed], 64)
    whole = {r.sequence_id: r for r in packing.sequences(packing.pack(parts, 64)).collect()}
    assert sum(len(r.ids) for r in whole.values()) == sum(len(r.ids) for r in packed)
    assert max(len(r.ids) for r in whole.values()) == 256


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(docs, PATH, 2, 64), 64).count() == 0
