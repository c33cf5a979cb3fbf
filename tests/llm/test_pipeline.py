import os
import sys

import numpy as np
import public_tokenizers
import pytest
import zlib
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as P
from test_decontam import brute as brute_hits
from test_packing import best_fit_bins
from test_simhash import brute_groups

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    odd = [(9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 1), (9003, "", None, None, None), (None, "the of and that with for the", None, "s", 1), (1, "the of and that this is with a and the", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = [docs.collect()]
    for _, stage in P.STAGES:
        docs = spark.createDataFrame(out[-1], docs.schema) if out[-1] else docs.limit(0)
        got = stage(spark, docs.repartition(5), DIR)
        assert stage is P.pack or got.schema.names == docs.schema.names
        out.append(got.collect())
    return out


def keys(rows):
    return sorted(map(repr, rows))


def test_language_keeps_documents_with_letters(results):
    assert keys(results[1]) == keys(r for r in results[0] if r.text and any(c.isalpha() for c in r.text))


def test_exact_dedup(results):
    last = {}
    for r in results[1]:
        if r.text not in last or (r.doc_id or -1) > (last[r.text].doc_id or -1):
            last[r.text] = r
    assert keys(results[2]) == keys(last.values())


def test_near_dedup(results):
    rows = results[2]
    group = {int(k): g for k, _, g in brute_groups([(k, r.text) for k, r in enumerate(rows)])}  # ids repeat here, places don't
    members = {}
    for k, r in enumerate(rows):
        members.setdefault(group[k], []).append(r)
    kept = keys(results[3])
    assert len(kept) == len(members)
    for own in members.values():
        (stays,) = [r for r in own if repr(r) in kept]
        ids = [r.doc_id for r in own if r.doc_id is not None]
        assert not ids or stays.doc_id == min(ids)


def test_decontaminate(spark, results):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    clean = [r for r in results[3] if brute_hits([(r.doc_id, r.text)], items, 10)[0][2] == 0]
    assert len(clean) < len(results[3]) and keys(results[4]) == keys(clean)


def test_pack(results):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in results[4]:
        ids = np.array([*t.encode(r.text, add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)] if len(ids) > 1024 else [0, len(ids)]
        want += [(r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = results[5]
    assert keys(want) == keys((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    used = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert sorted(1024 - u for u in used.values()) == best_fit_bins([r.length for r in got], 1024)


def test_run_and_empty_tables(spark, tmp_path):
    assert P.run(spark, DIR).count() > 100
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, DIR).count() == 0
