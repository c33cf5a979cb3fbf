import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import align, queries

A, B = ("byte_bpe", public_tokenizers.path("byte_bpe_50k.json")), ("piece", public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "a", "Hello wörld, don't 12345 stop", "a  b\n\n c\t", "日本語テキスト 👩‍🚀x", "<|endoftext|> and </s> <0x41>", "marked▁space", "x\x00y\r\n",
    "=" * 777 + "." * 300, "né é", "﻿b", "word " * 900, "word " * 900, "a" * 50_000,
]


def byte_level():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}


def brute_groups(texts):
    """Per text its groups as (a ids, b ids), from the libraries themselves and a walk over bytes."""
    t, s = Tokenizer.from_file(A[1]), sentencepiece.SentencePieceProcessor(model_file=B[1])
    t.encode_special_tokens = True
    alphabet = byte_level()
    out = []
    for text in texts:
        if not text:
            out.append([])
            continue
        ids_a, ids_b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
        bytes_a = [bytes(alphabet[c] for c in t.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = b" " + text.encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            out.append([])
            continue
        ends = [set(), set()]
        for side, parts in enumerate((bytes_a, bytes_b)):
            at = 0
            for p in parts:
                at += len(p)
                ends[side].add(at)
        both, found, at = ends[0] & ends[1], [([], [])], [0, 0]
        cut = sorted(both)
        found = [([], []) for _ in cut]
        for side, (ids, parts) in enumerate(((ids_a, bytes_a), (ids_b, bytes_b))):
            at = k = 0
            for i, p in zip(ids, parts):
                at += len(p)
                found[k][side].append(i)
                k += at == cut[k]
        out.append(found)
    return out


def brute(texts):
    all_groups = brute_groups(texts)
    links = []
    for groups in all_groups:
        n = Counter()
        for a, b in groups:
            ca, cb = Counter(a), Counter(b)
            for x in ca:
                for y in cb:
                    n[x, y] += ca[x] * cb[y]
        links.append(n)
    count = Counter(p for n in links for p in n)
    top = {}
    for (a, _), c in count.items():
        top[a] = max(top.get(a, 0), c)
    rows = []
    for groups, n in zip(all_groups, links):
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        rows.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(n.values()),
            sum(v for p, v in n.items() if count[p] == top[p[0]]), sum(v * count[p] for p, v in n.items()),
            hashlib.sha256(shown.encode()).hexdigest() if shown else "",
        ))
    return rows


@pytest.mark.parametrize("frequent", [200_000, 40, 0])
def test_alignment_equals_brute_force(spark, frequent):
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    docs = spark.createDataFrame([(k, t, "en", 1) for k, t in enumerate(texts)], "doc_id long, text string, row string, n_a int").repartition(3)
    out = queries.alignment_digest(docs, frequent).collect()
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out}
    assert got == dict(enumerate(brute(texts)))
    assert got[0][0] == 0 and got[8][0] == 0 and got[7][0] > 0


def test_overlaps_equal_all_pairs():
    a, b = align.tokenise([t for t in TEXTS[:13]], (align.load_side(*A), align.load_side(*B)))
    i, j = align.overlaps(a, b)
    want = [(x, y) for x in range(len(a.id)) for y in range(len(b.id)) if max(a.start[x], b.start[y]) < min(a.end[x], b.end[y])]
    assert list(zip(i.tolist(), j.tolist())) == want


def test_slices_do_not_change_the_result(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS[:15])), "doc_id long, text string")
    one = align.align(docs, A, B).orderBy("doc_id").drop("row").collect()
    monkeypatch.setattr(align, "JOIN_BYTES", 1)
    assert align.align(docs, A, B).orderBy("doc_id").drop("row").collect() == one


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "one two"), (5, "one two"), (5, "one two"), (5, "three")], "doc_id long, text string")
    out = queries.alignment_digest(docs).collect()
    assert sorted((r.doc_id or 0, r.count_sum) for r in out)[0] == (0, 6) and len(out) == 4
    assert [(r.a, r.documents) for r in align.pair_counts(align.align(docs, A, B)).orderBy(F.desc("documents")).limit(1).collect()][0][1] == 3


def test_empty_table(spark):
    assert queries.alignment_digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, queries.alignment_digest(docs).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
