import random

import numpy as np
import pytest

from tessera.llm import mixing


def test_floor_sum_and_points():
    rnd = random.Random(1)
    for _ in range(200):
        n, m, a, b = rnd.randint(0, 40), rnd.randint(1, 30), rnd.randint(0, 90), rnd.randint(0, 90)
        assert mixing.floor_sum(n, m, a, b) == sum((a * i + b) // m for i in range(n))
    points = [i * mixing.GOLDEN % 2**64 for i in range(500)]
    for n in (0, 1, 7, 500):
        for edge in (0, 1, 2**62, 12345 * 2**49, 2**64 - 1, 2**64):
            assert mixing.points_below(n, edge) == sum(p < edge for p in points[:n])


def brute_targets(sizes, weights, most):
    """Reshare the excess until none is above."""
    total, capped = sum(sizes), set()
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        left = total - sum(most * sizes[k] for k in capped)
        share = {k: left * weights[k] / sum(weights[j] for j in free) for k in free}
        above = {k for k in free if share[k] > most * sizes[k]}
        if not above:
            return [most * sizes[k] if k in capped else share[k] for k in range(len(sizes))]
        capped |= above


def test_targets_reshare_the_excess():
    rnd = random.Random(2)
    for _ in range(300):
        sizes = [rnd.choice([0, 1, 10, 300, 5000, rnd.randint(0, 100)]) for _ in range(rnd.randint(1, 9))]
        weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
        got = mixing.targets(sizes, weights, 3)
        assert got == pytest.approx(brute_targets(sizes, weights, 3))
        assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * n for t, n in zip(got, sizes))
    assert mixing.targets([], [], 3) == []


@pytest.mark.parametrize("blocks", [[5], [7, 0, 1], [300, 120, 61, 3], [1, 1000], [0, 0]])
def test_slots_give_every_block_once_and_spread_sources(spark, blocks):
    rows = mixing.slots(spark, blocks, chunk=64).collect()
    assert sorted(r.slot for r in rows) == list(range(sum(blocks)))
    for k, n in enumerate(blocks):
        assert sorted(r["rank"] for r in rows if r.source_no == k) == list(range(n))
    total, seen = sum(blocks), np.zeros(len(blocks))
    for i, r in enumerate(sorted(rows, key=lambda r: r.slot)):
        seen[r.source_no] += 1
        assert np.abs(seen - (i + 1) * np.array(blocks) / total).max() <= 4  # every prefix has nearly the target shares


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, slot string, row int")


def test_mixture_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(k, "w\x0b " * rnd.randint(0, 40), rnd.choice(["a", "a", "a", "b", "c", None, "é"]), 7, "s", 1) for k in range(300)]
    rows += [(900, "long word\n" * 3000, "d", 1, "s", 1), (None, "x y z", "tiny", 1, "s", 1), (901, None, "a", 1, "s", 1), (901, None, "a", 1, "s", 1), (902, "", "only empty", 1, "s", 1)]
    docs = table(spark, rows).repartition(6)
    m = mixing.mix(docs, (5, 2, 1), 3, 32)
    out = mixing.taken(m).collect()
    assert len(out) == len(rows)
    names = [s.source for s in m.sources]
    assert names == ["a", "b", "c", "d", "only empty", "tiny", "é", None]
    size = {s: sum(len((t or "").split()) for _, t, x, *_ in rows if x == s) for s in names}
    want = dict(zip(names, brute_targets([size[s] for s in names], [5, 2, 1, 5, 2, 1, 5, 2], 3)))
    by_source = dict.fromkeys(names, 0)
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
    text = {i: (t, s) for i, t, s, *_ in rows}
    for r in out:
        t, s = text[r.doc_id]
        assert r.size == len((t or "").split()) and r.source_size == size[s] and r.target == pytest.approx(want[s])
        by_source[s] += r.taken
    for s in names:
        assert abs(by_source[s] - want[s]) <= 0.5
    # the schedule: slots without gaps, each of one source, full but for a source's last one, words of a pass read once
    plan = m.schedule.collect()
    slots, read = {}, {}
    for r in plan:
        slots.setdefault((r.slot, r.source_no), 0)
        slots[r.slot, r.source_no] += r.words
        read.setdefault((r.row, r["pass"]), []).append((r.start, r.words))
    assert sorted(k for k, _ in slots) == list(range(len(slots)))
    for k in range(len(names)):
        assert sum(n != 32 for (_, s), n in slots.items() if s == k) <= 1
    for parts in read.values():
        parts.sort()
        assert [a for a, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)]))[:-1]


def test_reruns_and_other_partitions_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sorted(mixing.taken(mixing.mix(docs, (5, 2, 1), 3, 64)).collect())
    two = sorted(mixing.taken(mixing.mix(docs.repartition(7), (5, 2, 1), 3, 64)).collect())
    assert one == two and len(one) == docs.count()


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b c d e", "s", 1, "", 1)] * 3 + [(1, "a b", "s", 1, "", 1)]
    out = mixing.taken(mixing.mix(table(spark, rows), (5,), 3, 2)).collect()
    assert sorted((r.size, r.taken) for r in out) == [(2, 2), (5, 5), (5, 5), (5, 5)]
    for rows in ([], [(1, None, None, 1, "", 1), (2, " \t", "x", 1, "", 1)]):
        m = mixing.mix(table(spark, rows), (5, 2, 1), 3, 8)
        assert m.schedule.count() == 0 and [r.taken for r in mixing.taken(m).collect()] == [0] * len(rows)
