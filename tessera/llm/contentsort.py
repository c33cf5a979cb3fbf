"""Exact dedup by content sort.

Sampled splitters range-partition the rows by (first characters of the text,
64-bit content hash, id), external sorting puts equal texts next to each
other, and neighbouring texts are compared in full. The id is part of the
splitter key, so a text that a third of all rows share is spread over as many
partitions as it needs; a group that runs over a partition's edge is put
together afterwards from one summary row per edge run.

Defined cases: null text counts as empty, and empty texts are equal to each
other. A null id loses to any other id. Rows that repeat an (id, text) pair
are counted each; exactly one row of a group is kept. Extra columns are not
read by ``dedup`` and come back unchanged from ``keep_one``, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, utf8

#: Leading characters of a text in the splitter key: bounds what the sampling sends to the driver.
KEY_CHARS = 32

_KEYS = ["__p", "__h", "__t", "__id"]
_RUN = [("__n", pa.int64()), ("__sha", pa.string()), ("__edge", pa.bool_()), ("__part", pa.int32())]


def _runs(per_row: bool, payload: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scan one sorted partition; equal neighbours form a run.

    Yields a row per input row (``per_row``) or per run, with the run's first
    row, length, digest and whether it lies at an edge: its (prefix, hash) key
    is the partition's first or last, so equals may stand in another partition.
    Held at a time: one batch, and the ids of the runs of the last key."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids = np.zeros(0, np.int64)
        valid = np.zeros(0, bool)
        length, sha, first = np.zeros(0, np.int64), [], np.zeros(0, bool)
        heads: pa.Table | None = None
        last = None  # (prefix, hash, text) of the row before
        in_first = True

        def emit(k: int, edge: np.ndarray) -> Iterator[pa.RecordBatch]:
            """The first k runs."""
            if not k:
                return
            n, edge, digest = length[:k], edge[:k], pa.array(sha[:k], pa.string())
            rows = int(n.sum())
            if per_row:
                at = np.cumsum(n) - n
                run = np.repeat(np.arange(k), n)
                head = np.zeros(rows, bool)
                head[at] = True
                cols = [
                    pa.array(ids[:rows], mask=~valid[:rows]),
                    pa.array(ids[at][run], mask=~valid[at][run]),
                    pa.array(head),
                    pa.array(n[run]),
                    digest.take(pa.array(run)),
                    pa.array(edge[run]),
                    pa.array(np.full(rows, part, np.int32)),
                ]
                yield pa.record_batch(cols, names=["__id", "__head", "__is_head", *(x for x, _ in _RUN)])
            else:
                table = heads.slice(0, k).combine_chunks()
                for x, values in zip(_RUN, (pa.array(n), digest, pa.array(edge), pa.array(np.full(k, part, np.int32))), strict=True):
                    table = table.append_column(x[0], values)
                yield from table.to_batches()

        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            data, off = utf8(batch.column("__t"))
            h = batch.column("__h").to_numpy(zero_copy_only=False)
            p, t, i = batch.column("__p"), batch.column("__t"), batch.column("__id")
            key, run = np.ones(rows, bool), np.ones(rows, bool)
            if rows > 1:
                key[1:] = (h[1:] != h[:-1]) | pc.not_equal(p.slice(1), p.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
                run[1:] = key[1:] | pc.not_equal(t.slice(1), t.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
            key[0] = last is None or (p[0].as_py(), int(h[0])) != last[:2]
            run[0] = bool(key[0]) or t[0].as_py() != last[2]
            begins = np.flatnonzero(run)
            ids = np.concatenate([ids, pc.fill_null(i, 0).to_numpy(zero_copy_only=False)])
            valid = np.concatenate([valid, pc.is_valid(i).to_numpy(zero_copy_only=False)])
            own = np.diff([*begins, rows])
            if len(length):
                length[-1] += begins[0] if len(begins) else rows
            length = np.concatenate([length, own.astype(np.int64)])
            sha += [hashlib.sha256(data[off[a] : off[a + 1]]).hexdigest() for a in begins]
            starts = np.concatenate([np.zeros(len(first), bool), key[begins]])  # runs that open a key
            opened = np.cumsum(key)[begins] - (last is None)  # keys opened since the partition began
            first = np.concatenate([first, (opened == 0) & in_first])
            in_first = in_first and not (opened > 0).any()
            if not per_row:
                new = pa.Table.from_batches([batch]).select(payload).take(pa.array(begins))
                heads = new if heads is None else pa.concat_tables([heads, new])
            closed = int(np.flatnonzero(starts)[-1]) if starts.any() else 0
            yield from emit(closed, first)
            done = int(length[:closed].sum())
            ids, valid, length, sha, first = ids[done:], valid[done:], length[closed:], sha[closed:], first[closed:]
            heads = None if per_row else heads.slice(closed)
            last = (p[rows - 1].as_py(), int(h[-1]), t[rows - 1].as_py())
        yield from emit(len(length), np.ones(len(length), bool))

    return scan


def _order(keep: str):
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    return F.col("__id").desc_nulls_last() if keep == "largest" else F.col("__id").asc_nulls_last()


def _sorted(docs: DataFrame, keep: str) -> DataFrame:
    """Rows with columns ``__p __h __t __id`` dealt by range and sorted."""
    order = _order(keep)
    return docs.repartitionByRange("__p", "__h", order).sortWithinPartitions("__p", "__h", "__t", order)


def _keys(id_col: str, text_col: str) -> list:
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.substring(t, 1, KEY_CHARS).alias("__p"), F.xxhash64(t).alias("__h"), t.alias("__t"), F.col(id_col).cast("long").alias("__id")]


def _winner(head: str, keep: str):
    """Orders the runs of one text; the smallest one's head stays."""
    c = F.col(head)
    return F.struct(c.isNull(), -c if keep == "largest" else c, F.col("__part"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    ``keep`` says whether the largest or the smallest id of equal texts stays."""
    schema = "__id long, __head long, __is_head boolean, __n long, __sha string, __edge boolean, __part int"
    dealt = _sorted(docs.select(*_keys(id_col, text_col)), keep)
    runs = stored(dealt.mapInArrow(_runs(True, []), schema), "contentsort")
    best = (F.max if keep == "largest" else F.min)("__head")
    whole = runs.where("__edge and __is_head").groupBy("__sha").agg(
        F.sum("__n").alias("all_n"), best.alias("all_id"), F.min_by("__part", _winner("__head", keep)).alias("at")
    )
    inner = runs.where("not __edge").select("__id", F.col("__head").alias("keep_id"), F.col("__n").alias("group_size"), F.col("__is_head").alias("kept"), "__sha")
    # broadcast: a partition has two edge keys, so this is bounded by the number of partitions
    outer = runs.where("__edge").join(F.broadcast(whole), "__sha").select(
        "__id", F.col("all_id").alias("keep_id"), F.col("all_n").alias("group_size"), (F.col("__is_head") & (F.col("__part") == F.col("at"))).alias("kept"), "__sha"
    )
    return inner.unionByName(outer).select(F.col("__id").alias(id_col), "keep_id", "group_size", "kept", F.col("__sha").alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged.

    The rows travel through the sort once; only each run's first row leaves it."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    text, rest = at[text_col], [c for c in plain.columns if c != at[text_col]]
    rows = plain.select(*_keys(at[id_col], text), F.col(text).isNull().alias("__null"), *rest)
    payload = ["__id", "__t", "__null", *rest]
    fields = [rows.schema[c] for c in payload] + [T.StructField(x, t) for (x, _), t in zip(_RUN, (T.LongType(), T.StringType(), T.BooleanType(), T.IntegerType()), strict=True)]
    heads = stored(_sorted(rows, keep).mapInArrow(_runs(False, payload), T.StructType(fields)), "contentsort")
    whole = heads.where("__edge").groupBy(F.col("__sha").alias("sha")).agg(F.min_by("__part", _winner("__id", keep)).alias("at"))
    # broadcast: bounded by the number of partitions, as above
    stay = heads.join(F.broadcast(whole), F.col("__edge") & (F.col("__sha") == F.col("sha")), "left").where("not __edge or __part = at")
    original = F.when(~F.col("__null"), F.col("__t").cast(plain.schema[text].dataType))
    return stay.select(*((original if c == text else F.col(c)).alias(name) for name, c in at.items()))
