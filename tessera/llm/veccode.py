"""Vector codes: product quantisation with LAESA pivots, in exact integers.

Components become integers, vectors are cut into equal parts, and every part
position has a codebook that a given number of rounds refines (assign all parts
to their nearest entry, replace entries by the floored mean). The search for the
nearest entry follows LAESA:

* every part position has a few fixed pivots, chosen once from its first
  codebook; the distances of all parts to them are computed once and stored;
* in a round only the distances from pivots to the entries are new. By the
  triangle inequality |d(part, pivot) - d(pivot, entry)| bounds d(part, entry)
  from below;
* a part tries the entries in the order of their bounds and stops when the next
  bound exceeds the best distance found. Squared distances are exact integers;
  bounds are lowered by more than their rounding, so nothing is lost and ties
  go to the lower index.

A round is one scan: a task adds up its rows per (part, entry), Spark adds up
the tasks, and only entries (parts x entries x part length numbers) reach the
driver.

Defined cases: rows whose vector is null, holds null or non-finite components or
is empty are dropped, and so are rows whose length is not that of the vector of
the smallest id (there is one codebook for one length). That length must be a
multiple of ``parts``. Null ids are encoded but give no first entries; of
repeated ids every row counts, ordered by their components. With fewer rows than
entries the codebooks have as many entries as there are rows. Null labels are a
label of their own. Extra columns are not read. An empty table gives an empty
result. Components of 2**26 or more after scaling are refused: sums of their
squares would leave 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import split_join
from .common import stored

#: Pivots of a part position.
PIVOTS = 4
#: Rows that a NumPy pass looks at together.
TILE = 4096
_LIMIT = 1 << 26


class Codes(NamedTuple):
    """``rows``: row, vec_id, label, codes (binary, one byte a part), error;
    ``codebooks``: parts x entries x part length integers."""

    rows: DataFrame
    codebooks: np.ndarray


def quantised(df: DataFrame, id_col: str, vec_col: str, label_col: str | None, scale: int) -> DataFrame:
    """(row, vec_id, label, x) with x = floor(scale * component) of the usable rows."""
    bad = F.exists(vec_col, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    rows = df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).where(~bad)
    x = F.transform(vec_col, lambda v: F.floor(v.cast("double") * scale))
    large = F.exists("x", lambda v: F.abs(v) >= _LIMIT)
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), x.alias("x"))
    checked = F.when(large, F.raise_error(F.lit("a component is too large for exact codes")).cast("array<bigint>")).otherwise(F.col("x"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", checked.alias("x"))


def choose_pivots(entries: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """n entries far from each other (farthest first, from entry 0)."""
    chosen = [0]
    far = ((entries - entries[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(entries)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((entries - entries[chosen[-1]]) ** 2).sum(1))
    return entries[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each part: (index, squared distance, distances evaluated).

    ``to_pivots`` are the parts' squared distances to the pivots, known before."""
    own = np.sqrt(to_pivots.astype(np.float64))
    theirs = np.sqrt(((pivots[:, None] - entries[None]) ** 2).sum(2).astype(np.float64))
    bound = np.abs(own[:, :1] - theirs[0])
    for k in range(1, len(pivots)):
        np.maximum(bound, np.abs(own[:, k : k + 1] - theirs[k]), out=bound)
    bound -= 1e-9 * (1 + own.max(initial=0) + theirs.max(initial=0))  # more than the roots are rounded by
    n = len(x)
    best = np.full(n, np.iinfo(np.int64).max)
    index = np.zeros(n, np.int64)
    active, evaluated = np.arange(n), 0
    for _ in range(len(entries)):
        at = bound.argmin(1)
        low = bound[np.arange(len(active)), at]
        open_ = (low <= 0) | (low * low <= best[active])  # an equal bound may still be a tie with a lower index
        active, at, bound = active[open_], at[open_], bound[open_]
        if not len(active):
            break
        diff = x[active] - entries[at]
        d = np.einsum("ij,ij->i", diff, diff)
        evaluated += len(active)
        better = (d < best[active]) | ((d == best[active]) & (at < index[active]))
        best[active[better]], index[active[better]] = d[better], at[better]
        bound[np.arange(len(active)), at] = np.inf
    return index, best, evaluated


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def encode(df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label") -> Codes:
    """Fit the codebooks on all rows and encode all rows."""
    spark = df.sparkSession
    usable = quantised(df, id_col, vec_col, label_col, scale)
    first = usable.where("vec_id IS NOT NULL").orderBy("vec_id", "x").select("x").limit(entries).collect()  # `entries` rows at most
    if not first:
        first = usable.orderBy("x").select("x").limit(entries).collect()  # no row has an id
    dim = len(first[0]["x"]) if first else parts
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    seeds = [r["x"] for r in first if len(r["x"]) == dim]
    books = np.array(seeds, np.int64).reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2).copy()
    pivots = np.stack([choose_pivots(b) for b in books]) if seeds else books
    size, n_pivots = dim // parts, pivots.shape[1]
    fixed = spark.sparkContext.broadcast(pivots)  # parts x PIVOTS entries

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dim).reshape(-1, parts, size)
            d = np.empty((len(x), parts, n_pivots), "<i8")
            for a in range(0, len(x), TILE):
                diff = x[a : a + TILE, :, None] - fixed.value[None]
                d[a : a + TILE] = np.einsum("npkj,npkj->npk", diff, diff)
            kept = [batch.column(c) for c in ("row", "vec_id", "label")]
            cells = [pa.array([v.tobytes() for v in m], pa.binary()) for m in (x.astype("<i4"), d)]
            yield pa.record_batch([*kept, *cells], names=["row", "vec_id", "label", "x", "to_pivots"])

    kind = usable.schema["label"].dataType.simpleString()
    of_length = usable.where(F.size("x") == dim)
    known = stored(of_length.mapInArrow(measure, f"row long, vec_id long, label {kind}, x binary, to_pivots binary"), "parts")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for batch in batches:
            for a in range(0, batch.num_rows, TILE):
                part = batch.slice(a, TILE)
                x = np.frombuffer(b"".join(part.column("x").to_pylist()), "<i4").reshape(-1, parts, size).astype(np.int64)
                yield part, x, np.frombuffer(b"".join(part.column("to_pivots").to_pylist()), "<i8").reshape(-1, parts, n_pivots)

    for _ in range(rounds if seeds else 0):
        current = spark.sparkContext.broadcast(books)  # the model

        def add(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            n = current.value.shape[1]
            count, total = np.zeros((parts, n), np.int64), np.zeros((parts, n, size), np.int64)
            for _, x, d in tiles(batches):
                for p in range(parts):
                    at = nearest(x[:, p], d[:, p], current.value[p], fixed.value[p])[0]
                    count[p] += np.bincount(at, minlength=n)
                    np.add.at(total[p], at, x[:, p])
            p, e = np.nonzero(count)
            sums = pa.array(total[p, e].tolist(), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), sums], names=["part", "entry", "n", "s"])

        sums = known.select("x", "to_pivots").mapInArrow(add, "part int, entry int, n long, s array<long>")
        per = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(size)))
        books = books.copy()
        for r in per.collect():  # parts x entries rows at most
            books[r["part"], r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(size)]
    final = spark.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x, d in tiles(batches):
            code, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                at, far, _ = nearest(x[:, p], d[:, p], final.value[p], fixed.value[p])
                code[:, p], error = at, error + far
            kept = [part.column(c) for c in ("row", "vec_id", "label")]
            yield pa.record_batch([*kept, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)], names=["row", "vec_id", "label", "codes", "error"])

    return Codes(known.mapInArrow(assign, f"row long, vec_id long, label {kind}, codes binary, error long"), books)


def with_label_error(coded: Codes) -> DataFrame:
    """(vec_id, codes, error, label_error): the error summed over equal labels, nulls together."""
    key = {"is_null": F.col("label").isNull(), "value": F.col("label").cast("string")}
    rows = stored(coded.rows, "codes").select("*", *(F.coalesce(v, F.lit("")).alias(k) if k == "value" else v.alias(k) for k, v in key.items()))
    sums = stored(rows.groupBy("is_null", "value").agg(F.count("*").alias("n"), F.sum("error").alias("label_error")), "label-error")
    return split_join(rows, sums, ["is_null", "value"], "n").select("vec_id", "codes", "error", "label_error")
