"""Helpers shared by the operators of this subpackage.

* ``stored`` cuts lineage with a Parquet table in the shared folder that
  ``spark.checkpoint.dir`` names, so a lost executor never forces the work
  above it to run again and nothing lands on a machine-local disk.
* ``utf8`` / ``slices`` / ``words`` / ``hash_spans`` view an Arrow string column
  as one byte buffer and work on it with NumPy, a bounded slice at a time.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text that a NumPy pass looks at together; one text is never split.
SLICE_BYTES = 2 << 20
#: Rows of a checked table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000

_MULT = 0x9E3779B97F4A7C15
_MULT_INV = pow(_MULT, -1, 1 << 64)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(left: DataFrame, right: DataFrame, on, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with ``right`` (a stored table): broadcast when its counted size
    is within ``rows``, a shuffled join beyond. The result is the same."""
    small = right.limit(rows + 1).count() <= rows
    return left.join(F.broadcast(right) if small else right, on, how)


def lower_ascii(col):
    """Lower-case A-Z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_fold(id_col: str, mod: int):
    """crc32 of an id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


# ------------------------------------------------------------- byte buffers


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    arr = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(arr)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + n + 1]
    body = arr.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice has about ``limit`` text bytes at
    most, or one row where a single text is longer."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(size.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, off: np.ndarray, lut: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of ``lut`` bytes; no run crosses a row."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = lut[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def per_process(key, make):
    """``make()`` once per Python process. Functions reach the workers by
    value, each task with globals of its own, so module globals are no cache."""
    cache = sys.modules.setdefault("__tessera_cache__", types.ModuleType("__tessera_cache__")).__dict__
    if key not in cache:
        cache[key] = make()
    return cache[key]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(22, int(n).bit_length())

    def make():
        up, down = np.full(size, _MULT, np.uint64), np.full(size, _MULT_INV, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)

    return per_process(("powers", size), make)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span, from one running sum
    (a polynomial in an odd multiplier, shifted back to the span's start)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def renamed(result: DataFrame, columns: list[str], added: Sequence[str]) -> DataFrame:
    """``result`` with its first columns named ``columns`` and its last ones
    ``added``. A column that an added one is named like (in any case) gives way to it."""
    taken = {a.lower() for a in added}
    names = [*columns, *added]
    kept = [k for k, n in enumerate(names) if k >= len(columns) or n.lower() not in taken]
    return result.toDF(*(f"c{k}" for k in range(len(names)))).select(*(F.col(f"c{k}").alias(names[k]) for k in kept))


# ------------------------------------------------------------- labelled rows


def known_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, y), a row per labelled id: rows of one id that contradict each other count as 1."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
    return rows.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))


def class_counts(labels: DataFrame, label: str, id_col: str = "doc_id") -> dict[int, int]:
    """Labelled ids of each class."""
    return {r[0]: r[1] for r in known_labels(labels, label, id_col).groupBy("y").agg(F.count("*")).collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y) of about ``per_class`` labelled documents of each class.

    Rows are taken by a hash of their id, at the rate that gives ``per_class``
    on average, so the sample is the same in every run and bounded by the
    parameter; its ids are broadcast and no text is shuffled."""
    known, count = known_labels(labels, label, id_col), class_counts(labels, label, id_col)
    scale = 1 << 30
    part = F.pmod(F.xxhash64("id"), F.lit(scale))
    rate = {y: min(scale, scale * per_class // n) for y, n in count.items()}
    taken = known.where(part < F.when(F.col("y") == 1, rate.get(1, 0)).otherwise(rate.get(0, 0)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(stored(taken, "sample")), "id").select("text", "y")
