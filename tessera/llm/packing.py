"""Best-fit-decreasing packing of token pieces into sequences.

``pieces`` tokenizes whole texts and cuts only documents longer than a
sequence. ``pack`` places the pieces. Best-fit decreasing never looks at more
than a piece's length, so the placement is worked out once on the histogram of
lengths (``capacity`` numbers at most): lengths from the longest down, each
into the tightest open bin, found by a segment tree over the remaining
capacities in logarithmic time. Bins of equal content are one entry with a
count, which gives exactly the bins that a document-by-document run gives. Spark
then ranks the pieces within their length, over salts so that a length that a
third of all rows share is many groups, and reads each piece's bin and offset
from the broadcast plan.

Defined cases: null text counts as empty and is one piece that holds only the
end token. Null or repeated ids are kept, each row is packed by itself. Extra
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_process, slices, stored

#: Ranks are counted in this many salts per length.
SALTS = 1024
#: Texts with so many white-space characters in a row are encoded by ``tokenizers``.
LONG_SPACE = 100_000

_SPACE = re.compile(r"\s+")


def _long_space(text: str) -> bool:
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in _SPACE.finditer(text))


def load_tokenizer(path: str, special: bool = False):
    """A function from text to ids for a byte-level BPE file of ``tokenizers``.
    With ``special``, the file's added tokens in a text get their own ids, as in
    the library by default; otherwise they are ordinary text
    (``encode_special_tokens``).

    The file's own vocabulary and split pattern are run by tiktoken, whose ids
    are equal (tested) and which needs a quarter of the time. Its pattern
    backtracks over white space and fails from a million characters in a row
    on, so texts with a long run go through ``tokenizers`` itself."""

    def make():
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        # the byte-level alphabet: printable bytes stand for themselves, the others for code points from 256
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        bpe = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

        def encode(text: str) -> list[int]:
            if _long_space(text):
                return library().encode(text, add_special_tokens=False).ids
            return bpe.encode(text, allowed_special="all") if special else bpe.encode_ordinary(text)

        return encode

    def library():
        def read():
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.encode_special_tokens = not special
            return t

        return per_process(("tokenizer library", path, special), read)

    return per_process(("tokenizer", path, special), make)


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut documents: ``id_col``, piece, start, length, ids (binary, little-endian
    unsigned 32 bits). Only documents of more than ``capacity`` ids are cut;
    their first piece takes what the full ones leave over."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_tokenizer(tokenizer_path, special=True)
        for batch in slices(batches, "text"):
            out: list[tuple] = []
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                begin = 0
                end = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
                k = 0
                while begin < len(ids):
                    out.append((i, k, begin, end - begin, ids[begin:end].tobytes()))
                    begin, end, k = end, end + capacity, k + 1
            cols = list(zip(*out, strict=True))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, "id long, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


class _Tree:
    """Segment tree over remaining capacities 0..n; finds the smallest open one >= r."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, r: int, is_open: bool) -> None:
        k = r + self.size
        self.open[k] = is_open
        while k > 1:
            k //= 2
            self.open[k] = self.open[2 * k] or self.open[2 * k + 1]

    def tightest(self, r: int) -> int | None:
        k = r + self.size
        if self.open[k]:
            return r
        while k > 1:
            if k % 2 == 0 and self.open[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.open[2 * k] else 2 * k + 1
                return k - self.size
            k //= 2
        return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing on counts of lengths.

    Returns runs (length, first rank, first bin, per bin, offset): pieces of a
    length, by rank from ``first rank``, fill consecutive bins from ``first bin``
    with ``per bin`` of them each, from ``offset`` on; a run reaches to the next
    run of its length."""
    runs: list[tuple[int, int, int, int, int]] = []
    tree, at = _Tree(capacity), {}  # remaining capacity -> [(first bin, bins)]
    bins = 0

    def put(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            at.setdefault(remaining, []).append((first, n))
            tree.set(remaining, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit a sequence of {capacity}")
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, fresh = capacity, -(-left // (capacity // length))
                first, n = bins, fresh
                bins += fresh
            else:
                first, n = at[remaining].pop()
                if not at[remaining]:
                    tree.set(remaining, False)
            per = remaining // length  # a bin just filled is the tightest as long as it takes one more
            full = min(n, left // per)
            if full:
                runs.append((length, rank, first, per, capacity - remaining))
                put(remaining - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < n and left:  # fewer than a bin takes
                runs.append((length, rank, first + full, left, capacity - remaining))
                put(remaining - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if remaining < capacity:
                put(remaining, first + full, n - full)
    return runs


def pack(parts: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """``parts`` with sequence_id and offset; reads ``length_col`` only.

    ``parts`` is written once: its lengths are counted and then ranked."""
    salted = stored(parts.withColumn("__row", F.monotonically_increasing_id()), "pieces").withColumn("__salt", F.pmod("__row", F.lit(SALTS)))
    counts = salted.groupBy(F.col(length_col).alias("__length"), "__salt").agg(F.count("*").alias("__n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("__length").agg(F.sum("__n")).collect()}  # at most `capacity` rows
    runs = plan(histogram, capacity)
    table = np.array(runs, np.int64).reshape(-1, 5)
    order = np.lexsort((table[:, 1], table[:, 0]))
    shared = salted.sparkSession.sparkContext.broadcast(table[order])  # a few runs per length at most

    # where each salt's ranks begin within its length
    before = Window.partitionBy("__length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("__length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__begin"))
    within = Window.partitionBy(length_col, "__salt").orderBy("__row")
    ranked = salted.withColumn("__rank", F.row_number().over(within) - 1)
    # both sides are already dealt by (length, salt)
    begins = begins.withColumnRenamed("__length", length_col)
    ranked = ranked.join(begins, [length_col, "__salt"]).select(*parts.columns, (F.col("__rank") + F.col("__begin")).alias("__rank"))
    fields = [f.name for f in parts.schema.fields]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_table = shared.value
        lengths, firsts = plan_table[:, 0], plan_table[:, 1]
        for batch in batches:
            n = batch.column(length_col).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False).astype(np.int64)
            k = np.searchsorted(lengths * (1 << 40) + firsts, n * (1 << 40) + rank, "right") - 1
            nth = rank - firsts[k]
            columns = [batch.column(f) for f in fields]
            columns += [pa.array(plan_table[k, 2] + nth // plan_table[k, 3]), pa.array(plan_table[k, 4] + nth % plan_table[k, 3] * n)]
            yield pa.record_batch(columns, names=[*fields, "sequence_id", "offset"])

    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids themselves: sequence_id, ids (binary), n_pieces. A
    sequence holds ``capacity`` ids at most, so the groups are bounded."""
    return (
        packed.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"), F.size("parts").alias("n_pieces"))
    )
