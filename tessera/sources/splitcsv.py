"""Quoted CSV read in parallel (A1): one file with line breaks inside fields, many tasks.

Spark's ``multiLine`` reader makes a file one task, since a reader that starts in
the middle can't know whether it stands inside quotes. Here the file is read as
lines, which Spark splits by bytes:

1. every split counts its quote characters; the running sum of the counts
   before a split tells whether it begins inside a field (one number per split
   reaches the driver and the tasks);
2. every split puts its lines together to records from that state. A record
   that runs over splits comes out as pieces, which are joined by a shuffle of
   the pieces alone. Spark's own ``from_csv`` parses the records.

That is three scans of the files (one to count, one each for records and
pieces). The split of a pass need not be that of the other: the state at a byte is the same, and a
start the first pass did not see raises an error.

Defined cases: files follow RFC 4180 (a quote stands only in quoted fields,
where it is doubled); a file whose quotes don't close raises an error. Records end with
``\\n`` or ``\\r\\n``; line breaks inside fields are kept as they are. Empty lines outside
fields are skipped, the first record of each file is its header, a short record
has NULL in the rest, an empty file has no rows. Compressed files are one split.
The schema gives the columns by position; any names work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import files


def _segments(batches):
    """(path, start of the split, lines) of consecutive rows of one split."""
    for b in batches:
        if not b.num_rows:
            continue
        path, start = b.column(1).dictionary_encode(), b.column(2).to_numpy()
        code = path.indices.to_numpy()
        cuts = [0, *(np.nonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1]))[0] + 1), len(code)]
        for lo, hi in zip(cuts, cuts[1:]):
            yield path[lo].as_py(), int(start[lo]), b.column(0).slice(lo, hi - lo)


def _quotes(lines) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _count(batches):
    sums: dict = {}
    for path, start, lines in _segments(batches):
        sums[path, start] = sums.get((path, start), 0) + int(_quotes(lines).sum())
    if sums:
        paths, starts = zip(*sums)
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(starts, pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["path", "start", "quotes"])


def _assemble(batches, inside):
    """Rows (path, start, seq, begins, ends, first, text): whole records, and pieces of the others."""
    names = ["path", "start", "seq", "begins", "ends", "first", "text"]

    def rows(path, start, seq, begins, ends, first, texts):
        n = len(texts)
        cols = [[path] * n, [start] * n, seq, [begins] * n, [ends] * n, first, texts]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def piece(ends):
        begun = opened >= 0
        return rows(*at, [opened], begun, ends, [begun and at[1] == 0 and opened == 0], ["\n".join(held)])

    at, held, opened, odd, seq = None, [], -1, 0, 0  # the open record's lines here and its number, -1 if it began before this split
    for path, start, lines in _segments(batches):
        if at != (path, start):
            if held:
                yield piece(False)
            at, held, opened, seq = (path, start), [], -1, 0
            if start not in inside.get(path, {}):
                raise ValueError(f"{path}: a split begins at byte {start}, which the first pass did not see; read again")
            odd = inside[path][start]
        after = (odd + np.cumsum(_quotes(lines))) & 1
        before = np.concatenate([[odd], after[:-1]])
        number = seq + np.cumsum(before == 0) - 1  # of the record that a line begins
        begins = np.nonzero((before == 0) & (after == 1))[0]
        ends = np.nonzero((before == 1) & (after == 0))[0]
        if odd:  # the rest of the open record, as far as it is here
            held += lines.slice(0, int(ends[0]) + 1 if len(ends) else len(lines)).to_pylist()
            if len(ends):
                yield piece(True)
                held, ends = [], ends[1:]
        alone = (before == 0) & (after == 0)  # lines that are records
        texts = lines.filter(pa.array(alone)).to_pylist() + ["\n".join(lines.slice(lo, hi + 1 - lo).to_pylist()) for lo, hi in zip(begins, ends)]
        seqs = [int(x) for x in (*number[alone], *number[begins[: len(ends)]])]
        if texts:
            yield rows(path, start, seqs, True, True, [start == 0 and x == 0 for x in seqs], texts)
        if len(begins) > len(ends):
            held, opened = lines.slice(int(begins[-1])).to_pylist(), int(number[begins[-1]])
        seq += int((before == 0).sum())
        odd = int(after[-1])
    if held:
        yield piece(False)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of the files at ``path`` as text, headers left out."""
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    counts = lines.mapInArrow(_count, "path string, start long, quotes long")
    w = Window.partitionBy("path").orderBy("start")
    state = counts.withColumn("total", F.sum("quotes").over(w)).select("path", "start", ((F.col("total") - F.col("quotes")) % 2).cast("int").alias("odd"), (F.col("total") % 2).alias("last"))
    inside: dict = {}
    end: dict = {}
    for r in state.orderBy("path", "start").toLocalIterator():  # one row per split
        inside.setdefault(r["path"], {})[r["start"]] = r["odd"]
        end[r["path"]] = r["last"]
    unclosed = sorted(p for p, odd in end.items() if odd)
    if unclosed:
        raise ValueError(f"quotes that don't close in {unclosed[:3]}")
    shared = spark.sparkContext.broadcast(inside)
    schema = "path string, start long, seq long, begins boolean, ends boolean, first boolean, text string"
    made = lines.mapInArrow(lambda batches: _assemble(batches, shared.value), schema)
    pieces = made.filter(~(F.col("begins") & F.col("ends")))
    chain = F.sum(F.col("begins").cast("int")).over(w.orderBy("start", "seq"))
    parts = F.sort_array(F.collect_list(F.struct("start", "seq", "text")))
    joined = pieces.withColumn("chain", chain).groupBy("path", "chain").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"), F.max("first").alias("first"))
    whole = made.filter(F.col("begins") & F.col("ends")).select("text", "first").unionByName(joined.select("text", "first"))
    text = F.regexp_replace("text", "\r$", "")
    return whole.filter(~F.col("first")).select(text.alias("record")).filter("record <> ''")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A1: as ``files.read_csv`` with quoted line breaks, each file read by as many tasks as it has splits."""
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema.fields))
    parsed = records(spark, path).select(F.from_csv("record", fields, {"escape": '"', "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select(*(files.missing(F.col(f"r.c{i}"), f.dataType).alias(f.name) for i, f in enumerate(schema.fields)))
