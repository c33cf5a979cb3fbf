"""Joins with a table of keys of which a few are very frequent.

A shuffled join sends all rows of a key to one task; a key that a third of the
rows hold makes that task the bottleneck. ``split_join`` knows each key's row
count: the frequent keys meet their rows by broadcast, in the task that has
them, and only the rows of the others are shuffled. The split is by counts of
this table alone, both parts are exact, and the broadcast is bounded in rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the frequent part; wide keys should come with fewer.
FREQUENT_ROWS = 200_000

#: Bytes of text whose tokens one task counts.
TASK_BYTES = 4 << 20


def text_tasks(df: DataFrame, text_col: str, task_bytes: int | None = None) -> int:
    """How many tasks take at most ``task_bytes`` of the texts each, on average: a
    scan of the texts' lengths, one number to the driver."""
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(total / (task_bytes or TASK_BYTES)), min(cores, math.ceil(total / (1 << 18))))


def frequent_cut(keys: DataFrame, weight: str, rows: int = FREQUENT_ROWS) -> int | None:
    """The least power of two such that at most ``rows`` keys have a ``weight``
    of it or more; 0 when all do, None when not even the heaviest octave fits
    (then no key holds more than 2 / ``rows`` of the total)."""
    octave = F.floor(F.log2(F.greatest(F.col(weight), F.lit(1)).cast("double"))).cast("int")
    counts = dict(keys.groupBy(octave.alias("o")).agg(F.count("*")).collect())  # at most 63 rows
    if sum(counts.values()) <= rows:
        return 0
    taken, cut = 0, None
    for o in sorted(counts, reverse=True):
        taken += counts[o]
        if taken > rows:
            break
        cut = 1 << o
    return cut


def split_join(left: DataFrame, keys: DataFrame, on: list[str], weight: str, rows: int = FREQUENT_ROWS) -> DataFrame:
    """Inner join of ``left`` with ``keys`` (one row per key, ``weight`` its row
    count in ``left``; both stored, as each is read more than once). The result
    has the columns of both, without ``weight``."""
    cut = frequent_cut(keys, weight, rows)
    if cut == 0:
        return left.join(F.broadcast(keys.drop(weight)), on)
    rare = keys if cut is None else keys.where(F.col(weight) < cut)
    if cut is None:
        return left.join(rare.drop(weight).hint("shuffle_merge"), on)
    frequent = F.broadcast(keys.where(F.col(weight) >= cut))
    by_broadcast = left.join(frequent.drop(weight), on)
    by_shuffle = left.join(frequent.select(*on), on, "left_anti").join(rare.drop(weight).hint("shuffle_merge"), on)
    return by_broadcast.unionByName(by_shuffle)
