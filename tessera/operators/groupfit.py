"""A model of one's own in every group (K3), without gathering a group.

A model is an object with four methods on NumPy arrays; states and parameters are
one-dimensional arrays of doubles of any length:

* ``part(x, ids, params)``: the state of some rows of a group;
* ``merge(a, b)``: the state of both;
* ``finish(state, params)``: the group's parameters after a pass;
* ``apply(x, params)``: one number per row (``apply_groups``);

and ``passes``, how often the rows are read; ``params`` is None in the first.

A task keeps one state per group that it meets and sends its states on when they
pass ``STATE_BYTES``; only states are shuffled. The states of a group are merged
in two steps, the first over ``FAN`` salts, one after the other as they stream by, so
neither its rows nor its states are ever held together: a group may hold any share
of the table. Parameters meet the rows of the next pass by broadcast
while they fit in ``PARAM_BYTES``; beyond, rows are shuffled by group and salt, and
a group's parameters come once, ahead of its rows.

Defined cases: NULL is a group like any other value of the keys; rows with a NULL id,
a NULL or empty vector or components that are NULL or not finite are left out, a group
of such rows alone is not in the result; repeated rows count as often as they come; an
empty table gives an empty result; columns other than those named are not
read. Vectors have one length. A task rerun after an executor is lost gives the same state.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import similarity as S
from .skew import split_join

# Fixed parameters.
STATE_BYTES = 64 << 20            # states a task holds
PARAM_BYTES = 64 << 20            # parameters of all groups that are broadcast
SALT_ROWS = 1_000_000             # rows of a group and salt where parameters are not broadcast
FAN = 64                          # salts of the first merge


def _rows(df: DataFrame, keys: list[str], id_col: str, vec_col: str) -> DataFrame:
    """(name, id, vec): usable rows, ``name`` the group's keys as text."""
    name = F.to_json(F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))), {"ignoreNullFields": "false"})
    rows = df.select(name.alias("name"), F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda v: v.cast("double")).alias("vec"))
    return rows.filter(F.col("id").isNotNull() & (F.size("vec") > 0)).filter(F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))


def _groups(names) -> list[tuple[str, np.ndarray]]:
    """Each name of a column and the places of its rows."""
    coded = names.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    cuts = np.nonzero(np.diff(code[order]))[0] + 1
    return [(coded.dictionary[int(code[at[0]])].as_py(), at) for at in np.split(order, cuts)] if len(code) else []


def _by_group(rows: DataFrame, params: DataFrame | None, kernel, schema: str) -> DataFrame:
    """``kernel`` over (name, ids, x, params) of chunks of rows of a group, each with the group's parameters."""
    spark = rows.sparkSession
    bytes_held = 0 if params is None else params.agg(F.coalesce(F.sum(F.size("params") * 8 + F.length("name")), F.lit(0))).first()[0]
    if bytes_held <= PARAM_BYTES:
        known = {} if params is None else {r["name"]: np.array(r["params"]) for r in params.select("name", "params").toLocalIterator()}
        shared, first = spark.sparkContext.broadcast(known), params is None

        def met(batches):
            known = shared.value

            def chunks():
                for b in batches:
                    ids, x = b.column(1).to_numpy(), S.matrix(b.column(2))
                    for name, at in _groups(b.column(0)):
                        if first or name in known:
                            yield name, ids[at], x[at], known.get(name)

            return kernel(chunks())

        return rows.mapInArrow(met, schema)
    salts = cut_lineage(rows.groupBy("name").agg(F.count("*").alias("n")).join(params.select("name"), "name").withColumn("salts", F.ceil(F.col("n") / SALT_ROWS).cast("int")))
    salted = split_join(rows, salts, ["name"], "n").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    ahead = params.join(salts, "name").select("name", F.lit(None).cast("long").alias("id"), F.col("params").alias("vec"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    both = salted.select("name", "id", "vec", "salt").unionByName(ahead).repartition("name", "salt").sortWithinPartitions("name", "salt", F.col("id").asc_nulls_first())

    def streamed(batches):
        def chunks():
            held = None
            for b in batches:
                new = np.nonzero(b.column(1).is_null().to_numpy(zero_copy_only=False))[0]
                cuts = sorted({0, *new.tolist(), *(new + 1).tolist(), b.num_rows})
                for lo, hi in zip(cuts, cuts[1:]):
                    piece = b.slice(lo, hi - lo)
                    if piece.column(1)[0].as_py() is None:
                        held = piece.column(2)[0].values.to_numpy(zero_copy_only=False)
                    else:
                        yield piece.column(0)[0].as_py(), piece.column(1).to_numpy(), S.matrix(piece.column(2)), held

        return kernel(chunks())

    return both.select("name", "id", "vec").mapInArrow(streamed, schema)


def _merged(states: DataFrame, merge, *by: str) -> DataFrame:
    """One state per (name, salt), merged as the sorted states stream by."""

    def run(batches):
        at, held = None, None
        for b in batches:
            for name, salt, state in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                state = state.values.to_numpy(zero_copy_only=False)
                if at == (name, salt):
                    held = merge(held, state)
                    continue
                if at is not None:
                    yield _state_rows([at[0]], [at[1]], [held])
                at, held = (name, salt), np.array(state)
        if at is not None:
            yield _state_rows([at[0]], [at[1]], [held])

    return states.repartition(*by).sortWithinPartitions("name", "salt", "part").select("name", "salt", "state").mapInArrow(run, "name string, salt int, state array<double>")


def _state_rows(names, salts, states):
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(salts, pa.int32()), pa.array(states, pa.list_(pa.float64()))], names=["name", "salt", "state"])


def fit_groups(df: DataFrame, keys: list[str], id_col: str, vec_col: str, model) -> DataFrame:
    """(name, *keys, params): ``model`` fitted in every group of ``keys``, which can't be called so themselves."""
    if {"name", "params", "_name"} & set(keys):
        raise ValueError("keys named name, params or _name: rename them")
    rows = _rows(df, keys, id_col, vec_col)

    def states(chunks):
        held, size = {}, 0
        salt = TaskContext.get().partitionId() % FAN

        def send():
            return _state_rows(list(held), [salt] * len(held), list(held.values()))

        for name, ids, x, params in chunks:
            state = np.asarray(model.part(x, ids, params), np.float64)
            before = held.get(name)
            held[name] = state if before is None else model.merge(before, state)
            size += held[name].nbytes - (0 if before is None else before.nbytes)
            if size > STATE_BYTES:
                yield send()
                held, size = {}, 0
        if held:
            yield send()

    def finish(batches):
        for b in batches:
            done = [model.finish(s.values.to_numpy(zero_copy_only=False), p.values.to_numpy(zero_copy_only=False) if p.is_valid else None) for s, p in zip(b.column(1), b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.asarray(d, np.float64) for d in done], pa.list_(pa.float64()))], names=["name", "params"])

    params = None
    for _ in range(model.passes):
        parts = _by_group(rows, params, states, "name string, salt int, state array<double>").withColumn("part", F.spark_partition_id())
        salted = _merged(parts, model.merge, "name", "salt")
        whole = _merged(salted.withColumnRenamed("salt", "part").withColumn("salt", F.lit(0)), model.merge, "name").select("name", "state")
        known = whole.withColumn("params", F.lit(None).cast("array<double>")) if params is None else whole.join(params, "name")
        params = cut_lineage(known.select("name", "state", "params").mapInArrow(finish, "name string, params array<double>"))
    named = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    text = F.to_json(F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))), {"ignoreNullFields": "false"})
    renamed = named.select(text.alias("_name"), *keys)
    return params.join(renamed, params["name"] == renamed["_name"]).select("name", *keys, "params")


def apply_groups(df: DataFrame, keys: list[str], id_col: str, vec_col: str, fitted: DataFrame, model) -> DataFrame:
    """(id, value): ``model.apply`` of every row with its group's parameters."""

    def values(chunks):
        for _, ids, x, params in chunks:
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.asarray(model.apply(x, params), np.float64))], names=["id", "value"])

    return _by_group(_rows(df, keys, id_col, vec_col), fitted.select("name", "params"), values, "id long, value double")


# ---------------------------------------------------------------- two models


class PrincipalAxis:
    """The direction of a group's largest variance; ``params`` = (n, variance, mean, axis), the axis' largest
    component positive. Means and scatter are merged about their own means, so data far from the origin keep their digits."""

    passes = 1

    def part(self, x, ids, params):
        mean = x.mean(axis=0)
        y = x - mean
        return np.concatenate([[len(x)], mean, (y.T @ y).ravel()])

    def merge(self, a, b):
        d = int(round((-1 + np.sqrt(1 + 4 * (len(a) - 1))) / 2))
        n, step = a[0] + b[0], b[1 : d + 1] - a[1 : d + 1]
        scatter = a[d + 1 :] + b[d + 1 :] + (np.outer(step, step) * (a[0] * b[0] / n)).ravel()
        return np.concatenate([[n], a[1 : d + 1] + step * (b[0] / n), scatter])

    def finish(self, state, params):
        d = int(round((-1 + np.sqrt(1 + 4 * (len(state) - 1))) / 2))
        size, axes = np.linalg.eigh(state[d + 1 :].reshape(d, d) / state[0])
        axis = axes[:, -1] * (1 if axes[np.abs(axes[:, -1]).argmax(), -1] > 0 else -1)
        return np.concatenate([[state[0], max(size[-1], 0.0)], state[1 : d + 1], axis])

    def apply(self, x, params):
        d = x.shape[1]
        return (x - params[2 : d + 2]) @ params[d + 2 :]


class KMeans:
    """k-means in a group: the first centres are k different vectors drawn by a hash of the id, then ``rounds``
    rounds; ``params`` = the centres one after the other (fewer where a group has fewer vectors)."""

    def __init__(self, k: int, rounds: int = 10):
        self.k, self.passes = k, rounds + 1

    def _draw(self, rows):
        """The k different vectors with the smallest keys, in order; rows are (key, vector)."""
        rows = rows[np.lexsort(rows.T[::-1])]
        first = np.unique(rows[:, 1:], axis=0, return_index=True)[1]
        return rows[np.sort(first)[: self.k]]

    def part(self, x, ids, params):
        dim = x.shape[1]
        if params is None:
            z = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            rows = np.column_stack([((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64), x])
            return np.concatenate([[dim], self._draw(rows).ravel()])
        centres = params.reshape(-1, dim)
        near = S._sq_distances(x - centres[0], centres - centres[0]).argmin(axis=1)
        sums = np.zeros((len(centres), dim + 1))
        np.add.at(sums, near, np.column_stack([np.ones(len(x)), x - centres[near]]))
        return np.concatenate([[-1.0], sums.ravel()])

    def merge(self, a, b):
        if a[0] < 0:
            return np.concatenate([[-1.0], a[1:] + b[1:]])
        width = int(a[0]) + 1
        return np.concatenate([a[:1], self._draw(np.vstack([a[1:].reshape(-1, width), b[1:].reshape(-1, width)])).ravel()])

    def finish(self, state, params):
        if params is None:
            return state[1:].reshape(-1, int(state[0]) + 1)[:, 1:].ravel()
        k = len(state) - 1 - len(params)  # a count more than the components of each centre
        sums = state[1:].reshape(k, -1)
        n = sums[:, :1]
        return (params.reshape(len(sums), -1) + np.where(n > 0, sums[:, 1:] / np.maximum(n, 1), 0.0)).ravel()

    def apply(self, x, params):
        centres = params.reshape(-1, x.shape[1])
        return S._sq_distances(x - centres[0], centres - centres[0]).argmin(axis=1).astype(np.float64)
