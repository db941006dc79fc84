"""Whitening of embeddings by the covariance of their distinct vectors.

Entries are put on a grid of whole numbers, so that equal vectors are found by grouping and sums are
exact.  Every distinct vector is one row with its multiplicity; the covariance weighs it by that count
or by one.  Tasks multiply centred blocks of vectors and add the products up, the rows of the products
are summed by their number, and the driver decomposes a matrix as wide as a vector, whatever the table.
Each distinct vector is whitened once and joined back to its rows.

Rows whose vector is null or holds a null or an entry that isn't finite are left out; all others come
back.  Vectors of another length are another space, fitted on their own; an empty vector has no component.
Repeated vectors, also with the same id, come back as often as they are there.  Components without
variance (one distinct vector, or fewer than dimensions) have a null ``whitened``; without any variance
``explained`` is null too.  An empty table gives an empty result.  An entry too large for the grid raises.
Further columns, whatever their names, are carried in one struct.

A vector that a large part of all rows shares has few companions: at most ``HOT`` vectors have more than
a ``HOT``-th of all rows each, and only these are joined by broadcast; every other key is that small.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.common import stored
from thalweg.llm.registry import query, table

STEPS, SHIFT = 64, 1_000_000
HOT = 1_024


class Axes(NamedTuple):
    """A fitted space: fit list's weight, exact sums, unit eigenvectors as columns and their eigenvalues, falling."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        total = float(self.values.sum())
        return self.values / total if total > 0 else np.full(len(self.values), np.nan)

    @property
    def usable(self) -> np.ndarray:
        """Components with more variance than rounding leaves."""
        most = float(self.values.max(initial=0.0))
        return self.values > max(most, 0.0) * len(self.values) * np.finfo(float).eps * 8


def gridded(rows: DataFrame, vector: str = "embedding", steps: int = STEPS, shift: int = SHIFT) -> DataFrame:
    """The rows whose vector is whole, as (row, x): all columns in a struct and the vector on the grid."""
    named = [f"c{k}" for k in range(len(rows.columns))]
    packed = rows.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(rows.columns, named, strict=True)]).alias("row"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    whole = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    fits = lambda e: F.when(F.abs(e * float(steps)) < float(1 << 62), F.floor(e * float(steps)) + shift).otherwise(F.raise_error("an entry is too large for the grid").cast("long"))
    return packed.filter(F.col("v").isNotNull() & whole).select("row", F.transform("v", fits).alias("x"))


def _matrix(column) -> np.ndarray:
    """A list column whose lists are equally long, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _by_length(batch, column: str):
    """(length, rows, matrix) of each length of vector in a batch."""
    lists = batch.column(column)
    size = np.diff(np.asarray(lists.offsets))
    for d in np.unique(size):
        if d:
            at = np.flatnonzero(size == d)
            yield int(d), at, _matrix(lists if len(at) == len(size) else lists.take(pa.array(at)))


def _weights(batch, at) -> np.ndarray:
    return np.asarray(batch.column("weight").to_numpy(zero_copy_only=False))[at]


def sums(distinct: DataFrame, column: str) -> dict[int, tuple[int, np.ndarray]]:
    """By length of vector: the weight of all and the weighted sums, exact where entries are whole."""
    whole = distinct.schema[column].dataType.elementType.simpleString() == "bigint"
    kind = "long" if whole else "double"

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for d, at, x in _by_length(batch, column):
                w = _weights(batch, at)
                total = held.setdefault(d, [0, np.zeros(d, x.dtype)])
                total[0] += int(w.sum())
                total[1] += (w[:, None] * x).sum(0)
        for d, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(np.arange(d, dtype=np.int32)), pa.array([n] * d, pa.int64()), pa.array(s)], names=["d", "i", "n", "s"])

    out: dict[int, tuple[int, np.ndarray]] = {}
    found = distinct.select("weight", column).mapInArrow(run, f"d int, i int, n long, s {kind}").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    for r in found.collect():
        out.setdefault(r["d"], (r["n"], np.zeros(r["d"], np.int64 if whole else np.float64)))[1][r["i"]] = r["s"]
    return out


def covariances(distinct: DataFrame, column: str, totals: dict[int, tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """By length: the weighted covariance, divisor the weight, every vector centred before it is multiplied."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, at, x in _by_length(batch, column):
                n, s = totals[d]
                # Whole numbers are moved by a whole number first, so that the mean's fraction isn't rounded away.
                base = s // n if x.dtype == np.int64 else np.zeros(d)
                c = (x - base).astype(np.float64) - (s - base * n) / n
                held[d] = held.get(d, 0.0) + (c * _weights(batch, at)[:, None]).T @ c
        for d, c in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(np.arange(d, dtype=np.int32)), pa.array(list(c), pa.list_(pa.float64()))], names=["d", "i", "c"])

    def add(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, i, c in zip(*(batch.column(k).to_pylist() for k in ("d", "i")), batch.column("c"), strict=True):
                held[d, i] = held.get((d, i), 0.0) + np.asarray(c.values)
        if held:
            keys = list(held)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([held[k] for k in keys], pa.list_(pa.float64()))], names=["d", "i", "c"])

    schema = "d int, i int, c array<double>"
    # A task adds up rows as they come and keeps one line of the matrix for each key.
    found = distinct.select("weight", column).mapInArrow(run, schema).repartition("d", "i").mapInArrow(add, schema)
    out: dict[int, np.ndarray] = {}
    for r in found.collect():
        out.setdefault(r["d"], np.zeros((r["d"], r["d"])))[r["i"]] = r["c"]
    return {d: c / totals[d][0] for d, c in out.items()}


def axes(distinct: DataFrame) -> dict[int, Axes]:
    """The spaces of (x, weight), by length of vector."""
    totals = sums(distinct, "x")
    out = {}
    for d, c in covariances(distinct, "x", totals).items():
        values, vectors = np.linalg.eigh((c + c.T) / 2)
        out[d] = Axes(*totals[d], np.ascontiguousarray(vectors[:, ::-1]), np.maximum(values[::-1], 0.0))
    return out


def projected(distinct: DataFrame, spaces: dict[int, Axes], components: int) -> DataFrame:
    """``distinct`` with (deviation, whitened) of every vector; no shuffle."""
    keep = distinct.columns
    shared = distinct.sparkSession.sparkContext.broadcast(spaces)  # a matrix as wide as a vector

    def run(batches):
        for batch in batches:
            deviation, whitened = [0] * batch.num_rows, [[] for _ in range(batch.num_rows)]
            for d, at, x in _by_length(batch, "x"):
                space = shared.value[d]
                k = min(components, d)
                base = space.sums // space.n
                left, near = space.sums - base * space.n, x - base
                if d * (int(np.abs(near).max()) * space.n + int(np.abs(left).max())) ** 2 >= 1 << 63:
                    away = [sum((int(v) * space.n - int(r)) ** 2 for v, r in zip(row, left, strict=True)) for row in near]
                else:
                    away = ((near * space.n - left) ** 2).sum(1).tolist()
                scale = np.sqrt(space.values[:k], where=space.usable[:k], out=np.full(k, np.nan))
                made = (near.astype(np.float64) - left / space.n) @ space.vectors[:, :k] / scale
                for j, row, far in zip(at.tolist(), made, away, strict=True):
                    deviation[j], whitened[j] = far, row
            flat = np.concatenate(whitened) if len(whitened) else np.zeros(0)
            ends = np.concatenate([[0], np.cumsum([len(w) for w in whitened])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.float64), from_pandas=True))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(deviation, pa.int64()), lists], names=[*keep, "deviation", "whitened"])

    return distinct.mapInArrow(run, "x array<bigint>, copies long, weight long, deviation long, whitened array<double>")


def identity_errors(whitened: DataFrame, spaces: dict[int, Axes], components: int) -> dict[int, float | None]:
    """By length: how far the covariance of the usable whitened components is from the identity."""
    out: dict[int, float | None] = dict.fromkeys(spaces)
    # Components without variance are null: as zeros they stay apart from all others.
    rows = whitened.select("weight", F.transform("whitened", lambda w: F.coalesce(w, F.lit(0.0))).alias("w"), F.size("x").alias("d"))
    for d, space in spaces.items():
        k = min(components, d)
        use = space.usable[:k]
        if use.any():
            own = rows.filter(F.col("d") == d)
            c = covariances(own, "w", sums(own, "w"))[k]
            out[d] = float(np.abs(c[np.ix_(use, use)] - np.eye(int(use.sum()))).max())
    return out


def whiten(rows: DataFrame, vector: str = "embedding", components: int = 16, weights: str = "one", steps: int = STEPS, shift: int = SHIFT) -> DataFrame:
    """(row, x, copies, n, deviation, whitened, explained, identity_error) of every row with a whole vector.

    ``whitened`` and ``explained`` are arrays over the components by falling variance, ``deviation`` is the
    exact squared distance of n times the vector from the sum, ``weights`` is "one" or "counts".
    """
    if weights not in ("one", "counts"):
        raise ValueError(weights)
    spark = rows.sparkSession
    points = gridded(rows, vector, steps, shift)
    distinct = points.groupBy("x").agg(F.count("*").alias("copies"))
    distinct = stored(distinct.withColumn("weight", F.lit(1).cast("long") if weights == "one" else F.col("copies")), "vectors")
    spaces = axes(distinct)
    made = stored(projected(distinct, spaces, components), "whitened")
    errors = identity_errors(made, spaces, components)
    facts = [(d, s.n, [float(e) if e == e else None for e in s.explained[: min(components, d)]], errors[d]) for d, s in spaces.items()]
    known = F.broadcast(spark.createDataFrame(facts, "d int, n long, explained array<double>, identity_error double"))  # a row per length
    made = made.join(known, F.size("x") == F.col("d"), "left").drop("d", "weight")
    floor = (made.agg(F.sum("copies")).first()[0] or 0) // HOT
    hot = made.filter(F.col("copies") > floor)
    return _attach(points, made.filter(F.col("copies") <= floor), hot, rows.columns)


def _attach(points: DataFrame, rare: DataFrame, hot: DataFrame, names: list[str]) -> DataFrame:
    """Whitened vectors joined back to their rows: the hot ones by broadcast, the others by a shuffle on the vector."""
    named = [c for c in rare.columns if c != "x"]
    few = F.broadcast(hot.select("x", F.struct(*named).alias("f")))
    marked = points.join(few, "x", "left")
    back = lambda df: df.select(F.struct(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(names)]).alias("row"), "x", "f.*")
    cold = marked.filter("f IS NULL").drop("f").join(rare.select("x", F.struct(*named).alias("f")), "x")
    return back(marked.filter("f IS NOT NULL")).unionByName(back(cold))


@query("op11_embedding_whitening")
def embedding_whitening(spark, sf):
    """The first 16 whitened components of every embedding, one row each."""
    made = whiten(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    each = made.select(F.col("row.vec_id").alias("vec_id"), "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
