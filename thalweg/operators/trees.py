"""Regression trees of many groups in one job, kept as rows of arrays.

A tree is a row: for each node the feature asked about, the threshold up to which a value goes left,
both children and the node's value; a leaf asks about no feature (-1).  So forests and boosted
ensembles of all stations are one table, stored, joined and counted like any other.

A group is one (location, forecast_days): one row a calendar day at most.  Its features are cut into
bins once, at quantiles, and a level of a tree is grown from sums by (node, feature, bin).  Scoring
brings a group's rows and trees together and walks all trees for a block of rows at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("location", "forecast_days")
TREES = "location string, forecast_days int, tree int, rows long, depth int, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
BINS = 64
#: A block of rows times trees that is walked at once.
BLOCK = 1 << 21


def cut_points(column: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins - 1`` thresholds, each halfway between two neighbouring values of the column."""
    known = np.unique(column)
    at = np.arange(len(known) - 1)
    if len(known) > bins:
        share = np.searchsorted(known, np.quantile(column, np.arange(1, bins) / bins, method="lower"))
        at = np.unique(share[share < len(known) - 1])
    return (known[at] + known[at + 1]) / 2


def grow(codes: np.ndarray, cuts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, columns: np.ndarray, depth: int, least: float, ridge: float, bins: int = BINS) -> dict:
    """One tree for the squared error, level by level; ``codes`` are the rows' bins by column.

    A node splits where that lowers the (ridge) error most, both sides keeping ``least`` weight.
    """
    tree = {"depth": 0, "feature": [-1], "threshold": [0.0], "left": [-1], "right": [-1], "value": [0.0]}
    rows = np.flatnonzero(weight > 0)
    at, level = np.zeros(len(rows), np.int64), [0]
    offset = np.arange(len(columns)) * bins
    for d in range(depth + 1):
        k = len(level)
        w = weight[rows]
        g, h = np.bincount(at, w * y[rows], k), np.bincount(at, w, k)
        for node, v in zip(level, g / (h + ridge), strict=True):
            tree["value"][node] = float(v)
        if d == depth:
            break
        cell = (at[:, None] * (len(columns) * bins) + offset + codes[np.ix_(rows, columns)]).ravel()
        sums = lambda v: np.bincount(cell, np.repeat(v, len(columns)), k * len(columns) * bins).reshape(k, len(columns), bins).cumsum(2)
        gl, hl = sums(w * y[rows]), sums(w)
        gr, hr = g[:, None, None] - gl, h[:, None, None] - hl
        whole = (g * g / (h + ridge))[:, None, None]
        gain = np.where((hl >= least) & (hr >= least), gl * gl / (hl + ridge) + gr * gr / np.maximum(hr + ridge, 1e-300) - whole, 0.0).reshape(k, -1)
        best = gain.argmax(1)
        split = np.flatnonzero(gain[np.arange(k), best] > 1e-9)
        if not len(split):
            break
        column, code = columns[best // bins], best % bins
        first = len(tree["value"])
        child = np.full(k, -1)
        child[split] = np.arange(len(split))
        for j, s in enumerate(split.tolist()):
            node = level[s]
            tree["feature"][node], tree["threshold"][node] = int(column[s]), float(cuts[column[s]][code[s]])
            tree["left"][node], tree["right"][node] = first + 2 * j, first + 2 * j + 1
        for name, blank in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", 0.0)):
            tree[name] += [blank] * (2 * len(split))
        tree["depth"] = d + 1
        keep = child[at] >= 0
        rows, at = rows[keep], at[keep]
        at = 2 * child[at] + (codes[rows, column[at]] > code[at])
        level = list(range(first, first + 2 * len(split)))
    return tree


def walk(x: np.ndarray, trees: list[dict]) -> np.ndarray:
    """The value of every tree for every row, as (rows, trees)."""
    size = np.array([len(t["value"]) for t in trees])
    start = np.cumsum(size) - size
    flat = {c: np.concatenate([np.asarray(t[c]) for t in trees]) for c in ("feature", "threshold", "left", "right", "value")}
    base = np.repeat(start, size)
    node = np.broadcast_to(start, (len(x), len(trees))).copy()
    row = np.arange(len(x))[:, None]
    for _ in range(max(t["depth"] for t in trees)):
        ask = flat["feature"][node]
        left = x[row, np.maximum(ask, 0)] <= flat["threshold"][node]
        node = np.where(ask < 0, node, base[node] + np.where(left, flat["left"][node], flat["right"][node]))
    return flat["value"][node]


def forest(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, trees: int = 100, depth: int = 30, min_leaf: int = 5) -> list[dict]:
    """Trees on samples drawn with replacement; every split may use every feature."""
    cuts = [cut_points(c) for c in x.T]
    codes = np.column_stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)])
    draws = (np.bincount(rng.integers(len(y), size=len(y)), minlength=len(y)).astype(float) for _ in range(trees))
    return [grow(codes, cuts, y, w, np.arange(x.shape[1]), depth, min_leaf, 0.0) for w in draws]


def boosted(
    x: np.ndarray, y: np.ndarray, rng: np.random.Generator, rounds: int = 1000, depth: int = 7, step: float = 0.1, rows: float = 0.7, columns: float = 0.8, least: float = 1.0, ridge: float = 1.0
) -> list[dict]:
    """Each tree on what the ones before leave, on a sample of rows and columns; the values add up to the prediction."""
    cuts = [cut_points(c) for c in x.T]
    codes = np.column_stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)])
    made, pred = [], np.full(len(y), y.mean())
    for k in range(rounds):
        use = np.sort(rng.choice(x.shape[1], max(1, round(columns * x.shape[1])), replace=False))
        tree = grow(codes, cuts, y - pred, (rng.random(len(y)) < rows).astype(float), use, depth, least, ridge)
        tree["value"] = [step * v for v in tree["value"]]
        pred += walk(x, [tree])[:, 0]
        if k == 0:  # the mean, from which the first round starts
            tree["value"] = [v + float(y.mean()) for v in tree["value"]]
        made.append(tree)
    return made


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(train: DataFrame, vector, method: Callable[..., list[dict]], seed: int = 0, **options) -> DataFrame:
    """A row per tree of every (location, forecast_days) in ``train``; rows without ``y`` are left out.

    One shuffle, one stage: groups are dealt to many tasks and fitted side by side.
    """
    spark = train.sparkSession
    names = [f.split()[0] for f in TREES.split(", ")]

    def grown(key, group):
        group = group.sort_by("date")
        location, horizon = (k.as_py() for k in key)
        rng = np.random.default_rng([seed, zlib.crc32((location or "").encode()), horizon or 0])
        made = method(_matrix(group.column("x")), group.column("y").to_numpy(), rng, **options)
        rows = [{"location": location, "forecast_days": horizon, "tree": k, "rows": group.num_rows, **t} for k, t in enumerate(made)]
        return pa.Table.from_pylist(rows, schema=arrow)

    arrow = pa.schema(
        [("location", pa.string()), ("forecast_days", pa.int32()), ("tree", pa.int32()), ("rows", pa.int64()), ("depth", pa.int32()), ("feature", pa.list_(pa.int32()))]
        + [("threshold", pa.list_(pa.float64())), ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32())), ("value", pa.list_(pa.float64()))]
    )
    rows = train.filter(F.col("y").isNotNull()).select(*[F.col(k).cast(t) for k, t in zip(KEYS, ("string", "int"), strict=True)], "date", vector.alias("x"), F.col("y").cast("double").alias("y"))
    # A given number of partitions isn't joined up by adaptive execution: the rows are few, the work on them is not.
    spread = rows.repartition(8 * spark.sparkContext.defaultParallelism, *KEYS)
    return spread.groupBy(*KEYS).applyInArrow(grown, TREES).select(*names)


def predict(trees: DataFrame, rows: DataFrame, vector, mean: bool) -> DataFrame:
    """``rows`` with ``y``, the mean (and ``y_var``, the trees' mean squared distance from it) or the sum of their
    group's trees; rows of groups without trees are left out."""
    rows = rows.drop("y", "y_var")
    made = [T.StructField(c, T.DoubleType()) for c in (("y", "y_var") if mean else ("y",))]
    schema = T.StructType([*rows.schema.fields, *made])

    def scored(group, held):
        out: dict[str, list] = {f.name: [np.zeros(0)] for f in made}
        if held.num_rows and group.num_rows:
            known = held.sort_by("tree").select(["depth", "feature", "threshold", "left", "right", "value"]).to_pylist()
            x = _matrix(group.column("_x"))
            size = max(1, BLOCK // len(known))
            for k in range(0, len(x), size):
                votes = walk(x[k : k + size], known)
                y = votes.mean(1) if mean else votes.sum(1)
                out["y"].append(y)
                if mean:
                    out["y_var"].append(((votes - y[:, None]) ** 2).mean(1))
        kept = group.drop_columns(["_x"]).slice(0, group.num_rows if held.num_rows else 0)
        for name, parts in out.items():
            kept = kept.append_column(name, pa.array(np.concatenate(parts)))
        return kept

    left = rows.withColumn("_x", vector).groupBy(*KEYS)
    return left.cogroup(trees.groupBy(*KEYS)).applyInArrow(scored, schema)


def tree_values(trees: DataFrame, rows: DataFrame, vector) -> DataFrame:
    """(location, date, forecast_days, tree, value): what each single tree says; a row per row and tree, for checks."""
    node = F.struct("feature", "threshold", "left", "right", "value").alias("t")
    pairs = rows.select(*KEYS, "date", vector.alias("x")).join(trees.select(*KEYS, "tree", "depth", node), list(KEYS))
    ask = lambda n: F.get("t.feature", n)
    goes = lambda n: F.when(F.get("x", ask(n)) <= F.get("t.threshold", n), F.get("t.left", n)).otherwise(F.get("t.right", n))
    steps = F.when(F.col("depth") > 0, F.sequence(F.lit(1), F.col("depth"))).otherwise(F.array().cast("array<int>"))
    leaf = F.aggregate(steps, F.lit(0), lambda n, _: F.when(ask(n) < 0, n).otherwise(goes(n)))
    return pairs.select(*KEYS, "date", "tree", F.get("t.value", leaf).alias("value"))
