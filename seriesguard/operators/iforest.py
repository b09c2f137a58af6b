"""Isolation forest (M1; Liu, Ting & Zhou 2008): each tree sees at most 256 sampled rows.

All random choices are digests of numbers: of (tree, j) for the j-th sampled row, drawn from the j-th of 256 equal spans of
the series, and of (tree, node) for a node's feature and cut. A series therefore gives the same forest on any engine, whether
it is handled in one group or, when long, by sampling, growing and scoring in separate distributed steps.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach, cogrouped
from seriesguard.operators.bundles import per_series
from seriesguard.operators.features import FEATURES, stored_features

SAMPLE = 256
LOCAL_ROWS = 20_000
CHUNK_ROWS = 100_000


@lru_cache(maxsize=4096)
def chances(what: str, tree: int, n: int) -> np.ndarray:
    """Numbers in [0, 1) for the places 0 to n - 1 of a tree: 32 bits of the MD5 digest of 'what:tree:place'."""
    digests = (hashlib.md5(f"{what}:{tree}:{j}".encode()).hexdigest()[:8] for j in range(n))
    return np.fromiter((int(d, 16) / 2.0 ** 32 for d in digests), float, n)


def draw(rows: int, tree: int) -> np.ndarray:
    """Row numbers a tree is grown on, without repetition, ascending: all rows, or one from each of SAMPLE spans."""
    if rows <= SAMPLE:
        return np.arange(rows)
    return np.floor((np.arange(SAMPLE) + chances("row", tree, SAMPLE)) * rows / SAMPLE).astype(np.int64)


def usual_depth(rows: np.ndarray | float) -> np.ndarray:
    """Average path length of an unsuccessful search among ``rows`` rows."""
    rows = np.asarray(rows, float)
    many = np.maximum(rows, 3.0)
    usual = 2.0 * (np.log(many - 1.0) + np.euler_gamma) - 2.0 * (many - 1.0) / many
    return np.where(rows > 2, usual, np.where(rows == 2, 1.0, 0.0))


@lru_cache(maxsize=64)
def chance_table(what: str, trees: int, n: int) -> np.ndarray:
    return np.stack([chances(what, t, n) for t in range(trees)])


def grow(rows: np.ndarray, picks: np.ndarray) -> dict[str, np.ndarray]:
    """Grow one tree on each set of picked rows (trees x row numbers), all trees level by level.

    Node c of a tree has the children 2c + 1 and 2c + 2. Leaves hold their expected path length,
    inner nodes -1.
    """
    (n_trees, size), width = picks.shape, rows.shape[1]
    depth = math.ceil(math.log2(max(size, 2)))
    shape = (n_trees, 2 ** (depth + 1) - 1)
    split, cut = np.zeros(shape, np.int32), np.zeros(shape)
    # a node without sampled rows, which rounding of a cut can leave, is a leaf
    length = np.tile(np.floor(np.log2(np.arange(shape[1]) + 1)), (n_trees, 1))
    of_feature, of_cut = (chance_table(what, *shape) for what in ("feature", "cut"))
    # extremes are found among ranks, which are small numbers
    ordered, sides = np.sort(rows, axis=0), np.arange(width)
    ranks = np.column_stack([np.searchsorted(ordered[:, j], rows[:, j]) for j in sides]).astype(np.min_scalar_type(len(rows)))
    at_row, tree, node = picks.ravel(), np.arange(n_trees), np.zeros(n_trees, np.int64)
    start = np.arange(n_trees) * size
    for level in range(depth + 1):
        count = np.diff(np.r_[start, len(at_row)])
        there = ranks.take(at_row, axis=0)
        low = ordered[np.minimum.reduceat(there, start), sides]
        high = ordered[np.maximum.reduceat(there, start), sides]
        every = np.arange(len(start))
        # a random feature among those that still vary, and a random cut inside its range
        varies = high > low
        rank = np.floor(of_feature[tree, node] * varies.sum(axis=1)).astype(np.int64)
        feature = (np.cumsum(varies, axis=1) > rank[:, None]).argmax(axis=1)
        leaf = ~varies.any(axis=1) | (count <= 1) | (level == depth)
        low, high = low[every, feature], high[every, feature]
        at = low + of_cut[tree, node] * (high - low)
        split[tree, node], cut[tree, node] = feature, at
        length[tree, node] = np.where(leaf, level + usual_depth(count), -1.0)
        group = np.repeat(every, count)
        stays = ~leaf[group]
        at_row, group = at_row[stays], group[stays]
        if not len(at_row):
            break
        side = 2 * group + (rows[at_row, feature[group]] > at[group])
        order = np.argsort(side.astype(np.min_scalar_type(2 * len(start))), kind="stable")
        at_row, side = at_row[order], side[order]
        start = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
        parent, above = side[start] >> 1, side[start] & 1
        tree, node = tree[parent], 2 * node[parent] + 1 + above
    return {"split": split, "cut": cut, "length": length}


def anomaly_scores(rows: np.ndarray, forest: dict[str, np.ndarray], sampled: int) -> np.ndarray:
    """Score in (0, 1]: two to the minus average path length over its expectation."""
    split, cut, length = forest["split"], forest["cut"], forest["length"]
    trees = np.arange(len(split))[:, None]
    mean = np.empty(len(rows))
    for first in range(0, len(rows), 2048):
        part = rows[first:first + 2048]
        every = np.arange(len(part))[None, :]
        node = np.zeros((len(split), len(part)), np.int64)
        while True:
            inner = length[trees, node] < 0
            if not inner.any():
                break
            above = part[every, split[trees, node]] > cut[trees, node]
            node = np.where(inner, 2 * node + 1 + above, node)
        mean[first:first + 2048] = length[trees, node].mean(axis=0)
    usual = float(usual_depth(sampled))
    return np.exp2(-mean / usual) if usual > 0 else np.full(len(rows), 0.5)


def iforest_scores(frame: SeriesFrame, window: int = 10, n_estimators: int = 100,
                   local_rows: int = LOCAL_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Keys, position and score. Path lengths ignore the scale of a feature: raw features do."""
    keys, profile = list(frame.keys), frame.profile
    rows = stored_features(frame, window)
    schema = rows.select(*keys, "i").withColumn("score", F.lit(0.0)).schema
    if profile.longest - window <= local_rows:
        return per_series(rows, keys, profile.total, _whole_series(n_estimators), schema)
    sizes = frame.valid.groupBy(*keys).agg((F.count(F.lit(1)) - window).alias("_m")).where(F.col("_m") > 0)
    sized = attach(rows, sizes, keys, profile.n_series)
    short = sized.where(F.col("_m") <= local_rows).drop("_m")
    n_long = profile.series_longer_than(local_rows)
    long = sized.where(F.col("_m") > local_rows)
    return per_series(short, keys, profile.total, _whole_series(n_estimators), schema).unionByName(
        _long_series(long, sizes.where(F.col("_m") > local_rows), keys, n_long, window,
                     n_estimators, chunk_rows, schema))


def _whole_series(n_estimators: int):
    def run(x: np.ndarray) -> dict[str, np.ndarray]:
        forest = grow(x, np.stack([draw(len(x), t) for t in range(n_estimators)]))
        return {"score": anomaly_scores(x, forest, min(SAMPLE, len(x)))}

    return run


def _long_series(rows: DataFrame, sizes: DataFrame, keys: list[str], n_long: int, window: int,
                 n_estimators: int, chunk_rows: int, schema) -> DataFrame:
    def draws(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for j in range(len(part)):
                named = part.iloc[j]
                at = np.stack([draw(int(named["_m"]), t) for t in range(n_estimators)])
                yield pd.DataFrame({**{k: named[k] for k in keys}, "i": at.ravel() + window,
                                    "_draw": np.arange(at.size)})

    def grown(part: pd.DataFrame) -> pd.DataFrame:
        x = part.sort_values("_draw")[list(FEATURES)].to_numpy()
        forest = grow(x, np.arange(len(x)).reshape(n_estimators, -1))
        return part[keys].iloc[:1].assign(**{name: [a.ravel()] for name, a in forest.items()})

    def score(part: pd.DataFrame, forests: pd.DataFrame) -> pd.DataFrame:
        forest = {name: np.asarray(forests[name].iloc[0]).reshape(n_estimators, -1)
                  for name in ("split", "cut", "length")}
        x = part[list(FEATURES)].to_numpy()
        return part[[*keys, "i"]].assign(score=anomaly_scores(x, forest, SAMPLE))

    key_types = ", ".join(f"`{k}` {schema[k].dataType.simpleString()}" for k in keys)
    picks = sizes.mapInPandas(draws, f"{key_types}, i long, _draw int")
    sampled = attach(rows.drop("_m"), picks, [*keys, "i"], n_long * n_estimators * SAMPLE)
    # n_estimators * 256 rows at most per group
    forests = sampled.groupBy(*keys).applyInPandas(
        grown, f"{key_types}, split array<int>, cut array<double>, length array<double>")
    # every chunk of rows meets its own copy of the forest, so a long series is many groups
    chunks = sizes.select(*keys, F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(_m + {window} - 1) div {chunk_rows}"))).alias("_chunk"))
    spread = chunks.join(forests, keys)
    chunked = rows.drop("_m").withColumn("_chunk", F.expr(f"i div {chunk_rows}"))
    return cogrouped(chunked, spread, [*keys, "_chunk"], score, schema)
