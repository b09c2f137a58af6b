"""One-class boundary (M4; Schölkopf et al. 2001) on standardised features.

A series is represented by at most ``landmarks`` of its rows, chosen by a hash of their position; every row counts as
weight of its nearest landmark, so all rows take part in the fit. The weighted dual is solved exactly over the landmarks
and every row is scored by the boundary found. Up to ``landmarks`` rows each row is its own landmark with weight 1, which
is the exact boundary; beyond, the same steps give a quantised one, with every kernel. The solution holds at least a
share ``nu`` of the weight, so the exact one cannot be split over tasks at any length. The offset of the boundary is the
``nu`` quantile of all rows' values: exact solutions have it there too, as at most that share lies outside and at least
that share outside or on the boundary. (The sigmoid kernel is not positive, so that this need not hold; it keeps the
offset of the landmarks.)
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach, cogrouped, store
from seriesguard.operators.bundles import per_series
from seriesguard.operators.features import FEATURES, scaled_features, stored_features
from seriesguard.operators.neighbors import standardise
from seriesguard.operators.stats import quantiles

GAMMA = 1.0 / len(FEATURES)
#: Rows that represent a series, at most.
LANDMARKS = 2_000
TOLERANCE = 1e-6
KERNELS = ("rbf", "linear", "poly", "sigmoid")

CHUNK_ROWS = 50_000
#: Rows compared with all landmarks at once.
BLOCK_ROWS = 2_048


def gram(x: np.ndarray, kernel: str, gamma: float = GAMMA, other: np.ndarray | None = None) -> np.ndarray:
    """Kernel values of all pairs of rows of one bounded group, or of its rows and those of another."""
    other = x if other is None else other
    inner = x @ other.T
    if kernel == "linear":
        return inner
    if kernel == "poly":
        return (gamma * inner) ** 3
    if kernel == "sigmoid":
        return np.tanh(gamma * inner)
    own, far = (x * x).sum(axis=1), (other * other).sum(axis=1)
    return np.exp(-gamma * np.maximum(0.0, own[:, None] + far[None, :] - 2.0 * inner))


def solve(kernel: np.ndarray, caps: np.ndarray, nu: float, kind: str) -> tuple[np.ndarray, float, float]:
    """Weights up to ``caps`` that add up to the share ``nu`` of them, the boundary's offset, and the tolerance.

    Moves weight between the pair of rows that violates optimality most until none does. For the Gaussian kernel the rows
    between the bounds then get their weights from the equations that hold at the optimum, which gives it to rounding; if
    that leads out of the bounds, the moves go on to a smaller tolerance.
    """
    own = np.diag(kernel)
    # the Gaussian kernel is 1 on the diagonal; others are solved relative to their size
    tolerance = TOLERANCE if kind == "rbf" else 1e-3 * own.mean()
    weight = np.clip(nu * caps.sum() - (np.cumsum(caps) - caps), 0.0, caps)
    field = kernel @ weight
    wanted = tolerance
    while kind == "rbf":
        _move(kernel, own, caps, weight, field, wanted)
        exact = _exact(kernel, caps, weight, nu)
        if exact is not None or wanted < 1e-12:
            break
        wanted /= 100.0
    if kind == "rbf" and exact is not None:
        return *exact, tolerance
    if kind != "rbf":
        _move(kernel, own, caps, weight, field, tolerance)
    free = (weight > 0.0) & (weight < caps)
    if free.any():
        offset = field[free].mean()
    else:
        offset = (field[weight >= caps].max() + field[weight <= 0.0].min(initial=field.max())) / 2.0
    return weight, float(offset), float(tolerance)


def _exact(kernel: np.ndarray, caps: np.ndarray, weight: np.ndarray, nu: float) -> tuple[np.ndarray, float] | None:
    """Weights and offset that solve the equations of the rows between the bounds, None if they are not optimal."""
    free, full = (weight > 0.0) & (weight < caps), weight >= caps
    n = int(free.sum())
    if not n:
        return None
    left = np.block([[kernel[np.ix_(free, free)], -np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
    right = np.r_[-kernel[np.ix_(free, full)] @ caps[full], nu * caps.sum() - caps[full].sum()]
    found = np.linalg.lstsq(left, right, rcond=None)[0]
    out, offset = np.where(full, caps, 0.0), float(found[-1])
    out[free] = found[:-1]
    field = kernel @ out
    slack = 1e-10
    fits = (out[free] > -slack).all() and (out[free] < caps[free] + slack).all() and np.abs(left @ found - right).max() < slack \
        and (field[full] < offset + slack).all() and (field[~full & ~free] > offset - slack).all()
    return (out, offset) if fits else None


def _move(kernel: np.ndarray, own: np.ndarray, caps: np.ndarray, weight: np.ndarray, field: np.ndarray, tolerance: float) -> None:
    while True:
        can_grow, can_shrink = weight < caps, weight > 0.0
        i = int(np.argmin(np.where(can_grow, field, np.inf)))
        gap = np.where(can_shrink, field - field[i], -np.inf)
        if not can_grow[i] or gap.max() <= tolerance:
            break
        bend = np.maximum(own[i] + own - 2.0 * kernel[i], 1e-12)
        j = int(np.argmax(np.where(gap > 0, gap * gap / bend, -1.0)))
        step = min(gap[j] / bend[j], caps[i] - weight[i], weight[j])
        weight[i] = caps[i] if step == caps[i] - weight[i] else weight[i] + step
        weight[j] = 0.0 if step == weight[j] else weight[j] - step
        field += step * (kernel[i] - kernel[j])


def boundary_distance(x: np.ndarray, nu: float, kind: str = "rbf") -> np.ndarray:
    """Signed decision value of every row, negative outside; rows on the boundary give 0."""
    kernel = gram(x, kind)
    weight, offset, tolerance = solve(kernel, np.ones(len(x)), nu, kind)
    value = kernel @ weight - offset
    return np.where(np.abs(value) <= 2.0 * tolerance, 0.0, value)


def ocsvm_scores(frame: SeriesFrame, window: int = 10, nu: float = 0.1, kernel: str = "rbf",
                 landmarks: int = LANDMARKS, group_rows: int | None = None) -> DataFrame:
    """Keys, position and score; rows with a score above 0 lie outside the boundary.

    ``group_rows`` (at most ``landmarks``) only says up to which length a series is one group of rows.
    """
    if not 0.0 < nu <= 1.0 or kernel not in KERNELS:
        raise ValueError(f"nu must be in (0, 1] and kernel one of {KERNELS}, got {nu} and {kernel}")
    keys, profile = list(frame.keys), frame.profile
    group_rows = landmarks if group_rows is None else min(group_rows, landmarks)
    rows = stored_features(frame, window)
    schema = rows.select(*keys, "i").withColumn("score", F.lit(0.0)).schema

    def whole(x: np.ndarray) -> dict[str, np.ndarray]:
        return {"score": -boundary_distance(standardise(x), nu, kernel)}

    if profile.longest - window <= group_rows:
        return per_series(rows, keys, profile.total, whole, schema)
    sizes = frame.valid.groupBy(*keys).agg((F.count(F.lit(1)) - window).alias("_m"))
    short = attach(rows, sizes.where(F.col("_m") <= group_rows).select(*keys), keys, profile.n_series)
    n_long = profile.series_longer_than(group_rows)
    long = attach(scaled_features(frame, window), sizes.where(F.col("_m") > group_rows), keys, n_long)
    return per_series(short, keys, profile.total, whole, schema).unionByName(
        _long_scores(long, keys, nu, kernel, landmarks, n_long, profile.longest, schema))


def _long_scores(rows: DataFrame, keys: list[str], nu: float, kernel: str, landmarks: int, n_long: int, longest: int,
                 schema) -> DataFrame:
    """Landmarks, their weights by counts in chunks of rows, the boundary per series, scores in chunks of rows."""
    rows = store(rows.withColumn("_chunk", F.expr(f"i div {CHUNK_ROWS}")))
    by = [*keys, "_chunk"]
    chunks = rows.select(*by).distinct()
    columns = list(FEATURES)
    # a hash leaves some more than wanted, of which the first are taken: bounded groups
    drawn = rows.where(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) * F.col("_m") <= 1.3 * (1 << 30) * landmarks)
    first = Window.partitionBy(*keys).orderBy(F.xxhash64("i"), "i")
    marks = store(drawn.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= landmarks)
                  .select(*keys, F.col("i").alias("_at"), *columns))

    def blocks(n: int):
        return (slice(a, a + BLOCK_ROWS) for a in range(0, n, BLOCK_ROWS))

    def count(part: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        x, y = part[columns].to_numpy(), near.sort_values("_at")
        at, y = y["_at"].to_numpy(), y[columns].to_numpy()
        square = (y * y).sum(axis=1)
        nearest = np.concatenate([(square - 2.0 * x[b] @ y.T).argmin(axis=1) for b in blocks(len(x))])
        # a landmark is its own, also where another one has the same features
        place = np.searchsorted(at, part["i"].to_numpy()).clip(max=len(at) - 1)
        nearest = np.where(at[place] == part["i"].to_numpy(), place, nearest)
        found, n = np.unique(nearest, return_counts=True)
        return pd.concat([part[keys].iloc[:1]] * len(found), ignore_index=True).assign(_at=at[found], _w=n.astype(float))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_at")
        weight, offset, tolerance = solve(gram(part[columns].to_numpy(), kernel), part["_w"].to_numpy(), nu, kernel)
        return part[[*keys, "_at", *columns]].assign(_weight=weight, _cut=offset, _tolerance=tolerance)[weight > 0]

    def score(part: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        x, y, weight = part[columns].to_numpy(), model[columns].to_numpy(), model["_weight"].to_numpy()
        value = np.concatenate([gram(x[b], kernel, other=y) @ weight for b in blocks(len(x))])
        return part[[*keys, "i"]].assign(score=value, _cut=model["_cut"].iloc[0], _tolerance=model["_tolerance"].iloc[0])

    key_types = ", ".join(f"`{k}` {schema[k].dataType.simpleString()}" for k in keys)
    counts = cogrouped(rows, chunks.join(marks, keys), by, count, f"{key_types}, _at long, _w double")
    weights = counts.groupBy(*keys, "_at").agg(F.sum("_w").alias("_w"))
    model_types = ", ".join([key_types, "_at long", *(f"`{c}` double" for c in columns),
                             "_weight double, _cut double, _tolerance double"])
    model = store(marks.join(weights, [*keys, "_at"]).groupBy(*keys).applyInPandas(fit, model_types))
    valued = store(cogrouped(rows, chunks.join(model, keys), by, score,
                             f"{key_types}, i {schema['i'].dataType.simpleString()}, score double, _cut double, _tolerance double"))
    if kernel != "sigmoid":
        cuts = quantiles(valued.select(*keys, "score"), keys, "score", {"_cut": nu}, longest, n_long)
        valued = attach(valued.drop("_cut"), cuts, keys, n_long)
    below = F.col("_cut") - F.col("score")
    return valued.select(
        *keys, "i", F.when(F.abs(below) <= 2.0 * F.col("_tolerance"), 0.0).otherwise(below).alias("score"))
