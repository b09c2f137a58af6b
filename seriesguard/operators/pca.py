"""Reconstruction error from the leading principal components of the raw features (M6)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesguard.frame import SeriesFrame, attach
from seriesguard.operators.features import FEATURES, stored_features

WIDTH = len(FEATURES)
PAIRS = [(a, b) for a in range(WIDTH) for b in range(a, WIDTH)]
N_COMPONENTS = 3


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def leading_axes(packed: pd.Series) -> pd.Series:
    """Leading eigenvectors of each packed symmetric matrix, one after the other."""
    matrices = np.zeros((len(packed), WIDTH, WIDTH))
    upper = tuple(np.array(PAIRS).T)
    if len(packed):
        matrices[:, upper[0], upper[1]] = np.stack(packed.to_numpy())
    # eigh reads the upper triangle and sorts ascending
    axes = np.linalg.eigh(matrices, UPLO="U")[1][:, :, ::-1][:, :, :N_COMPONENTS]
    return pd.Series(list(axes.transpose(0, 2, 1).reshape(len(packed), -1)))


def pca_scores(frame: SeriesFrame, window: int = 10) -> DataFrame:
    """Keys, position and mean squared reconstruction error.

    Each series is reduced to the 66 sums of products of its centred features; only that small
    table meets Python, and the error is a column expression.
    """
    keys, n_series = list(frame.keys), frame.profile.n_series
    rows = stored_features(frame, window)
    # Non-null doubles keep the generated code of the wide sums short enough for the JIT compiler.
    means = rows.groupBy(*keys).agg(*[F.expr(f"coalesce(avg({f}), 0D) AS _mean{j}") for j, f in enumerate(FEATURES)])
    centred = attach(rows, means, keys, n_series).select(
        *keys, "i", *[F.expr(f"coalesce({f}, 0D) - _mean{j} AS _x{j}") for j, f in enumerate(FEATURES)])
    products = ", ".join(f"sum(_x{a} * _x{b})" for a, b in PAIRS)
    axes = centred.groupBy(*keys).agg(F.expr(f"array({products}) AS _products"))
    axes = axes.select(*keys, leading_axes("_products").alias("_axes")).select(
        *keys, *[F.expr(f"coalesce(_axes[{j}], 0D) AS _a{j}") for j in range(WIDTH * N_COMPONENTS)])
    # coordinates on the axes, then what the axes leave unexplained of each feature
    placed = attach(centred, axes, keys, n_series).select("*", *[F.expr(" + ".join(
        f"_x{j} * _a{c * WIDTH + j}" for j in range(WIDTH)) + f" AS _p{c}") for c in range(N_COMPONENTS)])
    placed = placed.select(*keys, "i", *[F.expr(f"_x{j} - " + " - ".join(
        f"_p{c} * _a{c * WIDTH + j}" for c in range(N_COMPONENTS)) + f" AS _g{j}") for j in range(WIDTH)])
    squares = " + ".join(f"_g{j} * _g{j}" for j in range(WIDTH))
    return placed.select(*keys, "i", F.expr(f"({squares}) / {WIDTH} AS score"))
