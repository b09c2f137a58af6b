"""Histogram outlier score (M5): sum over features of the negative log of the bin density."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach
from seriesguard.operators.features import FEATURES, divisor, stored_features

# Added to every density before the logarithm.
SMOOTHING = 0.1


def hbos_scores(frame: SeriesFrame, window: int = 10, n_bins: int = 10) -> DataFrame:
    """Keys, position and score. Bins are equally wide between each feature's extremes.

    Binning commutes with standardising, so the raw features are binned and only the bin width
    is expressed in standard deviations.
    """
    keys, n_series = list(frame.keys), frame.profile.n_series
    rows = stored_features(frame, window)
    ranges = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"), *[
        c for j, f in enumerate(FEATURES) for c in (
            F.expr(f"min({f}) AS _lo{j}"), F.expr(f"max({f}) - min({f}) AS _span{j}"),
            F.expr(f"{divisor(f)} AS _sd{j}"))])
    # Non-null doubles keep the generated code of the 11 bins short enough for the JIT compiler.
    # A constant feature puts every row in its first bin.
    edges = ranges.select(*keys, *[c for j in range(len(FEATURES)) for c in (
        F.expr(f"coalesce(_lo{j}, 0D) AS _lo{j}"),
        F.expr(f"if(_span{j} > 0, _span{j}, 1D) AS _width{j}"))])
    # cell = feature number * n_bins + bin; the largest value falls into the last bin
    binned = attach(rows, edges, keys, n_series).select(*keys, "i", *[F.expr(
        f"{j * n_bins} + least({n_bins - 1}, int((coalesce({f}, 0D) - _lo{j}) / _width{j} * {n_bins})) AS _c{j}")
        for j, f in enumerate(FEATURES)])
    cells = ", ".join(f"_c{j}" for j in range(len(FEATURES)))
    # at most 11 * n_bins partial counts per series and task leave the map side
    counts = (binned.select(*keys, F.expr(f"explode(array({cells})) AS _cell"))
              .groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_count")))
    counts = counts.groupBy(*keys).agg(F.expr("map_from_entries(collect_list(struct(_cell, _count))) AS _counts"))
    widths = ", ".join(f"if(_span{j} > 0, _span{j} / _sd{j}, 1D) / {n_bins}" for j in range(len(FEATURES)))
    table = counts.join(ranges.select(*keys, "_m", F.expr(f"array({widths}) AS _widths")), keys)
    table = table.select(*keys, F.expr(
        f"transform(sequence(0, {len(FEATURES) * n_bins - 1}), cell -> -log2(coalesce(_counts[cell], 0) "
        f"/ (_m * _widths[cell div {n_bins}]) + {SMOOTHING})) AS _scores"))
    total = " + ".join(f"_scores[_c{j}]" for j in range(len(FEATURES)))
    return attach(binned, table, keys, n_series, values=len(FEATURES) * n_bins).select(
        *keys, "i", F.expr(f"{total} AS score"))
