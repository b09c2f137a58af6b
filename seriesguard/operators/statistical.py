"""Statistical detectors (D1-D6, D8) as flag columns computed side by side in shared passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach
from seriesguard.operators.stats import frame_quantiles, is_zero_spread, median_mad
from seriesguard.operators.windows import (
    centred_trend, ema_reach, rolling, rolling_reach, with_ema)

# Default parameters, and the members of the default vote.
DEFAULTS: dict[str, dict] = {
    "zscore": {"threshold": 3.0},
    "modified_zscore": {"threshold": 3.5},
    "iqr": {"k": 1.5},
    "moving_average": {"window": 10, "threshold": 3.0},
    "ema": {"span": 10, "threshold": 3.0},
    "seasonal": {"period": 24, "threshold": 3.0},
}
VOTERS = ("zscore", "modified_zscore", "iqr", "moving_average", "ema")

# Scales the median absolute deviation to the standard deviation of a normal distribution.
MAD_SCALE = 0.6745


def settings(method: str, params: Mapping[str, Mapping]) -> dict:
    given = dict(params.get(method, {}))
    unknown = set(given) - set(DEFAULTS[method])
    if unknown:
        raise ValueError(f"{method} has no parameter {sorted(unknown)}")
    return {**DEFAULTS[method], **given}


def flag_columns(frame: SeriesFrame, methods: Sequence[str],
                 params: Mapping[str, Mapping] | None = None, indexed: bool = False) -> DataFrame:
    """Valid rows plus one boolean column per method; ``indexed`` keeps the position ``i``.

    All methods share one statistics aggregate and one pass of window frames.
    """
    params = params or {}
    chosen = {m: settings(m, params) for m in methods}
    windowed = [m for m in methods if m in ("moving_average", "ema", "seasonal")]
    scores: dict[str, Column] = {}
    n_series = frame.profile.n_series

    rows = frame.indexed if windowed or indexed else frame.valid
    if windowed:
        rows, scores = _window_scores(frame, {m: chosen[m] for m in windowed})
    plain = [m for m in methods if m not in windowed]
    if plain or "seasonal" in methods:
        rows = attach(rows, series_table(frame, methods), frame.keys, n_series)
    value = F.col(frame.value)
    if "zscore" in methods:
        scores["zscore"] = zscore_flag(value, chosen["zscore"]["threshold"])
    if "modified_zscore" in methods:
        scaled = MAD_SCALE * F.abs(value - F.col("med")) / F.col("mad")
        scores["modified_zscore"] = (F.col("mad") > 0) & (scaled > chosen["modified_zscore"]["threshold"])
    if "iqr" in methods:
        k, spread = chosen["iqr"]["k"], F.col("q3") - F.col("q1")
        scores["iqr"] = (value < F.col("q1") - k * spread) | (value > F.col("q3") + k * spread)
    if "seasonal" in methods:
        # too short for two periods: plain z-score with the same threshold
        short = F.col("n") < 2 * chosen["seasonal"]["period"]
        scores["seasonal"] = F.when(short, zscore_flag(value, chosen["seasonal"]["threshold"])) \
            .otherwise(scores["seasonal"])
    position = ["i"] if indexed else []
    return rows.select(*frame.columns, *position,
                       *[F.coalesce(scores[m], F.lit(False)).alias(m) for m in methods])


def zscore_flag(value: Column, threshold: float) -> Column:
    return (F.col("sd") > 0) & (F.abs((value - F.col("mean")) / F.col("sd")) > threshold)


def series_table(frame: SeriesFrame, methods: Sequence[str]) -> DataFrame:
    """One row per series with just the statistics the methods need."""
    value = F.col(frame.value)
    extra = []
    if "zscore" in methods or "seasonal" in methods:
        extra = [F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd")]
    wanted = {}
    if "iqr" in methods:
        wanted.update(q1=0.25, q3=0.75)
    if "modified_zscore" in methods:
        wanted.update(med=0.5)
    if not wanted:
        return frame.valid.groupBy(*frame.keys).agg(*extra)
    table = frame_quantiles(frame, wanted, extra)
    return median_mad(frame, table) if "modified_zscore" in methods else table


def _window_scores(frame: SeriesFrame, chosen: Mapping[str, Mapping]) -> tuple[DataFrame, dict]:
    """Rows with window columns and second-stage statistics, and the flags built on them."""
    value = F.col(frame.value)
    back, fwd = 0, 0
    if "moving_average" in chosen:
        back, fwd = rolling_reach(chosen["moving_average"]["window"])
    if "ema" in chosen:
        back = max(back, ema_reach(chosen["ema"]["span"]))
    if "seasonal" in chosen:
        half = chosen["seasonal"]["period"] // 2
        back, fwd = max(back, half), max(fwd, half)
    blocks = frame.blocks(back, fwd)
    over = blocks.window
    if "moving_average" in chosen:
        window = chosen["moving_average"]["window"]
        mean, std = rolling(over, value, window)
        blocks = replace(blocks, rows=blocks.rows.withColumns({"ma": mean, "msd": std}))
    if "seasonal" in chosen:
        trend = centred_trend(over, value, chosen["seasonal"]["period"])
        blocks = replace(blocks, rows=blocks.rows.withColumn("trend", trend))
    if "ema" in chosen:
        blocks = with_ema(blocks, frame.value, chosen["ema"]["span"])
    rows = blocks.owned(blocks.rows)

    n_series, scores, stats = frame.profile.n_series, {}, []
    if "moving_average" in chosen:
        # window-edge rows take the mean of the rolling means and the spread of the rolling spreads
        stats += [F.avg("ma").alias("ma0"), F.stddev_pop("msd").alias("msd0")]
        ma, spread = F.coalesce("ma", "ma0"), F.coalesce("msd", "msd0")
        spread = F.when(is_zero_spread(spread, ma), F.lit(1.0)).otherwise(spread)
        scores["moving_average"] = F.abs(value - ma) / spread > chosen["moving_average"]["threshold"]
    if "ema" in chosen:
        apart = value - F.col("ema")
        stats += [F.stddev_pop(apart).alias("esd"), F.avg(value).alias("emean")]
        scores["ema"] = ~is_zero_spread(F.col("esd"), F.col("emean")) & (
            F.abs(apart) > chosen["ema"]["threshold"] * F.col("esd"))
    if stats:
        rows = attach(rows, rows.groupBy(*frame.keys).agg(*stats), frame.keys, n_series)
    if "seasonal" in chosen:
        rows = with_residual(frame, rows, chosen["seasonal"]["period"])
        scores["seasonal"] = ~is_zero_spread(F.col("rsd"), F.col("level")) & (
            F.abs(F.col("resid") - F.col("rmean")) > chosen["seasonal"]["threshold"] * F.col("rsd"))
    return rows, scores


def trend_ends(frame: SeriesFrame, period: int) -> DataFrame:
    """Lines through the first and the last period of the trend, to extend it to the ends.

    The front line uses the first ``period`` trend points, the back line the ``period`` points
    before the last one. Only the rows near the two ends of each series are read into frames.
    """
    half = period // 2
    lengths = frame.valid.groupBy(*frame.keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(frame.value).alias("level"))
    rows = attach(frame.indexed.select(*frame.keys, "i", frame.value), lengths, frame.keys,
                  frame.profile.n_series).where(F.col("n") >= 2 * period)
    near = 2 * half + period
    ends = rows.where((F.col("i") <= near) | (F.col("i") >= F.col("n") - 1 - near))
    over = Window.partitionBy(*frame.keys).orderBy("i")
    ends = ends.withColumn("trend", centred_trend(over, F.col(frame.value), period))
    i, last = F.col("i"), F.col("n") - 1 - half
    front = (i >= half) & (i < F.least(F.lit(half + period), last))
    back = (i >= F.greatest(F.lit(half), last - period)) & (i < last)
    lines = []
    for name, use in (("front", front), ("back", back)):
        y, x = F.when(use, F.col("trend")), F.when(use, i.cast("double"))
        lines += [F.regr_slope(y, x).alias(f"{name}_slope"),
                  F.regr_intercept(y, x).alias(f"{name}_start")]
    return ends.groupBy(*frame.keys, "n", "level").agg(*lines).withColumnRenamed("n", "_len")


def with_residual(frame: SeriesFrame, rows: DataFrame, period: int) -> DataFrame:
    """Add the residual of the additive decomposition, with its mean and deviation per series.

    Expects the ``trend`` column; series shorter than two periods get nulls.
    """
    half, i = period // 2, F.col("i")
    n_series = frame.profile.n_series
    rows = attach(rows, trend_ends(frame, period), frame.keys, n_series, "left")
    full = F.when(i < half, F.col("front_slope") * i + F.col("front_start")) \
        .when(i > F.col("_len") - 1 - half, F.col("back_slope") * i + F.col("back_start")) \
        .otherwise(F.col("trend"))
    rows = rows.withColumns({"_flat": F.when(F.col("_len").isNotNull(), F.col(frame.value) - full),
                             "_phase": i % period})
    phases = rows.where(F.col("_flat").isNotNull()).groupBy(*frame.keys, "_phase").agg(
        F.avg("_flat").alias("_mean"), F.var_pop("_flat").alias("_var"),
        F.count(F.lit(1)).alias("_count"))
    # within a phase the residual's mean is the centre and its variance the phase's own, so
    # both moments follow from this small table without another pass over the rows
    packed = phases.groupBy(*frame.keys).agg(
        F.avg("_mean").alias("rmean"),
        F.sqrt(F.sum(F.col("_var") * F.col("_count")) / F.sum("_count")).alias("rsd"),
        F.array_sort(F.collect_list(F.struct("_phase", "_mean"))).alias("_parts"))
    packed = packed.select(*frame.keys, "rmean", "rsd", F.transform(
        "_parts", lambda p: p["_mean"] - F.col("rmean")).alias("_season"))
    rows = attach(rows, packed, frame.keys, n_series, "left", values=period)
    return rows.withColumn("resid", F.col("_flat") - F.get("_season", F.col("_phase").cast("int")))


def seasonal_parts(frame: SeriesFrame, period: int = 24) -> DataFrame:
    """Rows with trend, season and residual of the additive decomposition."""
    half = period // 2
    blocks = frame.blocks(half, half)
    trend = centred_trend(blocks.window, F.col(frame.value), period)
    rows = with_residual(frame, blocks.owned(blocks.rows.withColumn("trend", trend)), period)
    season = F.get("_season", F.col("_phase").cast("int"))
    return rows.select(*frame.columns, "i", (F.col(frame.value) - F.col("_flat")).alias("trend"),
                       season.alias("season"), "resid")


def vote(flags: DataFrame, members: Sequence[str], listed: int, share: float) -> Column:
    """True where at least ``share`` of the listed methods agree."""
    votes = sum((F.col(m).cast("int") for m in members), F.lit(0))
    return votes >= listed * share
