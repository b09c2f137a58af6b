"""Row-frame columns inside a series (W1-W5). Every function takes the frame's block window."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesguard.frame import Blocks, SeriesFrame


def rolling_reach(window: int) -> tuple[int, int]:
    """Rows a centred window covers behind and ahead of its row."""
    return window // 2, (window - 1) // 2


def rolling(over: WindowSpec, value: Column, window: int) -> tuple[Column, Column]:
    """Centred rolling mean and sample deviation, null where the window is not full."""
    back, fwd = rolling_reach(window)
    around = over.rowsBetween(-back, fwd)
    full = F.count(F.lit(1)).over(around) == window
    return F.when(full, F.avg(value).over(around)), F.when(full, F.stddev_samp(value).over(around))


def ema_reach(span: float) -> int:
    """Rows after which an exponential weight is below 1e-17."""
    keep = 1.0 - 2.0 / (span + 1.0)
    return 1 if keep <= 0 else max(1, math.ceil(math.log(1e-17) / math.log(keep)))


def with_ema(blocks: Blocks, value: str, span: float, name: str = "ema") -> Blocks:
    """Add the exponentially weighted mean with normalised weights.

    Rows are cut into segments of the length after which weights vanish. In a segment the
    weighted sum is a running sum of values scaled by the inverse weight, which stays far from
    overflow; what came before adds the last sum of the previous segment. Constant cost per
    row for any span.
    """
    keep = 1.0 - 2.0 / (span + 1.0)
    if keep <= 0:
        return replace(blocks, rows=blocks.rows.withColumn(name, F.col(value)))
    length = ema_reach(span)
    step = F.col("i") % length
    so_far = (Window.partitionBy(*blocks.by, "_seg").orderBy("i")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = blocks.rows.withColumn("_seg", F.expr(f"i div {length}"))
    rows = rows.withColumn(
        "_near", F.sum(F.col(value) * F.pow(F.lit(keep), -step)).over(so_far) * F.pow(F.lit(keep), step))
    rows = rows.withColumn("_carry", F.lag("_near", 1).over(blocks.window))
    rows = rows.withColumn("_carry", F.coalesce(F.first("_carry").over(so_far), F.lit(0.0)))
    total = F.col("_near") + F.col("_carry") * F.pow(F.lit(keep), step + 1)
    weights = (1.0 - F.pow(F.lit(keep), F.col("i") + 1)) / (1.0 - keep)
    return replace(blocks, rows=rows.withColumn(name, total / weights).drop("_seg", "_near", "_carry"))


def lagged(over: WindowSpec, value: Column, lags: tuple[int, ...] = (1, 2, 5)) -> list[Column]:
    """Values some rows earlier."""
    return [F.lag(value, n).over(over).alias(f"lag{n}") for n in lags]


def trailing(over: WindowSpec, value: Column, window: int) -> dict[str, Column]:
    """Statistics of the ``window`` rows before each row, the row itself left out."""
    before = over.rowsBetween(-window, -1)
    ordered = F.sort_array(F.collect_list(value).over(before))
    middle = (window - 1) // 2
    median = ordered[middle] if window % 2 else (ordered[middle] + ordered[middle + 1]) / 2.0
    return {
        "mean": F.avg(value).over(before),
        "std": F.stddev_pop(value).over(before),
        "min": F.min(value).over(before),
        "max": F.max(value).over(before),
        "median": median,
    }


def centred_trend(over: WindowSpec, value: Column, period: int) -> Column:
    """Centred mean over one period, half-weighted ends when it is even; null at the ends."""
    half = period // 2
    around = over.rowsBetween(-half, half)
    full = F.count(F.lit(1)).over(around) == 2 * half + 1
    total = F.sum(value).over(around)
    if period % 2 == 0:
        total = total - 0.5 * (F.lag(value, half).over(over) + F.lead(value, half).over(over))
    return F.when(full, total / period)


def rolling_frame(frame: SeriesFrame, window: int = 10) -> DataFrame:
    """Rows with the centred rolling mean and deviation."""
    blocks = frame.blocks(*rolling_reach(window))
    mean, std = rolling(blocks.window, F.col(frame.value), window)
    return blocks.owned(blocks.rows.withColumns({"rolling_mean": mean, "rolling_std": std}))


def ema_frame(frame: SeriesFrame, span: float = 10) -> DataFrame:
    """Rows with the exponentially weighted mean."""
    blocks = with_ema(frame.blocks(back=ema_reach(span)), frame.value, span)
    return blocks.owned(blocks.rows)


def lag_frame(frame: SeriesFrame) -> DataFrame:
    """Rows with lags 1, 2, 5 and the first difference."""
    blocks = frame.blocks(back=5)
    lags = lagged(blocks.window, F.col(frame.value))
    rows = blocks.owned(blocks.rows.select("*", *lags))
    return rows.withColumn("diff", F.col(frame.value) - F.col("lag1"))


def trend_frame(frame: SeriesFrame, period: int = 24) -> DataFrame:
    """Rows with the centred period mean."""
    blocks = frame.blocks(period // 2, period // 2)
    return blocks.owned(blocks.rows.withColumn(
        "trend", centred_trend(blocks.window, F.col(frame.value), period)))
