"""Fixed-frequency means (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach
from seriesguard.functions.names import time_to_micros

# Bins that one row of the grid unfolds into at a time.
RUN_BINS = 1 << 14


def resample(frame: SeriesFrame, seconds: int = 300) -> DataFrame:
    """Mean per bin of ``seconds``; bins without rows are kept with a null mean.

    Bins are closed on the left, labelled by their start and counted from midnight (UTC) of the
    first day of each series.
    """
    keys, time = list(frame.keys), time_to_micros(F.col(frame.time))
    micros, day = seconds * 1_000_000, 86_400_000_000
    origins = frame.rows.groupBy(*keys).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"))
    if 86_400 % seconds == 0:
        # a day is a whole number of bins, so counting from the epoch gives the same bins
        rows, origin = frame.rows, F.lit(0).cast("long")
    else:
        rows = attach(frame.rows, origins, keys, frame.profile.n_series)
        origin = F.floor(F.col("_first") / day) * day
    rows = rows.withColumn("_bin", F.floor((time - origin) / micros))
    value = F.when(~F.isnan(frame.value), F.col(frame.value))
    means = rows.groupBy(*keys, "_bin").agg(F.avg(value).alias(frame.value))
    edges = origins.select(*keys, origin.alias("_origin"), F.floor((F.col("_first") - origin) / micros).alias("_from"),
                           F.floor((F.col("_last") - origin) / micros).alias("_to"))
    # first runs of bins, then the bins of a run: a single far-off time makes no huge array
    runs = edges.withColumn("_run", F.explode(F.sequence(F.expr(f"_from div {RUN_BINS}") - 1, F.expr(f"_to div {RUN_BINS}"))))
    begin = F.greatest("_from", F.col("_run") * RUN_BINS)
    end = F.least("_to", (F.col("_run") + 1) * RUN_BINS - 1)
    grid = runs.where(begin <= end).select(*keys, "_origin", F.explode(F.sequence(begin, end)).alias("_bin"))
    start = F.timestamp_micros(F.col("_origin") + F.col("_bin") * micros)
    return grid.join(means, [*keys, "_bin"], "left").select(*keys, start.alias(frame.time), frame.value)
