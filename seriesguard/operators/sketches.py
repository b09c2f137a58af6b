"""Mergeable summaries of series: exact moments and extremes, and a quantile sketch (A1-A3 on request approximate).

A summary is one row for each series and part (a day, a file, a batch). Parts are stored and merged in any order, so
statistics over a growing table read its new rows only. Quantiles come from a KLL sketch: of ``SKETCH_K`` = 1,024 the rank error is
about 0.3 % with 99 % confidence, whatever the number of rows; count, mean, deviation, minimum and maximum stay exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: larger is more exact; the sketch of a long series takes some 10 bytes for each.
SKETCH_K = 1_024


def summarize(rows: DataFrame, keys: Sequence[str], value: str = "value", part: Sequence[str] = (),
              k: int = SKETCH_K) -> DataFrame:
    """``keys``, ``part`` columns, n, mean, m2 (sum of squared deviations), low, high and sketch; null and NaN are left out."""
    v = F.col(value).cast("double")
    return rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, *part).agg(
        F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(F.lit(1))).alias("m2"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def merge(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One summary for each series from those of its parts."""
    whole = parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch").alias("sketch"))
    centre = whole.select(*keys, F.col("mean").alias("_mean"))
    apart = F.col("mean") - F.col("_mean")
    spread = parts.join(centre, list(keys)).groupBy(*keys).agg(F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"))
    return whole.join(spread, list(keys)).select(*keys, "n", "mean", "m2", "low", "high", "sketch")


def approximate(summaries: DataFrame, wanted: Mapping[str, float]) -> DataFrame:
    """The summaries with deviation ``sd`` and a column for each wanted quantile, without the sketch."""
    found = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in wanted.items()}
    return summaries.withColumns({"sd": F.sqrt(F.col("m2") / F.col("n")), **found}).drop("sketch", "m2")


def thresholds(summaries: DataFrame, k: float = 1.5) -> DataFrame:
    """The summaries with what flags need: mean, sd, and the fences k approximate interquartile ranges outside."""
    found = approximate(summaries, {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return found.withColumns({"lower": F.col("q1") - k * spread, "upper": F.col("q3") + k * spread})
