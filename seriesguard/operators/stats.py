"""Per-series statistics (A1-A3, A6): one partially aggregated pass, exact at any length."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach

# Exact percentiles keep a value-to-count map per series; longer series take the bracket path.
MAP_ROWS = 1_000_000
SKETCH_ACCURACY = 100_000


def is_zero_spread(spread: Column, level: Column) -> Column:
    """Spread that is only rounding noise around ``level``."""
    return spread <= 1e-12 * F.greatest(F.lit(1.0), F.abs(level))


def moments(frame: SeriesFrame) -> DataFrame:
    """Count, mean and population standard deviation per series (A1)."""
    value = F.col(frame.value)
    return frame.valid.groupBy(*frame.keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))


def quantiles(rows: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float],
              longest: int, n_series: int, extra: Sequence[Column] = (),
              map_rows: int = MAP_ROWS) -> DataFrame:
    """Exact linearly interpolated percentiles per series, plus any ``extra`` aggregates.

    ``wanted`` maps output column to probability. Up to ``map_rows`` rows per series this is
    Spark's exact percentile. Beyond, a sketch brackets each percentile, and only the distinct
    values inside the brackets are counted and ranked.
    """
    if longest <= map_rows:
        found = F.percentile(value, F.array(*[F.lit(float(p)) for p in wanted.values()]))
        grouped = rows.groupBy(*keys).agg(*extra, found.alias("_q"))
        kept = [c for c in grouped.columns if c != "_q"]
        return grouped.select(*kept, *[F.col("_q")[j].alias(name) for j, name in enumerate(wanted)])
    return _bracketed(rows, keys, value, wanted, n_series, extra)


def _bracketed(rows: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float],
               n_series: int, extra: Sequence[Column]) -> DataFrame:
    # the sketch is off by at most n / accuracy ranks, so twice that on each side is safe
    margin = 2.0 / SKETCH_ACCURACY
    probs = [min(1.0, max(0.0, p + side)) for p in wanted.values() for side in (-margin, margin)]
    sketch = rows.groupBy(*keys).agg(
        *extra, F.count(value).alias("_n"),
        F.percentile_approx(value, probs, SKETCH_ACCURACY).alias("_edges"))
    # below this many rows the margin is less than a few ranks, so all values are ranked
    short = F.col("_n") <= int(4 / margin)
    brackets = sketch.select(
        *keys,
        F.array(*[F.struct(F.lit(j).alias("q"),
                           F.when(short, float("-inf")).otherwise(F.col("_edges")[2 * j]).alias("lo"),
                           F.when(short, float("inf")).otherwise(F.col("_edges")[2 * j + 1]).alias("hi"),
                           (F.lit(float(p)) * (F.col("_n") - 1)).alias("rank"))
                  for j, p in enumerate(wanted.values())]).alias("_brackets"))
    marked = attach(rows.select(*keys, F.col(value).alias("_v")), brackets, keys, n_series, values=4 * len(wanted))
    below = marked.groupBy(*keys).agg(F.array(*[
        F.count_if(F.col("_v") < F.col("_brackets")[j]["lo"]) for j in range(len(wanted))]).alias("_below"))
    inside = marked.withColumn("_b", F.explode(F.filter(
        "_brackets", lambda b: F.col("_v").between(b["lo"], b["hi"]))))
    # equal values collapse before the ranking, so copies never pile up in one task
    counted = inside.groupBy(*keys, "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))
    running = (Window.partitionBy(*keys, "_b").orderBy("_v")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = attach(counted.withColumn("_upto", F.sum("_c").over(running)), below, keys, n_series, values=len(wanted))
    upto = F.col("_upto") + F.col("_below")[F.col("_b.q")]
    start, rank = upto - F.col("_c"), F.col("_b.rank")
    low, high = F.floor(rank), F.ceil(rank)
    at_low = F.max(F.when((start <= low) & (low < upto), F.col("_v")))
    at_high = F.max(F.when((start <= high) & (high < upto), F.col("_v")))
    share = F.first(rank - low)
    picked = ranked.groupBy(*keys, F.col("_b.q").alias("_q")).agg(
        F.when(share == 0, at_low).otherwise((1 - share) * at_low + share * at_high).alias("_x"))
    # a rank outside its bracket would mean that the sketch broke its bound: never pass that on as "no threshold"
    lost = F.raise_error(F.lit("a percentile lies outside the bracket of its sketch")).cast("double")
    picked = picked.withColumn("_x", F.coalesce("_x", lost))
    wide = picked.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_q") == j, F.col("_x"))).alias(name) for j, name in enumerate(wanted)])
    plain = sketch.drop("_n", "_edges")
    return plain.join(wide, list(keys)) if extra else wide


def frame_quantiles(frame: SeriesFrame, wanted: Mapping[str, float], extra: Sequence[Column] = (),
                    rows: DataFrame | None = None, value: str | None = None) -> DataFrame:
    profile = frame.profile
    return quantiles(frame.spread(frame.valid if rows is None else rows, frame.keys), frame.keys, value or frame.value,
                     wanted, profile.longest, profile.n_series, extra)


def fences(frame: SeriesFrame, k: float = 1.5) -> DataFrame:
    """Quartiles and the fences k interquartile ranges outside them (A3)."""
    quartiles = frame_quantiles(frame, {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return quartiles.withColumns({"lower": F.col("q1") - k * spread, "upper": F.col("q3") + k * spread})


def median_mad(frame: SeriesFrame, medians: DataFrame | None = None) -> DataFrame:
    """Median and median absolute deviation per series (A2)."""
    medians = frame_quantiles(frame, {"med": 0.5}) if medians is None else medians
    rows = attach(frame.valid, medians, frame.keys, frame.profile.n_series)
    apart = rows.select(*frame.keys, F.abs(F.col(frame.value) - F.col("med")).alias("_apart"))
    mad = frame_quantiles(frame, {"mad": 0.5}, rows=apart, value="_apart")
    return medians.join(mad, list(frame.keys))


def contamination_cut(scores: DataFrame, keys: Sequence[str], contamination: float,
                      longest: int, n_series: int, score: str = "score") -> DataFrame:
    """Rows whose score lies strictly above the series' upper percentile."""
    cuts = quantiles(scores, keys, score, {"cut": 1.0 - contamination}, longest, n_series)
    return attach(scores, cuts, keys, n_series).where(F.col(score) > F.col("cut"))
