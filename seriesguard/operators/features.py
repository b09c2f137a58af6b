"""Feature rows for the learned detectors (M0) and their standardised form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach, store
from seriesguard.operators.windows import lagged, trailing

# Fixed order of the feature columns.
FEATURES = ("value", "mean", "std", "min", "max", "median", "diff", "dev", "lag1", "lag2", "lag5")
LONGEST_LAG = 5


def features(frame: SeriesFrame, window: int = 10) -> DataFrame:
    """Keys, position and the 11 features of every row with a full window behind it."""
    if window < LONGEST_LAG:
        raise ValueError(f"window must be at least {LONGEST_LAG}, got {window}")
    narrow = frame.indexed.select(*frame.keys, "i", F.col(frame.value).alias("value"))
    blocks = frame.blocks(back=window, rows=narrow)
    value = F.col("value")
    rows = blocks.rows.select("*", *[c.alias(name) for name, c in trailing(blocks.window, value, window).items()],
                              *lagged(blocks.window, value))
    rows = blocks.owned(rows).where(F.col("i") >= window)
    rows = rows.withColumns({"diff": value - F.col("lag1"), "dev": value - F.col("mean")})
    return rows.select(*frame.keys, "i", *FEATURES)


def stored_features(frame: SeriesFrame, window: int = 10) -> DataFrame:
    """Feature rows written once per frame and window, for detectors that pass over them often."""
    tables = vars(frame).setdefault("_features", {})
    if window not in tables:
        tables[window] = store(features(frame, window))
    return tables[window]


def divisor(feature: str) -> str:
    """SQL for the standard deviation of a feature, 1 where it is only rounding noise."""
    return (f"if(stddev_pop({feature}) <= 1e-12 * greatest(1.0, abs(avg({feature}))), 1.0, "
            f"stddev_pop({feature}))")


def feature_moments(frame: SeriesFrame, rows: DataFrame) -> DataFrame:
    """Per series: number of feature rows, and mean and divisor of each feature."""
    return rows.groupBy(*frame.keys).agg(
        F.count(F.lit(1)).alias("_m"), *[F.expr(f"avg({f}) AS _mean_{f}") for f in FEATURES],
        *[F.expr(f"{divisor(f)} AS _sd_{f}") for f in FEATURES])


def scaled_features(frame: SeriesFrame, window: int = 10) -> DataFrame:
    """Feature rows with every feature standardised within its series."""
    rows = stored_features(frame, window)
    rows = attach(rows, feature_moments(frame, rows), frame.keys, frame.profile.n_series)
    return rows.select(*frame.keys, "i", *[F.expr(f"({f} - _mean_{f}) / _sd_{f} AS {f}") for f in FEATURES])
