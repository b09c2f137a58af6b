"""Flags for a stream of rows against stored statistics, and running counts of them.

Statistics are a table with one row for each series (``stats.moments`` and ``stats.fences`` joined, or ``sketches.thresholds``). The
stream joins it as a static table, so flags need no state; counts per time span keep state until the watermark passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: What a method needs of the statistics.
METHODS = {"zscore": ("mean", "sd"), "iqr": ("lower", "upper")}


def flag_stream(rows: DataFrame, statistics: DataFrame, keys: Sequence[str], value: str = "value",
                methods: Sequence[str] = ("zscore", "iqr"), threshold: float = 3.0) -> DataFrame:
    """The rows once for each method, with ``method``, ``is_anomaly`` and ``anomaly_score`` (0 or 1).

    Rows of a series without statistics and rows without a value are never flagged. Works on streams and tables alike.
    """
    unknown = set(methods) - set(METHODS)
    if unknown:
        raise ValueError(f"no stored statistics for {sorted(unknown)}")
    needed = {c: f"_{c}" for m in methods for c in METHODS[m]}
    held = statistics.select(*keys, *[F.col(c).alias(name) for c, name in needed.items()])
    v = F.col(value)
    tests = {"zscore": lambda: (F.col("_sd") > 0) & (F.abs((v - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))) > threshold),
             "iqr": lambda: (v < F.col("_lower")) | (v > F.col("_upper"))}
    found = F.array(*[F.struct(F.lit(m).alias("method"), F.coalesce(tests[m]() & ~F.isnan(v), F.lit(False)).alias("is_anomaly"))
                      for m in methods])
    joined = rows.join(held, list(keys), "left").withColumn("_f", F.explode(found))
    return joined.select(*rows.columns, F.col("_f.method").alias("method"), F.col("_f.is_anomaly").alias("is_anomaly"),
                         F.col("_f.is_anomaly").cast("double").alias("anomaly_score"))


def count_stream(flagged: DataFrame, keys: Sequence[str], time: str, span: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Rows and anomalies of each series and method in each time span; rows later than ``late`` are left out."""
    by = F.window(F.col(time), span)
    counted = flagged.withWatermark(time, late).groupBy(*keys, "method", by.alias("_w")).agg(
        F.sum(F.col("is_anomaly").cast("long")).alias("anomaly_count"), F.count(F.lit(1)).alias("total"))
    return counted.select(*keys, "method", F.col("_w.start").alias("span_start"), "anomaly_count", "total")


def write_rows(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all rows available now as Parquet; each row once, also over restarts with the same checkpoint."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start()


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write changed counts of each batch, with the batch's number; ``latest_counts`` reads the last state."""
    def keep(batch: DataFrame, number: int) -> None:
        # a batch that is repeated after a failure writes its own folder again
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return counts.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).outputMode("update") \
        .trigger(availableNow=True).start()


def latest_counts(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last state of every series, method and time span among the written batches."""
    by = [*keys, "method", "span_start"]
    last = F.max_by(F.struct("anomaly_count", "total"), "batch").alias("_l")
    return written.groupBy(*by).agg(last).select(*by, "_l.*")
