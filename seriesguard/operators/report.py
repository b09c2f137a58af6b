"""Counts, summaries, comparisons and plot data from detections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.frame import attach
from seriesguard.functions.names import time_to_micros, time_to_seconds
from seriesguard.operators.stats import quantiles

# Histogram bins for normal and anomalous values.
NORMAL_BINS = 50
ANOMALY_BINS = 20


def counts(detections: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Anomalies and rows per series (A5)."""
    return detections.groupBy(*keys).agg(
        F.sum(F.col("is_anomaly").cast("long")).alias("anomaly_count"), F.count(F.lit(1)).alias("total"))


def summary(detections: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Eight figures per series and method (R2). No rows of a kind gives 0; one row has no deviation."""
    flag = F.col("is_anomaly")
    hit, rest = F.when(flag, F.col(value)), F.when(~flag, F.col(value))
    hits, total = F.count_if(flag), F.count(F.lit(1))

    def unless_none(figure, none):
        return F.when(none, F.lit(0.0)).otherwise(figure)

    return detections.groupBy(*keys, "method").agg(
        total.alias("total_points"), hits.alias("anomaly_count"), (hits / total).alias("anomaly_rate"),
        unless_none(F.avg(rest), hits == total).alias("normal_mean"),
        unless_none(F.stddev_samp(rest), hits == total).alias("normal_std"),
        unless_none(F.avg(hit), hits == 0).alias("anomaly_mean"),
        unless_none(F.stddev_samp(hit), hits == 0).alias("anomaly_std"))


def comparison(detections: DataFrame, keys: Sequence[str], value: str = "value",
               wide: bool = False, methods: Sequence[str] = ()) -> DataFrame:
    """The summary row of every method (R3), or anomaly counts side by side when ``wide``."""
    if not wide:
        return summary(detections, keys, value)
    return (detections.groupBy(*keys).pivot("method", list(methods))
            .agg(F.sum(F.col("is_anomaly").cast("long"))))


def summary_text(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The summary as a text report (K5)."""
    lines = ["Anomaly Detection Summary Report", "=" * 50, "", "Method: %s", "Total data points: %d",
             "Anomalies detected: %d", "Anomaly rate: %.2f%%", "", "Normal values:", "  Mean: %.4f",
             "  Std: %.4f", "", "Anomalous values:", "  Mean: %.4f", "  Std: %.4f"]
    nan = F.lit(float("nan"))
    report = F.format_string(
        "\n".join(lines), "method", "total_points", "anomaly_count", F.col("anomaly_rate") * 100,
        *[F.coalesce(c, nan) for c in ("normal_mean", "normal_std", "anomaly_mean", "anomaly_std")])
    return summaries.select(*keys, "method", F.replace(report, F.lit("NaN"), F.lit("nan")).alias("report"))


def histogram(detections: DataFrame, keys: Sequence[str], value: str = "value", n_series: int | None = None,
              normal_bins: int = NORMAL_BINS, anomaly_bins: int = ANOMALY_BINS) -> DataFrame:
    """Equal-width histogram of normal and of anomalous values per series and method.

    ``n_series`` is the number of series times methods, None if unknown.
    """
    groups = n_series and 2 * n_series
    by = [*keys, "method", "is_anomaly"]
    rows = detections.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*by, F.col(value).alias("_v"))
    bins = F.when(F.col("is_anomaly"), F.lit(anomaly_bins)).otherwise(F.lit(normal_bins))
    spans = rows.groupBy(*by).agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    # a single value gets a range of one around it
    flat = F.col("_min") == F.col("_max")
    spans = spans.select(*by, bins.alias("_bins"), F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
                         F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"))
    place = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("_bins"))
    counted = (attach(rows, spans, by, groups).withColumn("bin", F.least(place, F.col("_bins") - 1).cast("int"))
               .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("_count")))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_bins")
    # the counts of a group travel as one row, its bars are laid out after the join
    packed = counted.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "_count"))).alias("_counts"))
    bars = spans.join(packed, by, "left").withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)))
    return bars.withColumn("_count", F.try_element_at("_counts", F.col("bin"))).select(
        *by, "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("_count", F.lit(0)).alias("points"))


def box_plot(detections: DataFrame, keys: Sequence[str], value: str, longest: int, n_series: int) -> DataFrame:
    """Quartiles, whiskers and outlier count of normal and anomalous values.

    ``longest`` bounds the rows of a series, ``n_series`` is the number of series times methods.
    """
    by = [*keys, "method", "is_anomaly"]
    rows = detections.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*by, F.col(value).alias("_v"))
    boxes = quantiles(rows, by, "_v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, longest, 2 * n_series)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return attach(rows, boxes, by, 2 * n_series).groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"), F.count_if(~inside).alias("outliers"))


def matrix(detections: DataFrame, keys: Sequence[str], time: str, methods: Sequence[str],
           seconds: int = 3600) -> DataFrame:
    """Which methods flag anything in which time bucket (R6): 0 or 1 per method."""
    bucket = F.timestamp_seconds(F.floor(time_to_seconds(F.col(time)) / seconds) * seconds)
    return (detections.groupBy(*keys, bucket.alias("bucket")).pivot("method", list(methods))
            .agg(F.max(F.col("is_anomaly").cast("int"))))


def overlay(wide: DataFrame, keys: Sequence[str], time: str, value: str, key: dict,
            methods: Sequence[str]) -> DataFrame:
    """Rows of one series in time order with the flag of every method.

    ``wide`` has one row per input row and a column per method, as ``detect_wide`` gives it, so
    rows that are alike stay apart.
    """
    for name, wanted in key.items():
        wide = wide.where(F.col(name) == wanted)
    order = [c for c in wide.columns if c not in (*keys, value, *methods)]
    return wide.select(*keys, *order, value, *methods).orderBy(*order)


def overlay_points(detections: DataFrame, keys: Sequence[str], time: str, value: str = "value", pixels: int = 1000,
                   n_series: int | None = None) -> DataFrame:
    """Plot data of every series and method in bounded size (R8): rows of ``pixels`` equal time spans.

    Of each span the first, the last, the smallest and the largest value stay, and every flagged row. Rows alike in
    time, value and flag are one point. Rows without a value are left out.
    """
    rows = detections.where(F.col(value).isNotNull() & ~F.isnan(value))
    at = F.col(time)
    if dict(rows.dtypes)[time].startswith("timestamp"):
        at = time_to_micros(at)
    rows = rows.select(*keys, "method", time, F.col(value).alias("value"), "is_anomaly", at.cast("double").alias("_t"))
    spans = rows.groupBy(*keys).agg(F.min("_t").alias("_from"), F.max("_t").alias("_to"))
    share = (F.col("_t") - F.col("_from")) / (F.col("_to") - F.col("_from") + 1)
    placed = attach(rows, spans, keys, n_series).withColumn("_pixel", F.floor(share * pixels))
    by_time, by_value = F.struct(time, "value", "is_anomaly"), F.struct("value", time, "is_anomaly")
    ends = placed.groupBy(*keys, "method", "_pixel").agg(
        F.min(by_time).alias("a"), F.max(by_time).alias("b"), F.min(by_value).alias("c"), F.max(by_value).alias("d"))
    same = lambda c: F.struct(F.col(c)[time].alias(time), F.col(c)["value"].alias("value"),
                              F.col(c)["is_anomaly"].alias("is_anomaly"))
    points = ends.select(*keys, "method", F.explode(F.array(*[same(c) for c in "abcd"])).alias("p")).select(*keys, "method", "p.*")
    flagged = placed.where("is_anomaly").select(*keys, "method", time, "value", "is_anomaly")
    return points.unionByName(flagged).distinct()
