"""

Times are returned as epoch numbers and fractions are rounded, so that both engines print the
same values. All queries read whole tables.
"""

from __future__ import annotations

import functools
import math
import pathlib
import sys
import uuid
from collections.abc import Callable
from types import ModuleType

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from seriesguard.frame import SeriesFrame, attach, series_frame, shared_dir  # noqa: E402
from seriesguard.functions.names import (  # noqa: E402
    clean_name, millis_to_time, seconds_to_time, time_to_micros, time_to_millis, time_to_seconds)
from seriesguard.operators import report, select, sketches, stats, windows  # noqa: E402
from seriesguard.operators.features import FEATURES, features, scaled_features  # noqa: E402
from seriesguard.operators.hbos import hbos_scores  # noqa: E402
from seriesguard.operators.iforest import iforest_scores  # noqa: E402
from seriesguard.operators.neighbors import neighbour_scores  # noqa: E402
from seriesguard.operators.ocsvm import ocsvm_scores  # noqa: E402
from seriesguard.operators.pca import pca_scores  # noqa: E402
from seriesguard.operators.resample import resample  # noqa: E402
from seriesguard.operators.statistical import seasonal_parts  # noqa: E402
from seriesguard.plans.pipeline import analyze, run_analysis, run_detection  # noqa: E402
from seriesguard.plans.registry import detect, detect_wide, learned_flags  # noqa: E402
from seriesguard.sources import csv, sinks, store  # noqa: E402
from seriesguard.streaming import scores as streams  # noqa: E402

STAT_VOTERS = ("zscore", "modified_zscore", "iqr", "moving_average", "ema")
TYPE_KEY = ["event_type"]
USER_KEY = ["user_id"]


# ---------------------------------------------------------------- inputs

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_type(spark: SparkSession, sf_dir: str) -> SeriesFrame:
    return series_frame(table(spark, sf_dir, "events"), TYPE_KEY, ["ts", "event_id"], "value")


def by_type_blocks(spark: SparkSession, sf_dir: str) -> SeriesFrame:
    """The same series cut into short blocks, as long series are by default."""
    return series_frame(table(spark, sf_dir, "events"), TYPE_KEY, ["ts", "event_id"], "value", block_rows=500)


def by_user(spark: SparkSession, sf_dir: str) -> SeriesFrame:
    return series_frame(table(spark, sf_dir, "events"), USER_KEY, ["ts", "event_id"], "value")


def by_supplier(spark: SparkSession, sf_dir: str) -> SeriesFrame:
    return series_frame(table(spark, sf_dir, "lineitem"), ["l_suppkey"],
                        ["l_shipdate", "l_orderkey", "l_linenumber"], "l_extendedprice")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns of metric rows."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"), "event_id", F.concat(F.lit("user_"), "user_id").alias("cmdb_id"),
        F.concat("event_type", F.lit(".value")).alias("kpi_name"), "value", "user_id", "event_type")


BEDS = ("2024-01-cloudbed1", "2024-01-cloudbed2")
CATEGORY = {"click": "service", "view": "jvm", "error": "node", "signup": "container", "purchase": "billing"}
LAYOUTS = (["timestamp", "value", "cmdb_id", "kpi_name"], ["timestamp", "cmdb_id", "kpi_name", "value"])
_exported: dict[tuple[str, str], str] = {}


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def metric_files(spark: SparkSession, sf_dir: str) -> str:
    """All events as metric CSV files: two cloudbeds with different column orders."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _exported:
        root = fresh_dir(spark, "metrics")
        rows = metrics(spark, sf_dir).withColumn("timestamp", time_to_seconds(F.col("timestamp")))
        for bed, (name, layout) in enumerate(zip(BEDS, LAYOUTS)):
            for kind, category in CATEGORY.items():
                part = rows.where((F.col("user_id") % 2 == bed) & (F.col("event_type") == kind))
                sinks.write_table(part.select(*layout), f"{root}/{name}/metric/{category}", "csv", mode="append")
        _exported[key] = root
    return _exported[key]


def metric_output(rows: DataFrame) -> DataFrame:
    return rows.select("cloudbed", "category", "cmdb_id", "kpi_name",
                       time_to_seconds(F.col("timestamp")).alias("epoch"), "value")


def flags(frame: SeriesFrame, method: str, params: dict | None = None) -> DataFrame:
    found = detect(frame, [method], {method: params} if params else None)
    return found.select(*frame.keys, *frame.order[1:], "value", "is_anomaly", "anomaly_score")


def rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.round(n, 6) for n in names})


def with_id(frame: SeriesFrame, rows: DataFrame) -> DataFrame:
    """Give positions back their row ids."""
    return rows.join(frame.indexed.select(*frame.keys, "i", *frame.order[1:]), [*frame.keys, "i"]).drop("i")


# ---------------------------------------------------------------- queries

def entry(spark: SparkSession) -> DataFrame:
    """The default vote over every series, counted per series."""
    frame = by_type(spark, "/root/testdata/sf0.001")
    return report.counts(detect(frame, ["ensemble_stat"]), frame.keys)


def q_d1_counts(spark, sf):
    return report.counts(detect(by_type(spark, sf), ["zscore"]), TYPE_KEY)


def q_s1(spark, sf):
    return metric_output(csv.read_metrics(spark, metric_files(spark, sf), categories=None))


def q_s1_bad_rows(spark, sf):
    """Counts over files in which every tenth value and every tenth time is no number."""
    root = fresh_dir(spark, "bad-rows")
    at = F.col("event_id") % 10
    rows = metrics(spark, sf).withColumns({
        "timestamp": F.when(at == 1, "bad").otherwise(time_to_seconds(F.col("timestamp")).cast("string")),
        "value": F.when(at == 0, "oops").otherwise(F.col("value").cast("string"))})
    for bed, (name, layout) in enumerate(zip(BEDS, LAYOUTS)):
        sinks.write_table(rows.where(F.col("user_id") % 2 == bed).select(*layout), f"{root}/{name}/metric/service", "csv")
    return csv.count_bad_rows(spark, root)


def q_s1_file(spark, sf):
    rows = csv.load_csv_file(spark, f"{metric_files(spark, sf)}/{BEDS[0]}/metric/service")
    return rows.select("cmdb_id", "kpi_name", time_to_seconds(F.col("timestamp")).alias("epoch"), "value")


def q_s2(spark, sf):
    return metric_output(csv.load_metric_category(spark, f"{metric_files(spark, sf)}/{BEDS[1]}", "jvm"))


def q_s3(spark, sf):
    return metric_output(csv.load_cloudbed(spark, metric_files(spark, sf), BEDS[0], "2024-01"))


def q_s4(spark, sf):
    return metric_output(csv.load_all_cloudbeds(spark, metric_files(spark, sf), "2024"))


def q_s5(spark, sf):
    return metric_output(csv.require_columns(csv.load_job_input(spark, metric_files(spark, sf))))


def q_s6(spark, sf):
    rows = table(spark, sf, "events").where(F.col("event_type") == "error")
    rows = store.in_range(rows, "ts", 1_704_844_800_000, 1_705_708_800_000)
    return rows.select("event_id", time_to_millis(F.col("ts")).alias("ms"), "value")


def q_s7(spark, sf):
    rows = by_supplier(spark, sf).rows
    return rows.select("l_suppkey", time_to_seconds(F.col("l_shipdate")).alias("epoch"), "l_orderkey", "l_linenumber", "value")


def q_k1(spark, sf):
    frame, path = by_type(spark, sf), fresh_dir(spark, "detections")
    found = detect(frame, ["zscore", "iqr"])
    sinks.write_detections(found, path, "csv")
    back = spark.read.schema(found.schema).option("header", True).csv(path)
    return back.select("event_type", "event_id", time_to_micros(F.col("ts")).alias("us"), "value", "method", "is_anomaly",
                       "anomaly_score")


def q_k2(spark, sf):
    frame, path = by_type(spark, sf), fresh_dir(spark, "counts")
    counts = report.counts(detect(frame, ["iqr"]), frame.keys)
    sinks.write_counts(counts, path)
    return spark.read.schema(counts.schema).option("header", True).csv(path)


def q_k3(spark, sf):
    frame, path = by_type(spark, sf), fresh_dir(spark, "anomalies")
    found = detect(frame, ["zscore"])
    sinks.write_anomalies(found, path)
    back = spark.read.schema(found.schema).option("header", True).csv(path)
    return back.select("event_type", "event_id", time_to_micros(F.col("ts")).alias("us"), "value")


def q_k4(spark, sf):
    path = fresh_dir(spark, "comparison")
    compared = q_r3(spark, sf)
    sinks.write_comparison(compared, path)
    return spark.read.schema(compared.schema).option("header", True).csv(path)


def q_k5(spark, sf):
    frame, path = by_type(spark, sf), fresh_dir(spark, "reports")
    texts = report.summary_text(report.summary(detect(frame, ["zscore", "iqr"]), TYPE_KEY), TYPE_KEY)
    sinks.write_summary_text(texts, path, TYPE_KEY)
    return spark.read.schema("event_type string, report string, method string").json(path)


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """Everything in a store."""
    return store.read_store(spark, path).select(
        "device", "measurement", time_to_millis(F.col("timestamp")).alias("ms"), "value")


def q_k6(spark, sf):
    path = fresh_dir(spark, "store")
    store.write_store(metrics(spark, sf), path, "event_type", "event_type", "timestamp")
    return stored_rows(spark, path)


def q_k7(spark, sf):
    path = fresh_dir(spark, "ingested")
    store.ingest_cloudbed(spark, metric_files(spark, sf), BEDS[0], path)
    return stored_rows(spark, path)


def q_k7_again(spark, sf):
    """Both cloudbeds into one store, then every third event once more with another value."""
    path, root = fresh_dir(spark, "merged"), metric_files(spark, sf)
    for bed in BEDS:
        store.ingest_cloudbed(spark, root, bed, path, mode="append")
    again = metrics(spark, sf).where(F.col("event_id") % 3 == 0).withColumn("value", -F.col("value"))
    store.write_store(again, path, mode="append")
    return stored_rows(spark, path)


def q_p1(spark, sf):
    rows = select.one_series(by_type(spark, sf), event_type="view")
    return rows.select("event_id", time_to_micros(F.col("ts")).alias("us"), "value")


def q_p2(spark, sf):
    return select.services(metrics(spark, sf))


def q_p3(spark, sf):
    return select.kpis(metrics(spark, sf), "user_7")


def q_p4(spark, sf):
    found = detect(by_type(spark, sf), ["zscore"])
    both = select.anomalous(found).withColumn("kind", F.lit("anomalous")).unionByName(
        select.normal(found).withColumn("kind", F.lit("normal")))
    return both.groupBy("event_type", "kind").agg(
        F.count(F.lit(1)).alias("points"), F.min("value").alias("low"), F.max("value").alias("high"))


def q_p5(spark, sf):
    urls = table(spark, sf, "pages").select("page_id", "url")
    return urls.select("page_id", clean_name(F.col("url")).alias("clean"))


def q_p7(spark, sf):
    rows = select.label(table(spark, sf, "events"), F.col("value") > 200)
    return rows.select("event_id", "value", "is_anomaly", "anomaly_score")


def q_p8(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", time_to_millis(ts).alias("ms"),
        time_to_micros(millis_to_time(time_to_millis(ts))).alias("us_of_ms"),
        time_to_seconds(seconds_to_time(time_to_seconds(ts))).alias("seconds"))


def q_p9(spark, sf):
    return select.first_series(metrics(spark, sf))


def q_a1(spark, sf):
    return rounded(stats.moments(by_supplier(spark, sf)), "mean", "sd")


def q_a2(spark, sf):
    return rounded(stats.median_mad(by_supplier(spark, sf)), "med", "mad")


def q_a3(spark, sf):
    return rounded(stats.fences(by_supplier(spark, sf)), "q1", "q3", "lower", "upper")


def q_a4(spark, sf):
    rows = resample(by_type(spark, sf), 300)
    return rounded(rows.select("event_type", time_to_seconds(F.col("ts")).alias("bin_start"), "value"), "value")


def q_a4_odd(spark, sf):
    rows = resample(by_type(spark, sf), 7 * 60)
    return rounded(rows.select("event_type", time_to_seconds(F.col("ts")).alias("bin_start"), "value"), "value")


def q_a5(spark, sf):
    return report.counts(detect(by_supplier(spark, sf), ["iqr", "zscore"]), ["l_suppkey", "method"])


def q_a6(spark, sf):
    frame = by_supplier(spark, sf)
    scores = attach(frame.valid, stats.moments(frame), frame.keys, frame.profile.n_series)
    scores = scores.withColumn("score", F.abs(F.col("value") - F.col("mean")))
    cut = stats.contamination_cut(scores, frame.keys, 0.1, frame.profile.longest, frame.profile.n_series)
    return cut.select("l_suppkey", "l_orderkey", "l_linenumber")


def q_a2_approx(spark, sf):
    """Summaries by year of shipment, stored and merged; whether each quantile's rank is off by at most one per cent."""
    frame, path, wanted = by_supplier(spark, sf), fresh_dir(spark, "summaries"), {"q1": 0.25, "med": 0.5, "q3": 0.75}
    parts = frame.rows.withColumn("year", F.year("l_shipdate"))
    sketches.summarize(parts, frame.keys, "value", ["year"]).write.parquet(path)
    found = sketches.approximate(sketches.merge(spark.read.parquet(path), frame.keys), wanted)
    ranked = frame.rows.join(found, list(frame.keys)).groupBy("l_suppkey", "n", "mean", "sd", "low", "high").agg(*[
        ((F.avg((F.col("value") < F.col(q)).cast("double")) <= p + 0.01)
         & (F.avg((F.col("value") <= F.col(q)).cast("double")) >= p - 0.01)).alias(f"{q}_holds") for q, p in wanted.items()])
    return rounded(ranked, "mean", "sd")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files."""
    rows, path = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), fresh_dir(spark, "arriving")
    rows.repartition(6).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


def flagged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, path = by_type(spark, sf_dir), fresh_dir(spark, "statistics")
    stats.moments(frame).join(stats.fences(frame), TYPE_KEY).write.parquet(path)
    return streams.flag_stream(event_stream(spark, sf_dir), spark.read.parquet(path), TYPE_KEY)


def q_st_flags(spark, sf):
    path = fresh_dir(spark, "stream-flags")
    streams.write_rows(flagged_stream(spark, sf), path, fresh_dir(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(path).select("event_type", "event_id", "value", "method", "is_anomaly", "anomaly_score")


def q_st_counts(spark, sf):
    path = fresh_dir(spark, "stream-counts")
    counts = streams.count_stream(flagged_stream(spark, sf), TYPE_KEY, "ts", "6 hours", "400 days")
    streams.write_counts(counts, path, fresh_dir(spark, "stream-state")).awaitTermination()
    found = streams.latest_counts(spark.read.parquet(path), TYPE_KEY)
    return found.select("event_type", "method", time_to_seconds(F.col("span_start")).alias("span"), "anomaly_count", "total")


def q_w0(spark, sf):
    return by_supplier(spark, sf).indexed.select("l_suppkey", "l_orderkey", "l_linenumber", "i")


def q_w0_blocks(spark, sf):
    return by_type_blocks(spark, sf).indexed.select("event_type", "event_id", "i")


def q_w1(spark, sf):
    rows = windows.rolling_frame(by_type(spark, sf)).drop("ts", "i")
    return rounded(rows, "rolling_mean", "rolling_std")


def q_w2(spark, sf):
    return rounded(windows.ema_frame(by_type(spark, sf)).drop("ts", "i"), "ema")


def q_w3(spark, sf):
    return rounded(windows.lag_frame(by_type(spark, sf)).drop("ts", "i"), "diff")


def q_w4(spark, sf):
    frame = by_supplier(spark, sf)
    kept = [f for f in FEATURES if f in ("mean", "std", "min", "max", "median", "dev")]
    return rounded(features(frame).select("l_suppkey", "i", *kept), *kept)


def q_w5(spark, sf):
    return rounded(windows.trend_frame(by_type(spark, sf)).drop("ts", "i"), "trend")


def q_j1(spark, sf):
    frame = by_supplier(spark, sf)
    rows = attach(frame.valid, stats.moments(frame), frame.keys, frame.profile.n_series)
    z = (F.col("value") - F.col("mean")) / F.col("sd")
    return rows.select("l_suppkey", "l_orderkey", "l_linenumber", F.round(z, 6).alias("z"))


def q_j2(spark, sf):
    frame = by_type(spark, sf)
    wide = detect_wide(frame, ["zscore", "iqr", "hbos"])
    return wide.select("event_type", "event_id", "zscore", "iqr", "hbos")


def q_j3(spark, sf):
    frame = by_user(spark, sf)
    return rounded(with_id(frame, neighbour_scores(frame, knn=5)), "knn")


def q_o1(spark, sf):
    rows = by_type(spark, sf).rows
    return rows.select("event_type", "event_id", "value").orderBy("event_type", "ts", "event_id")


def q_u1(spark, sf):
    root = metric_files(spark, sf)
    parts = [csv.load_metric_category(spark, f"{root}/{bed}", category) for bed in BEDS for category in CATEGORY.values()]
    return metric_output(functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))


def q_d6_parts(spark, sf):
    rows = seasonal_parts(by_type(spark, sf)).drop("ts", "i", "value")
    return rounded(rows, "trend", "season", "resid")


def q_m0(spark, sf):
    return features_of(by_type(spark, sf))


def q_m0_blocks(spark, sf):
    return features_of(by_type_blocks(spark, sf))


def features_of(frame: SeriesFrame) -> DataFrame:
    return rounded(with_id(frame, features(frame)), *FEATURES)


def q_m0b(spark, sf):
    frame = by_type(spark, sf)
    return rounded(with_id(frame, scaled_features(frame)), *FEATURES)


def score_query(scores: Callable, frame_of: Callable):
    def run(spark, sf):
        frame = frame_of(spark, sf)
        return rounded(with_id(frame, scores(frame)), "score")

    return run


def q_m2_scores(spark, sf):
    frame = by_user(spark, sf)
    return rounded(with_id(frame, neighbour_scores(frame, lof=20)), "lof")


def q_m2_cells(spark, sf):
    """Small cells, so that series of some dozen rows are searched as long ones are."""
    frame = by_user(spark, sf)
    return rounded(with_id(frame, neighbour_scores(frame, lof=20, cell_rows=24)), "lof")


def q_m3_cells(spark, sf):
    frame = by_user(spark, sf)
    return rounded(with_id(frame, neighbour_scores(frame, knn=5, cell_rows=12)), "knn")


def flag_query(method: str, frame_of: Callable, params: dict | None = None):
    return lambda spark, sf: flags(frame_of(spark, sf), method, params)


def q_r2(spark, sf):
    rows = report.summary(detect(by_supplier(spark, sf), ["zscore"]), ["l_suppkey"])
    return rounded(rows, "anomaly_rate", "normal_mean", "normal_std", "anomaly_mean", "anomaly_std")


def q_r3(spark, sf):
    rows = report.comparison(detect(by_type(spark, sf), ["zscore", "modified_zscore", "iqr"]), TYPE_KEY)
    return rounded(rows, "anomaly_rate", "normal_mean", "normal_std", "anomaly_mean", "anomaly_std")


def q_r3_wide(spark, sf):
    methods = ["zscore", "modified_zscore", "iqr"]
    return report.comparison(detect(by_type(spark, sf), methods), TYPE_KEY, wide=True, methods=methods)


def q_r4(spark, sf):
    return rounded(report.histogram(detect(by_type(spark, sf), ["zscore"]), TYPE_KEY), "bin_start", "bin_end")


def q_r5(spark, sf):
    frame = by_type(spark, sf)
    boxes = report.box_plot(detect(frame, ["zscore"]), TYPE_KEY, "value", frame.profile.longest, frame.profile.n_series)
    return rounded(boxes, "q1", "median", "q3")


def q_r6(spark, sf):
    rows = report.matrix(detect(by_type(spark, sf), ["zscore", "iqr"]), TYPE_KEY, "ts", ["zscore", "iqr"])
    return rows.select("event_type", time_to_seconds(F.col("bucket")).alias("bucket"), "zscore", "iqr")


def q_r8(spark, sf):
    found = detect_wide(by_type(spark, sf), ["zscore", "iqr"])
    rows = report.overlay(found, TYPE_KEY, "ts", "value", {"event_type": "click"}, ["zscore", "iqr"])
    return rows.select("event_id", "value", "zscore", "iqr")


def q_r8_ties(spark, sf):
    """Every row twice, with nothing but the time to order by."""
    rows = table(spark, sf, "events").select("event_type", "ts", "value")
    frame = series_frame(rows.unionAll(rows), TYPE_KEY, ["ts"], "value")
    found = report.overlay(detect_wide(frame, ["zscore"]), TYPE_KEY, "ts", "value", {"event_type": "view"}, ["zscore"])
    return found.select(time_to_micros(F.col("ts")).alias("us"), "value", "zscore")


def q_r8_small(spark, sf):
    found = detect(by_type(spark, sf), ["zscore", "iqr"])
    rows = report.overlay_points(found, TYPE_KEY, "ts", "value", pixels=60)
    return rows.select("event_type", "method", time_to_micros(F.col("ts")).alias("us"), "value", "is_anomaly")


def q_e2_plots(spark, sf):
    """What the analysis writes for plots, read back and counted."""
    out = fresh_dir(spark, "plots")
    run_analysis(spark, metric_files(spark, sf), out, ["zscore", "iqr"], compare=True, pixels=8)
    keys = ["cloudbed", "cmdb_id", "kpi_name", "method"]
    read = lambda name: spark.read.option("header", True).csv(f"{out}/{name}")
    bars = read("histogram").groupBy(*keys).agg(F.sum(F.col("points").cast("long")).alias("in_bars"))
    boxes = read("box_plot").groupBy(*keys).agg(F.min(F.col("whisker_low").cast("double")).alias("low"),
                                                F.max(F.col("whisker_high").cast("double")).alias("high"))
    dots = read("overlay").groupBy(*keys).agg(F.count_if(F.col("is_anomaly") == "true").alias("flagged"))
    hours = read("matrix").select(*keys[:3], F.explode(F.create_map(
        F.lit("zscore"), F.col("zscore").cast("int"), F.lit("iqr"), F.col("iqr").cast("int"))).alias("method", "hit")) \
        .groupBy(*keys).agg(F.sum("hit").cast("long").alias("hours"))
    return bars.join(boxes, keys).join(dots, keys).join(hours, keys)


def q_e2_outputs(spark, sf):
    """What the analysis writes, read back: figures in the reports beside the anomalies in the files."""
    out = fresh_dir(spark, "analysis")
    run_analysis(spark, metric_files(spark, sf), out, ["zscore", "iqr"], compare=True)
    keys = ["cloudbed", "cmdb_id", "kpi_name", "method"]
    texts = spark.read.schema("cloudbed string, cmdb_id string, kpi_name string, report string, method string").json(f"{out}/reports")
    flagged = spark.read.option("header", True).csv(f"{out}/anomalies").groupBy(*keys).count()
    figure = lambda name: F.regexp_extract("report", name + r": (\d+)", 1).cast("long")
    return texts.join(flagged, keys, "left").select(
        *keys, figure("Total data points").alias("total"), figure("Anomalies detected").alias("reported"),
        F.coalesce("count", F.lit(0)).alias("in_file"))


def q_e1(spark, sf):
    path = fresh_dir(spark, "job")
    run_detection(spark, metric_files(spark, sf), path, ["zscore", "iqr"])
    return spark.read.schema(
        "cloudbed string, cmdb_id string, kpi_name string, method string, anomaly_count long, total long"
    ).option("header", True).csv(f"{path}/counts")


def q_e2(spark, sf):
    found = analyze(by_type(spark, sf), ["zscore", "iqr", "ensemble"], compare=True)
    return rounded(found["comparison"], "anomaly_rate", "normal_mean", "normal_std", "anomaly_mean", "anomaly_std")


def q_e2_first(spark, sf):
    frame = series_frame(metrics(spark, sf), ["cmdb_id", "kpi_name"], ["timestamp", "event_id"], "value")
    return analyze(frame, ["iqr"], key="first")["anomalies"].select("cmdb_id", "kpi_name", "event_id", "value")


def q_e3(spark, sf):
    found = detect(by_type(spark, sf), [*STAT_VOTERS, "ensemble_stat"])
    return found.select("event_type", "event_id", "method", "is_anomaly", "anomaly_score")


def q_e5(spark, sf):
    params = {"zscore": {"threshold": 2.0}, "iqr": {"k": 3.0}, "ensemble": {"methods": ["zscore", "iqr", "grubbs"]}}
    found = detect(by_type(spark, sf), ["ensemble", "iqr", "zscore", "iqr"], params)
    return found.select("event_type", "event_id", "method", "is_anomaly")


def q_all_learned(spark, sf):
    frame = by_user(spark, sf)
    found = detect(frame, ["isolation_forest", "lof", "knn", "ocsvm", "hbos", "autoencoder", "ensemble_ml"])
    return report.counts(found, ["user_id", "method"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "s1_metric_csv": q_s1, "s1_csv_file": q_s1_file, "s1_bad_rows": q_s1_bad_rows, "s2_category": q_s2, "s3_cloudbed": q_s3,
    "s4_all_cloudbeds": q_s4, "s5_job_input": q_s5, "s6_range_read": q_s6, "s7_series_rows": q_s7,
    "k1_detections_csv": q_k1, "k2_counts_csv": q_k2, "k3_anomalies_csv": q_k3, "k4_comparison_csv": q_k4,
    "k5_summary_text": q_k5, "k6_store_write": q_k6, "k7_store_ingest": q_k7, "k7_store_merge": q_k7_again,
    "p1_one_series": q_p1, "p2_services": q_p2, "p3_kpis": q_p3, "p4_row_filters": q_p4,
    "p5_clean_names": q_p5, "p7_labels": q_p7, "p8_epochs": q_p8, "p9_first_series": q_p9,
    "a1_moments": q_a1, "a2_median_mad": q_a2, "a3_fences": q_a3, "a4_resample": q_a4,
    "a4_resample_7min": q_a4_odd, "a5_counts": q_a5, "a6_cut": q_a6,
    "a2_quantiles_approx": q_a2_approx, "st_stream_flags": q_st_flags, "st_stream_counts": q_st_counts,
    "w0_index": q_w0, "w1_rolling": q_w1, "w2_ema": q_w2, "w3_lags": q_w3, "w4_trailing": q_w4, "w5_trend": q_w5,
    "w0_index_blocks": q_w0_blocks,
    "j1_series_statistic": q_j1, "j2_side_by_side": q_j2, "j3_neighbour_distance": q_j3,
    "o1_sorted": q_o1, "u1_union": q_u1,
    "d1_zscore": flag_query("zscore", by_type), "d1_counts": q_d1_counts,
    "d1_zscore_supplier": flag_query("zscore", by_supplier),
    "d2_modified_zscore": flag_query("modified_zscore", by_type),
    "d3_iqr": flag_query("iqr", by_type),
    "d4_moving_average": flag_query("moving_average", by_type),
    "d4_moving_average_odd": flag_query("moving_average", by_type, {"window": 7, "threshold": 2.2}),
    "d5_ema": flag_query("ema", by_type),
    "d5_ema_span50": flag_query("ema", by_supplier, {"span": 50, "threshold": 2.0}),
    "d6_seasonal": flag_query("seasonal", by_type), "d6_parts": q_d6_parts,
    "d6_seasonal_odd": flag_query("seasonal", by_type, {"period": 7, "threshold": 2.5}),
    "d6_seasonal_short": flag_query("seasonal", by_user, {"period": 40, "threshold": 2.0}),
    "d7_grubbs": flag_query("grubbs", by_type), "d7_grubbs_user": flag_query("grubbs", by_user),
    "d8_ensemble_stat": flag_query("ensemble", by_type),
    "d8_ensemble_supplier": flag_query("ensemble", by_supplier),
    "d6_seasonal_blocks": flag_query("seasonal", by_type_blocks),
    "d8_ensemble_blocks": flag_query("ensemble", by_type_blocks),
    "m0_features": q_m0, "m0_features_blocks": q_m0_blocks, "m0b_scaled": q_m0b,
    "m1_isolation_forest": flag_query("isolation_forest", by_type),
    "m1_scores": score_query(iforest_scores, by_user),
    "m2_lof": flag_query("lof", by_user), "m2_scores": q_m2_scores,
    "m3_knn": flag_query("knn", by_user), "m3_knn_type": flag_query("knn", by_type), "m2_lof_cells": q_m2_cells, "m3_knn_cells": q_m3_cells,
    "m4_ocsvm": flag_query("ocsvm", by_user), "m4_scores": score_query(ocsvm_scores, by_user),
    "m5_hbos": flag_query("hbos", by_type), "m5_scores": score_query(hbos_scores, by_supplier),
    "m6_autoencoder": flag_query("autoencoder", by_type), "m6_scores": score_query(pca_scores, by_type),
    "m7_ensemble_ml": flag_query("ensemble_ml", by_user), "m_all_counts": q_all_learned,
    "r2_summary": q_r2, "r3_comparison": q_r3, "r3_comparison_wide": q_r3_wide, "r4_histogram": q_r4,
    "r5_box_plot": q_r5, "r6_matrix": q_r6, "r8_overlay": q_r8, "r8_overlay_ties": q_r8_ties,
    "r8_overlay_small": q_r8_small, "e2_plot_files": q_e2_plots,
    "e1_detection_job": q_e1, "e2_analysis": q_e2, "e2_first_series": q_e2_first, "e2_outputs": q_e2_outputs,
    "e3_many_methods": q_e3, "e5_dispatch": q_e5,
}


def pipeline_module() -> ModuleType | None:
    """Queries of the training-data operators, where that subpackage is there."""
    try:
        from seriesguard.llm import queries as found
    except ImportError:  # the subpackage, or a library that only it needs, is not there
        return None
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator."""
    more = pipeline_module()
    return QUERIES | (more.queries() if more else {})


# ---------------------------------------------------------------- the same in SQL

# key column -> (row id columns, order, value, table)
SOURCES = {
    "event_type": ("event_id", "ts, event_id", "value", "events"),
    "user_id": ("event_id", "ts, event_id", "value", "events"),
    "l_suppkey": ("l_orderkey, l_linenumber", "l_shipdate, l_orderkey, l_linenumber", "l_extendedprice", "lineitem"),
}


def src(key: str) -> str:
    ids, order, value, name = SOURCES[key]
    return (f"src AS (SELECT {key}, {ids}, {value} AS value, "
            f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS i, "
            f"count(*) OVER (PARTITION BY {key}) AS n FROM {name})")


def zscore_sql(key: str, t: float = 3.0, name: str = "zscore") -> str:
    return f"""{name}_s AS (SELECT {key}, avg(value) AS m, stddev_pop(value) AS sd FROM src GROUP BY {key}),
{name} AS (SELECT src.*, (sd > 0 AND abs((value - m) / sd) > {t}) AS flag FROM src JOIN {name}_s USING ({key}))"""


def modified_zscore_sql(key: str, t: float = 3.5) -> str:
    return f"""mz_med AS (SELECT {key}, quantile_cont(value, 0.5) AS med FROM src GROUP BY {key}),
mz_mad AS (SELECT {key}, quantile_cont(abs(value - med), 0.5) AS mad FROM src JOIN mz_med USING ({key}) GROUP BY {key}),
modified_zscore AS (SELECT src.*, (mad > 0 AND 0.6745 * abs(value - med) / mad > {t}) AS flag
  FROM src JOIN mz_med USING ({key}) JOIN mz_mad USING ({key}))"""


def iqr_sql(key: str, k: float = 1.5, name: str = "iqr") -> str:
    return f"""{name}_q AS (SELECT {key}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM src GROUP BY {key}),
{name} AS (SELECT src.*, (value < q1 - {k} * (q3 - q1) OR value > q3 + {k} * (q3 - q1)) AS flag
  FROM src JOIN {name}_q USING ({key}))"""


def rolling_sql(key: str, w: int = 10) -> str:
    return f"""roll AS (SELECT *, CASE WHEN count(*) OVER fr = {w} THEN avg(value) OVER fr END AS ma,
  CASE WHEN count(*) OVER fr = {w} THEN stddev_samp(value) OVER fr END AS msd FROM src
  WINDOW fr AS (PARTITION BY {key} ORDER BY i ROWS BETWEEN {w // 2} PRECEDING AND {(w - 1) // 2} FOLLOWING))"""


def moving_average_sql(key: str, w: int = 10, t: float = 3.0) -> str:
    return f"""{rolling_sql(key, w)},
roll_s AS (SELECT {key}, avg(ma) AS ma0, stddev_pop(msd) AS msd0 FROM roll GROUP BY {key}),
roll_f AS (SELECT roll.*, coalesce(ma, ma0) AS fma, coalesce(msd, msd0) AS fsd FROM roll JOIN roll_s USING ({key})),
moving_average AS (SELECT *, coalesce(abs(value - fma) /
  CASE WHEN fsd <= 1e-12 * greatest(1.0, abs(fma)) THEN 1.0 ELSE fsd END > {t}, false) AS flag FROM roll_f)"""


def ema_sql(key: str, span: int = 10) -> str:
    keep = f"(1.0 - 2.0 / ({span} + 1.0))"
    reach = windows.ema_reach(span)
    return f"""ew AS (SELECT a.{key}, a.i, sum(b.value * pow({keep}, a.i - b.i)) / sum(pow({keep}, a.i - b.i)) AS ema
  FROM src a JOIN src b ON a.{key} = b.{key} AND b.i <= a.i AND b.i >= a.i - {reach} GROUP BY a.{key}, a.i)"""


def ema_flag_sql(key: str, span: int = 10, t: float = 3.0) -> str:
    return f"""{ema_sql(key, span)},
ew_r AS (SELECT src.*, value - ema AS r FROM src JOIN ew USING ({key}, i)),
ew_s AS (SELECT {key}, stddev_pop(r) AS sd, avg(value) AS level FROM ew_r GROUP BY {key}),
ema AS (SELECT ew_r.*, (NOT sd <= 1e-12 * greatest(1.0, abs(level)) AND abs(r) > {t} * sd) AS flag
  FROM ew_r JOIN ew_s USING ({key}))"""


def trend_sql(key: str, p: int) -> str:
    h = p // 2
    ends = f" - 0.5 * (lag(value, {h}) OVER o + lead(value, {h}) OVER o)" if p % 2 == 0 else ""
    return f"""tr AS (SELECT *, CASE WHEN count(*) OVER fr = {2 * h + 1} THEN (sum(value) OVER fr{ends}) / {p} END AS trend
  FROM src WINDOW o AS (PARTITION BY {key} ORDER BY i),
  fr AS (PARTITION BY {key} ORDER BY i ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING))"""


def residual_sql(key: str, p: int) -> str:
    h = p // 2
    front = f"FILTER (WHERE i >= {h} AND i < least({h + p}, n - 1 - {h}))"
    back = f"FILTER (WHERE i >= greatest({h}, n - 1 - {h} - {p}) AND i < n - 1 - {h})"
    return f"""{trend_sql(key, p)},
en AS (SELECT {key}, regr_slope(trend, i) {front} AS fs, regr_intercept(trend, i) {front} AS fi,
  regr_slope(trend, i) {back} AS bs, regr_intercept(trend, i) {back} AS bi FROM tr GROUP BY {key}),
fl AS (SELECT tr.*, CASE WHEN i < {h} THEN fs * i + fi WHEN i > n - 1 - {h} THEN bs * i + bi ELSE trend END AS full_trend
  FROM tr JOIN en USING ({key})),
ph AS (SELECT {key}, i % {p} AS phase, avg(value - full_trend) AS m FROM fl WHERE n >= {2 * p} GROUP BY 1, 2),
ce AS (SELECT {key}, avg(m) AS c FROM ph GROUP BY 1),
re AS (SELECT fl.*, m - c AS season, value - full_trend - (m - c) AS resid
  FROM fl LEFT JOIN ph ON ph.{key} = fl.{key} AND ph.phase = fl.i % {p} LEFT JOIN ce ON ce.{key} = fl.{key})"""


def seasonal_sql(key: str, p: int = 24, t: float = 3.0) -> str:
    return f"""{residual_sql(key, p)},
re_s AS (SELECT {key}, avg(resid) AS rm, stddev_pop(resid) AS rsd, avg(value) AS m, stddev_pop(value) AS sd FROM re GROUP BY {key}),
seasonal AS (SELECT re.*, CASE WHEN n < {2 * p} THEN sd > 0 AND abs((value - m) / sd) > {t}
  ELSE NOT rsd <= 1e-12 * greatest(1.0, abs(m)) AND abs(resid - rm) > {t} * rsd END AS flag FROM re JOIN re_s USING ({key}))"""


def vote_sql(key: str, members: tuple[str, ...] = STAT_VOTERS, needed: float = 2.5) -> str:
    votes = " + ".join(f"CAST({m}.flag AS INT)" for m in members)
    joins = f" JOIN ".join([members[0], *[f"{m} USING ({key}, i)" for m in members[1:]]])
    ids = ", ".join(f"{members[0]}.{c.strip()}" for c in SOURCES[key][0].split(","))
    return f"ensemble_stat AS (SELECT {key}, i, {ids}, {members[0]}.value, {votes} >= {needed} AS flag FROM {joins})"


def voters_sql(key: str) -> str:
    return ",\n".join([zscore_sql(key), modified_zscore_sql(key), iqr_sql(key), moving_average_sql(key), ema_flag_sql(key)])


def features_sql(key: str, w: int = 10) -> str:
    ids = SOURCES[key][0]
    return f"""ft AS MATERIALIZED (SELECT {key}, {ids}, i, value, avg(value) OVER fr AS mean, stddev_pop(value) OVER fr AS std,
  min(value) OVER fr AS min, max(value) OVER fr AS max, quantile_cont(value, 0.5) OVER fr AS median,
  value - lag(value, 1) OVER o AS diff, value - avg(value) OVER fr AS dev,
  lag(value, 1) OVER o AS lag1, lag(value, 2) OVER o AS lag2, lag(value, 5) OVER o AS lag5 FROM src
  WINDOW o AS (PARTITION BY {key} ORDER BY i),
  fr AS (PARTITION BY {key} ORDER BY i ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) QUALIFY i >= {w})"""


def divisor_sql(x: str) -> str:
    return f"CASE WHEN stddev_pop({x}) <= 1e-12 * greatest(1.0, abs(avg({x}))) THEN 1.0 ELSE stddev_pop({x}) END"


def scaled_sql(key: str) -> str:
    stats_list = ", ".join(f"avg({f}) AS m_{f}, {divisor_sql(f)} AS s_{f}" for f in FEATURES)
    z = ", ".join(f"(ft.{f} - m_{f}) / s_{f} AS {f}" for f in FEATURES)
    ids = ", ".join(f"ft.{c.strip()}" for c in SOURCES[key][0].split(","))
    return f"""{features_sql(key)},
fm AS (SELECT {key}, {stats_list} FROM ft GROUP BY {key}),
sc AS (SELECT {key}, {ids}, ft.i, {z} FROM ft JOIN fm USING ({key}))"""


def hbos_sql(key: str, bins: int = 10) -> str:
    return f"""{features_sql(key)},
up AS (SELECT {key}, i, f, x FROM (SELECT {key}, i, {", ".join(FEATURES)} FROM ft) UNPIVOT (x FOR f IN ({", ".join(FEATURES)}))),
rg AS (SELECT {key}, f, min(x) AS lo, max(x) AS hi, {divisor_sql("x")} AS sd, count(*) AS m FROM up GROUP BY 1, 2),
bn AS MATERIALIZED (SELECT up.*, rg.m, CASE WHEN hi > lo THEN (hi - lo) / sd ELSE 1.0 END / {bins} AS width,
  CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) ELSE 0 END AS b
  FROM up JOIN rg USING ({key}, f)),
ct AS (SELECT {key}, f, b, count(*) AS c FROM bn GROUP BY 1, 2, 3),
hs_raw AS (SELECT {key}, i, sum(-log2(c / (m * width) + 0.1)) AS score FROM bn JOIN ct USING ({key}, f, b) GROUP BY 1, 2),
hs AS (SELECT {key}, i, round(score, 9) AS score FROM hs_raw)"""


def pairs_sql(key: str) -> str:
    apart = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in FEATURES)
    return f"""{scaled_sql(key)},
pr AS (SELECT a.{key}, a.i, b.i AS j, sqrt({apart}) AS d FROM sc a JOIN sc b ON a.{key} = b.{key} AND a.i <> b.i),
nb AS (SELECT *, row_number() OVER (PARTITION BY {key}, i ORDER BY d, j) AS rk,
  count(*) OVER (PARTITION BY {key}, i) AS others FROM pr)"""


def knn_sql(key: str, k: int = 5) -> str:
    return f"{pairs_sql(key)},\nkn AS (SELECT {key}, i, d AS score FROM nb WHERE rk = least({k}, others))"


def lof_sql(key: str, k: int = 20) -> str:
    return f"""{pairs_sql(key)},
nk AS (SELECT * FROM nb WHERE rk <= {k}),
kd AS (SELECT {key}, i, max(d) AS kd FROM nk GROUP BY 1, 2),
de AS (SELECT nk.{key}, nk.i, 1.0 / (avg(greatest(nk.d, kd.kd)) + 1e-10) AS density
  FROM nk JOIN kd ON kd.{key} = nk.{key} AND kd.i = nk.j GROUP BY 1, 2),
lo AS (SELECT nk.{key}, nk.i, avg(o.density) / any_value(de.density) AS score
  FROM nk JOIN de o ON o.{key} = nk.{key} AND o.i = nk.j JOIN de ON de.{key} = nk.{key} AND de.i = nk.i GROUP BY 1, 2)"""


def forest_sql(key: str, trees: int = 100, sample: int = 256) -> str:
    """The isolation forest grown level by level on all rows at once; sampled ones decide.

    The same digests as the library's: of tree and span for the sample, of tree and node for feature and cut.
    """
    chance = lambda what, place: f"('0x' || md5('{what}:' || tree || ':' || {place})[1:8])::BIGINT / 4294967296.0"
    varied = [f"(h{j} > l{j})::INT" for j in range(len(FEATURES))]
    # place of a feature among those that vary
    pick = " ".join(f"WHEN h{j} > l{j} AND {' + '.join(varied[:j]) or 0} = rk THEN {j}" for j in range(len(FEATURES)))
    choose = lambda name: " ".join(f"WHEN {j} THEN {name.format(j=j)}" for j in range(len(FEATURES)))
    ends = ", ".join(f"min(f{j}) FILTER (WHERE s) OVER g AS l{j}, max(f{j}) FILTER (WHERE s) OVER g AS h{j}" for j in range(len(FEATURES)))
    cols = ", ".join(f"f{j}" for j in range(len(FEATURES)))
    usual = "CASE WHEN {c} > 2 THEN 2.0 * (ln({c} - 1.0) + 0.5772156649015329) - 2.0 * ({c} - 1.0) / {c} WHEN {c} = 2 THEN 1.0 ELSE 0.0 END"
    return f"""{features_sql(key)},
fr AS MATERIALIZED (SELECT {key}, i, i - 10 AS r, {", ".join(f"{f} AS f{j}" for j, f in enumerate(FEATURES))},
  count(*) OVER (PARTITION BY {key}) AS m FROM ft),
tt AS (SELECT unnest(range({trees})) AS tree),
sa AS MATERIALIZED (SELECT {key}, tree, CAST(floor((j + {chance("row", "j")}) * m / {sample}) AS BIGINT) AS r
  FROM (SELECT {key}, max(m) AS m FROM fr GROUP BY 1 HAVING max(m) > {sample}), tt, (SELECT unnest(range({sample})) AS j)),
st AS (SELECT fr.*, tt.tree, m <= {sample} OR sa.r IS NOT NULL AS s, least(m, {sample}) AS size
  FROM fr CROSS JOIN tt LEFT JOIN sa ON sa.{key} = fr.{key} AND sa.tree = tt.tree AND sa.r = fr.r),
gw({key}, i, tree, s, size, {cols}, level, node, path) AS (
  SELECT {key}, i, tree, s, size, {cols}, 0, 0::BIGINT, NULL::DOUBLE FROM st
  UNION ALL
  SELECT {key}, i, tree, s, size, {cols}, level + 1,
    2 * node + 1 + (CASE dim {choose("f{j}")} END > CASE dim {choose("l{j}")} END + {chance("cut", "node")}
      * (CASE dim {choose("h{j}")} END - CASE dim {choose("l{j}")} END))::INT,
    CASE WHEN coalesce(vs, 0) = 0 OR c <= 1 OR level = ceil(log2(greatest(size, 2))) THEN level + {usual.format(c="c")} END
  FROM (SELECT *, CASE {pick} ELSE 0 END AS dim FROM (
    SELECT *, {" + ".join(varied)} AS vs, floor({chance("feature", "node")} * coalesce({" + ".join(varied)}, 0)) AS rk FROM (
      SELECT *, count(*) FILTER (WHERE s) OVER g AS c, {ends} FROM gw WHERE path IS NULL
      WINDOW g AS (PARTITION BY {key}, tree, node))))),
fo AS (SELECT {key}, i, pow(2.0, -avg(path) / nullif({usual.format(c="any_value(size)")}, 0)) AS x FROM gw WHERE path IS NOT NULL GROUP BY 1, 2),
fs AS (SELECT {key}, i, coalesce(x, 0.5) AS score FROM fo)"""


def pca_sql(key: str, axes: int = 3, squarings: int = 40) -> str:
    """Reconstruction error from the leading axes: each is what the matrix of products tends to when squared again and again;
    the matrix then goes on without it."""
    w = len(FEATURES)
    centred = ", ".join(f"ft.{f} - m_{f} AS x{j}" for j, f in enumerate(FEATURES))
    products = ", ".join(f"sum(x{a} * x{b})" for a in range(w) for b in range(w))
    trace = lambda m: f"list_sum(list_transform(range({w}), lambda k: {m}[k * {w + 1} + 1]))"
    square = (f"list_transform(range({w * w}), lambda p: list_sum(list_transform(range({w}), "
              f"lambda k: m[(p // {w}) * {w} + k + 1] * m[k * {w} + p % {w} + 1])))")
    rest = f"list_transform(range({w * w}), lambda p: a[p + 1] - size * v[p // {w} + 1] * v[p % {w} + 1])"
    size = f"list_sum(list_transform(range({w * w}), lambda p: a[p + 1] * v[p // {w} + 1] * v[p % {w} + 1]))"
    on = lambda c: " + ".join(f"x{j} * vs[{c + 1}][{j + 1}]" for j in range(w))
    left = lambda j: f"x{j} - " + " - ".join(f"p{c} * vs[{c + 1}][{j + 1}]" for c in range(axes))
    return f"""{features_sql(key)},
pm AS (SELECT {key}, {", ".join(f"avg({f}) AS m_{f}" for f in FEATURES)} FROM ft GROUP BY 1),
cx AS MATERIALIZED (SELECT ft.{key}, i, {centred} FROM ft JOIN pm USING ({key})),
mt AS (SELECT {key}, [{products}] AS a FROM cx GROUP BY 1),
pw({key}, t, a, m, vs) AS (
  SELECT {key}, 0, a, a, CAST([] AS DOUBLE[][]) FROM mt
  UNION ALL
  SELECT {key}, t + 1, CASE WHEN done THEN {rest} ELSE a END, CASE WHEN done THEN {rest} ELSE sq END,
    CASE WHEN done THEN list_append(vs, v) ELSE vs END
  FROM (SELECT *, {size} AS size FROM (
    SELECT *, list_transform(range({w}), lambda j: coalesce(sq[j * {w} + c + 1] / nullif(sqrt(sq[c * {w + 1} + 1]), 0), 0)) AS v FROM (
      SELECT *, list_position(dg, list_max(dg)) - 1 AS c FROM (
        SELECT *, list_transform(range({w}), lambda k: sq[k * {w + 1} + 1]) AS dg FROM (
          SELECT {key}, t, a, vs, done, list_transform(raw, lambda x: coalesce(x / nullif(tr, 0), 0)) AS sq FROM (
            SELECT *, {trace("raw")} AS tr FROM (
              SELECT {key}, t, a, vs, t % {squarings} = {squarings - 1} AS done, {square} AS raw FROM pw WHERE t < {axes * squarings})))))))),
px AS (SELECT cx.*, vs, {", ".join(f"{on(c)} AS p{c}" for c in range(axes))} FROM cx JOIN (SELECT {key}, vs FROM pw WHERE t = {axes * squarings}) USING ({key})),
pc AS (SELECT {key}, i, ({" + ".join(f"pow({left(j)}, 2)" for j in range(w))}) / {w} AS score FROM px)"""


def boundary_sql(key: str, nu: float = 0.1, tolerance: float = 1e-13, zero: float = 2e-6) -> str:
    """The one-class boundary: weight moves between the pair of rows that violates optimality most, one pair a round."""
    apart = " + ".join(f"pow(a.{f} - b.{f}, 2)" for f in FEATURES)
    bend = "greatest(2.0 - 2.0 * ki[k + 1], 1e-12)"
    return f"""{scaled_sql(key)},
kp AS (SELECT a.{key}, list(exp(-({apart}) / {len(FEATURES)}) ORDER BY a.i, b.i) AS kk FROM sc a JOIN sc b USING ({key}) GROUP BY 1),
km AS MATERIALIZED (SELECT {key}, kk, CAST(sqrt(len(kk)) AS BIGINT) AS m FROM kp),
s0 AS (SELECT *, list_transform(range(m), lambda k: least(1::DOUBLE, greatest(0::DOUBLE, {nu}::DOUBLE * m - k))) AS w FROM km),
sm({key}, t, w, f) AS (
  SELECT {key}, 0, w, list_transform(range(m), lambda r: list_sum(list_transform(range(m), lambda k: kk[r * m + k + 1] * w[k + 1]))) FROM s0
  UNION ALL
  SELECT {key}, t + 1, list_transform(range(m), lambda k: CASE k + 1 WHEN i THEN CASE WHEN d = 1 - w[i] THEN 1::DOUBLE ELSE w[i] + d END
      WHEN j THEN CASE WHEN d = w[j] THEN 0::DOUBLE ELSE w[j] - d END ELSE w[k + 1] END),
    list_transform(range(m), lambda k: f[k + 1] + d * (ki[k + 1] - kk[(j - 1) * m + k + 1]))
  FROM (SELECT *, least(gap[j] / greatest(2.0 - 2.0 * ki[j], 1e-12), 1 - w[i], w[j]) AS d FROM (
    SELECT *, list_position(gain, list_max(gain)) AS j FROM (
      SELECT *, list_transform(range(m), lambda k: CASE WHEN gap[k + 1] > 0 THEN gap[k + 1] * gap[k + 1] / {bend} ELSE -1 END) AS gain FROM (
        SELECT *, list_transform(range(m), lambda k: CASE WHEN w[k + 1] > 0 THEN f[k + 1] - f[i] ELSE -1e300 END) AS gap,
          list_slice(kk, (i - 1) * m + 1, i * m) AS ki FROM (
          SELECT *, list_position(low, list_min(low)) AS i FROM (
            SELECT sm.*, kk, m, list_transform(range(m), lambda k: CASE WHEN w[k + 1] < 1 THEN f[k + 1] ELSE 1e300 END) AS low
            FROM sm JOIN km USING ({key})))))
    WHERE list_max(gap) > {tolerance} AND w[i] < 1))),
sf AS (SELECT {key}, arg_max(w, t) AS w, arg_max(f, t) AS f FROM sm GROUP BY 1),
so AS (SELECT *, coalesce(list_avg(between), (list_max(capped) + coalesce(list_min(bare), list_max(capped))) / 2.0) AS cut FROM (
  SELECT *, list_transform(list_filter(range(len(w)), lambda k: w[k + 1] > 0 AND w[k + 1] < 1), lambda k: f[k + 1]) AS between,
    list_transform(list_filter(range(len(w)), lambda k: w[k + 1] >= 1), lambda k: f[k + 1]) AS capped,
    list_transform(list_filter(range(len(w)), lambda k: w[k + 1] <= 0), lambda k: f[k + 1]) AS bare FROM sf)),
ob AS (SELECT {key}, i, CASE WHEN abs(cut - x) <= {zero} THEN 0.0 ELSE cut - x END AS score
  FROM (SELECT {key}, cut, unnest(f) AS x, unnest(range(len(f))) + 10 AS i FROM so))"""


#: Rows beyond the boundary.
OUTSIDE_SQL = "ocsvm AS (SELECT src.*, coalesce(score > 0, false) AS flag FROM src LEFT JOIN ob USING (user_id, i))"


def cut_sql(key: str, scores: str, name: str, share: float = 0.1) -> str:
    return f"""{name}_c AS (SELECT {key}, quantile_cont(score, {1 - share}) AS cut FROM {scores} GROUP BY 1),
{name} AS (SELECT src.*, coalesce(score > cut, false) AS flag FROM src LEFT JOIN {scores} USING ({key}, i) LEFT JOIN {name}_c USING ({key}))"""


def learned_sql(key: str, every: bool = False) -> str:
    """Flags of the three voting learned methods and their vote; of all six with ``every``."""
    after = lambda sql, shared: sql.replace(shared + ",\n", "", 1)
    parts = [lof_sql(key), after(knn_sql(key), pairs_sql(key)), after(forest_sql(key), features_sql(key)),
             cut_sql(key, "lo", "lof"), cut_sql(key, "kn", "knn"), cut_sql(key, "fs", "isolation_forest")]
    if every:
        parts += [after(hbos_sql(key), features_sql(key)), after(pca_sql(key), features_sql(key)), after(boundary_sql(key), scaled_sql(key)),
                  cut_sql(key, "hs", "hbos"), cut_sql(key, "pc", "autoencoder", 0.05), OUTSIDE_SQL]
    vote = f"""ensemble_ml AS (SELECT l.*, k.flag::INT + f.flag::INT + l.vote >= 1.5 AS flag
  FROM (SELECT * EXCLUDE (flag), flag::INT AS vote FROM lof) l JOIN knn k USING ({key}, i) JOIN isolation_forest f USING ({key}, i))"""
    return ",\n".join([*parts, vote])


def flags_sql(key: str, method: str, ctes: str) -> str:
    return (f"WITH {src(key)},\n{ctes}\nSELECT {key}, {SOURCES[key][0]}, value, flag AS is_anomaly, "
            f"CAST(flag AS DOUBLE) AS anomaly_score FROM {method}")


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def long_sql(key: str, methods: list[str], ctes: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {key}, {SOURCES[key][0]}, i, value, '{m}' AS method, flag AS is_anomaly FROM {m}" for m in methods)
    return f"WITH {src(key)},\n{ctes},\nlo_all AS ({parts})"


def summary_sql(key: str, methods: list[str], ctes: str) -> str:
    def figure(call: str, cond: str, none: str) -> str:
        return f"round(CASE WHEN {none} THEN 0.0 ELSE {call} FILTER (WHERE {cond}) END, 6)"

    hits = "count(*) FILTER (WHERE is_anomaly)"
    return f"""{long_sql(key, methods, ctes)}
SELECT {key}, method, count(*) AS total_points, {hits} AS anomaly_count, round({hits} / count(*), 6) AS anomaly_rate,
{figure("avg(value)", "NOT is_anomaly", f"{hits} = count(*)")} AS normal_mean,
{figure("stddev_samp(value)", "NOT is_anomaly", f"{hits} = count(*)")} AS normal_std,
{figure("avg(value)", "is_anomaly", f"{hits} = 0")} AS anomaly_mean,
{figure("stddev_samp(value)", "is_anomaly", f"{hits} = 0")} AS anomaly_std FROM lo_all GROUP BY 1, 2"""


def rounds(names) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


METRICS_SQL = f"""SELECT CASE user_id % 2 WHEN 0 THEN '{BEDS[0]}' ELSE '{BEDS[1]}' END AS cloudbed,
CASE event_type {" ".join(f"WHEN '{t}' THEN '{c}'" for t, c in CATEGORY.items())} END AS category,
'user_' || user_id AS cmdb_id, event_type || '.value' AS kpi_name, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, value FROM events"""


def metric_sql(where: str = "true") -> str:
    return f"SELECT * FROM ({METRICS_SQL}) WHERE {where}"


def resample_sql(seconds: int) -> str:
    return f"""WITH o AS (SELECT event_type, epoch(date_trunc('day', min(ts))) AS day, min(epoch(ts)) AS a, max(epoch(ts)) AS b
  FROM events GROUP BY 1),
g AS (SELECT event_type, day, unnest(range(CAST(floor((a - day) / {seconds}) AS BIGINT), CAST(floor((b - day) / {seconds}) AS BIGINT) + 1)) AS k FROM o),
m AS (SELECT event_type, CAST(floor((epoch(ts) - day) / {seconds}) AS BIGINT) AS k, avg(value) AS value
  FROM events JOIN o USING (event_type) GROUP BY 1, 2)
SELECT event_type, CAST(day AS BIGINT) + k * {seconds} AS bin_start, round(value, 6) AS value FROM g LEFT JOIN m USING (event_type, k)"""


def t_within(t: float, df: int) -> float:
    """P(|T| <= t) of Student's t for whole degrees of freedom, by its finite sum of powers of a cosine."""
    angle = math.atan(t / math.sqrt(df))
    sine, square = math.sin(angle), math.cos(angle) ** 2
    if df % 2 == 0:
        k = np.arange(1, df // 2)
        return sine * (1.0 + float(np.cumprod((2 * k - 1) / (2 * k) * square).sum()))
    k = np.arange(1, (df - 1) // 2)
    terms = 1.0 + float(np.cumprod(2 * k / (2 * k + 1) * square).sum()) if df > 1 else 0.0
    return 2.0 / math.pi * (angle + sine * math.cos(angle) * terms)


def grubbs_critical(n: int, alpha: float = 0.05) -> float:
    low, high = 0.0, 1.0
    while t_within(high, n - 2) < 1.0 - alpha / n:
        high *= 2.0
    for _ in range(50):
        mid = (low + high) / 2.0
        low, high = (mid, high) if t_within(mid, n - 2) < 1.0 - alpha / n else (low, mid)
    return (n - 1) / math.sqrt(n) * math.sqrt(low * low / (n - 2 + low * low))


@functools.cache
def grubbs_sql(key: str, most: int = 2600) -> str:
    """The removal loop with critical values of their own making, for series of up to ``most`` rows; an error beyond."""
    ids = SOURCES[key][0]
    values = ", ".join(f"({n}, {grubbs_critical(n)!r}::DOUBLE)" for n in range(3, most + 1))
    return f"""WITH RECURSIVE {src(key)},
cr(n, g) AS (VALUES {values}),
re AS (SELECT {key}, list(value ORDER BY i) AS vs, list(i ORDER BY i) AS ps, CAST(NULL AS BIGINT) AS gone FROM src GROUP BY {key}
  UNION ALL
  SELECT {key}, list_concat(list_slice(vs, 1, j - 1), list_slice(vs, j + 1, len(vs))),
    list_concat(list_slice(ps, 1, j - 1), list_slice(ps, j + 1, len(ps))), list_extract(ps, j)
  FROM (SELECT *, list_position(ds, list_max(ds)) AS j FROM (
    SELECT {key}, vs, ps, sd, list_transform(vs, lambda x: abs(x - m)) AS ds FROM (
      SELECT {key}, vs, ps, list_avg(vs) AS m, list_stddev_pop(vs) AS sd FROM re WHERE len(vs) > 2)))
  JOIN cr ON cr.n = len(vs) WHERE sd > 0 AND list_max(ds) / sd > g)
SELECT src.{key}, {ids}, value, gone IS NOT NULL AS is_anomaly, CAST(gone IS NOT NULL AS DOUBLE) AS anomaly_score
FROM src LEFT JOIN (SELECT {key}, gone FROM re WHERE gone IS NOT NULL) re ON src.{key} = re.{key} AND src.i = re.gone
WHERE CASE WHEN n > {most} THEN error('a series is too long for these critical values') ELSE true END"""


RATE_LINES = """'Anomaly Detection Summary Report' || chr(10) || repeat('=', 50) || chr(10) || chr(10)
|| 'Method: ' || method || chr(10) || 'Total data points: ' || total || chr(10) || 'Anomalies detected: ' || hits || chr(10)
|| printf('Anomaly rate: %.2f%%', 100.0 * hits / total) || chr(10) || chr(10)
|| 'Normal values:' || chr(10) || printf('  Mean: %.4f', nm) || chr(10) || printf('  Std: %.4f', ns) || chr(10) || chr(10)
|| 'Anomalous values:' || chr(10) || printf('  Mean: %.4f', am) || chr(10) || printf('  Std: %.4f', asd)"""


def oracle_sql() -> dict[str, str]:
    """SQL with the same result, for every query SQL can express."""
    T, U, L = "event_type", "user_id", "l_suppkey"
    zi = f"{zscore_sql(T)},\n{iqr_sql(T)}"
    beds = " , ".join(f"'{c}'" for c in csv.CATEGORIES)
    scores = "SELECT {key}, {ids}, round(score, 6) AS {name} FROM {table} JOIN src USING ({key}, i)"
    more = pipeline_module()
    return (more.oracle_sql() if more else {}) | {
        "s1_metric_csv": metric_sql(),
        "s1_csv_file": f"SELECT cmdb_id, kpi_name, epoch, value FROM ({METRICS_SQL}) WHERE cloudbed = '{BEDS[0]}' AND category = 'service'",
        "s1_bad_rows": f"""SELECT cloudbed, 'service' AS category, count(*) AS total,
count_if(event_id % 10 = 1) AS without_time, count_if(event_id % 10 = 0) AS without_value
FROM (SELECT event_id, CASE user_id % 2 WHEN 0 THEN '{BEDS[0]}' ELSE '{BEDS[1]}' END AS cloudbed FROM events) GROUP BY 1""",
        "s2_category": metric_sql(f"cloudbed = '{BEDS[1]}' AND category = 'jvm'"),
        "s3_cloudbed": metric_sql(f"cloudbed = '{BEDS[0]}' AND category IN ({beds})"),
        "s4_all_cloudbeds": metric_sql(f"category IN ({beds})"),
        "s5_job_input": metric_sql(),
        "s6_range_read": """SELECT event_id, epoch_us(ts) // 1000 AS ms, value FROM events WHERE event_type = 'error'
AND epoch_us(ts) BETWEEN 1704844800000000 AND 1705708800000000""",
        "s7_series_rows": """SELECT l_suppkey, CAST(floor(epoch(l_shipdate)) AS BIGINT) AS epoch, l_orderkey, l_linenumber,
l_extendedprice AS value FROM lineitem""",
        "k1_detections_csv": f"{long_sql(T, ['zscore', 'iqr'], zi)} SELECT event_type, event_id, epoch_us(ts) AS us, value, method, "
                             "is_anomaly, CAST(is_anomaly AS DOUBLE) AS anomaly_score FROM lo_all JOIN (SELECT event_id, ts FROM events) USING (event_id)",
        "k2_counts_csv": f"WITH {src(T)},\n{iqr_sql(T)} SELECT event_type, CAST(sum(CAST(flag AS INT)) AS BIGINT) AS anomaly_count, "
                         "count(*) AS total FROM iqr GROUP BY 1",
        "k3_anomalies_csv": f"WITH {src(T)},\n{zscore_sql(T)} SELECT event_type, event_id, epoch_us(ts) AS us, value "
                             "FROM zscore JOIN (SELECT event_id, ts FROM events) USING (event_id) WHERE flag",
        "k4_comparison_csv": summary_sql(T, ["zscore", "modified_zscore", "iqr"], f"{zi},\n{modified_zscore_sql(T)}"),
        "k5_summary_text": f"""{long_sql(T, ['zscore', 'iqr'], zi)},
su AS (SELECT event_type, method, count(*) AS total, count(*) FILTER (WHERE is_anomaly) AS hits,
  avg(value) FILTER (WHERE NOT is_anomaly) AS nm, stddev_samp(value) FILTER (WHERE NOT is_anomaly) AS ns,
  avg(value) FILTER (WHERE is_anomaly) AS am, stddev_samp(value) FILTER (WHERE is_anomaly) AS asd FROM lo_all GROUP BY 1, 2)
SELECT event_type, method, {RATE_LINES} AS report FROM su""",
        "k6_store_write": """SELECT event_type AS device, event_type AS measurement, epoch_us(ts) // 1000 AS ms,
arg_max(value, row(ts, value)) AS value FROM events GROUP BY ALL""",
        "k7_store_ingest": f"""SELECT cmdb_id AS device, replace(kpi_name, '.', '_') AS measurement, epoch * 1000 AS ms, max(value) AS value
FROM ({METRICS_SQL}) WHERE cloudbed = '{BEDS[0]}' AND category IN ({beds}) GROUP BY ALL""",
        "k7_store_merge": f"""WITH fi AS (SELECT cmdb_id AS device, replace(kpi_name, '.', '_') AS measurement, epoch * 1000 AS ms,
  max(value) AS value FROM ({METRICS_SQL}) WHERE category IN ({beds}) GROUP BY ALL),
se AS (SELECT 'user_' || user_id AS device, event_type || '_value' AS measurement, epoch_us(ts) // 1000 AS ms,
  arg_max(-value, row(ts, -value)) AS value FROM events WHERE event_id % 3 = 0 GROUP BY ALL)
SELECT * FROM se UNION ALL SELECT * FROM fi ANTI JOIN se USING (device, measurement, ms)""",
        "p1_one_series": "SELECT event_id, epoch_us(ts) AS us, value FROM events WHERE event_type = 'view' ORDER BY ts, event_id",
        "p2_services": "SELECT DISTINCT 'user_' || user_id AS cmdb_id FROM events",
        "p3_kpis": "SELECT DISTINCT event_type || '.value' AS kpi_name FROM events WHERE user_id = 7",
        "p4_row_filters": f"""WITH {src(T)},\n{zscore_sql(T)} SELECT event_type, CASE WHEN flag THEN 'anomalous' ELSE 'normal' END AS kind,
count(*) AS points, min(value) AS low, max(value) AS high FROM zscore GROUP BY 1, 2""",
        "p5_clean_names": """SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_replace(url, '[^A-Za-z0-9_]', '_', 'g'),
'_+', '_', 'g'), '_'), ''), 'unnamed') AS clean FROM pages""",
        "p7_labels": "SELECT event_id, value, value > 200 AS is_anomaly, CAST(value > 200 AS DOUBLE) AS anomaly_score FROM events",
        "p8_epochs": """SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000 * 1000 AS us_of_ms,
CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events""",
        "p9_first_series": """SELECT min('user_' || user_id) AS cmdb_id, (SELECT min(event_type || '.value') FROM events WHERE 'user_' || user_id =
(SELECT min('user_' || user_id) FROM events)) AS kpi_name FROM events""",
        "a1_moments": "SELECT l_suppkey, count(*) AS n, round(avg(l_extendedprice), 6) AS mean, round(stddev_pop(l_extendedprice), 6) AS sd "
                      "FROM lineitem GROUP BY 1",
        "a2_median_mad": f"WITH {src(L)},\n{modified_zscore_sql(L)} SELECT l_suppkey, round(med, 6) AS med, round(mad, 6) AS mad "
                         "FROM mz_med JOIN mz_mad USING (l_suppkey)",
        "a2_quantiles_approx": """SELECT l_suppkey, count(*) AS n, round(avg(l_extendedprice), 6) AS mean, round(stddev_pop(l_extendedprice), 6) AS sd,
min(l_extendedprice) AS low, max(l_extendedprice) AS high, true AS q1_holds, true AS med_holds, true AS q3_holds FROM lineitem GROUP BY 1""",
        "st_stream_flags": f"{long_sql(T, ['zscore', 'iqr'], zi)} SELECT event_type, event_id, value, method, is_anomaly, "
                           "CAST(is_anomaly AS DOUBLE) AS anomaly_score FROM lo_all",
        "st_stream_counts": f"""{long_sql(T, ['zscore', 'iqr'], zi)} SELECT event_type, method, CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 AS span,
count(*) FILTER (WHERE is_anomaly) AS anomaly_count, count(*) AS total FROM lo_all JOIN (SELECT event_id, ts FROM events) USING (event_id) GROUP BY 1, 2, 3""",
        "a3_fences": f"WITH {src(L)},\n{iqr_sql(L)} SELECT l_suppkey, round(q1, 6) AS q1, round(q3, 6) AS q3, "
                     "round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper FROM iqr_q",
        "a4_resample": resample_sql(300),
        "a4_resample_7min": resample_sql(420),
        "a5_counts": f"{long_sql(L, ['iqr', 'zscore'], zscore_sql(L) + ', ' + iqr_sql(L))} SELECT l_suppkey, method, "
                     "count(*) FILTER (WHERE is_anomaly) AS anomaly_count, count(*) AS total FROM lo_all GROUP BY 1, 2",
        "a6_cut": f"""WITH {src(L)}, {zscore_sql(L)}, ab AS (SELECT src.*, abs(value - m) AS score FROM src JOIN zscore_s USING (l_suppkey)),
cu AS (SELECT l_suppkey, quantile_cont(score, 0.9) AS cut FROM ab GROUP BY 1)
SELECT l_suppkey, l_orderkey, l_linenumber FROM ab JOIN cu USING (l_suppkey) WHERE score > cut""",
        "w0_index": f"WITH {src(L)} SELECT l_suppkey, l_orderkey, l_linenumber, i FROM src",
        "w0_index_blocks": f"WITH {src(T)} SELECT event_type, event_id, i FROM src",
        "w1_rolling": f"WITH {src(T)},\n{rolling_sql(T)} SELECT event_type, event_id, value, round(ma, 6) AS rolling_mean, "
                      "round(msd, 6) AS rolling_std FROM roll",
        "w2_ema": f"WITH {src(T)},\n{ema_sql(T)} SELECT event_type, event_id, value, round(ema, 6) AS ema FROM src JOIN ew USING (event_type, i)",
        "w3_lags": f"""WITH {src(T)} SELECT event_type, event_id, value, lag(value, 1) OVER o AS lag1, lag(value, 2) OVER o AS lag2,
lag(value, 5) OVER o AS lag5, round(value - lag(value, 1) OVER o, 6) AS diff FROM src WINDOW o AS (PARTITION BY event_type ORDER BY i)""",
        "w4_trailing": f"WITH {src(L)},\n{features_sql(L)} SELECT l_suppkey, i, {rounds(['mean', 'std', 'min', 'max', 'median', 'dev'])} FROM ft",
        "w5_trend": f"WITH {src(T)},\n{trend_sql(T, 24)} SELECT event_type, event_id, value, round(trend, 6) AS trend FROM tr",
        "j1_series_statistic": f"WITH {src(L)},\n{zscore_sql(L)} SELECT l_suppkey, l_orderkey, l_linenumber, round((value - m) / sd, 6) AS z "
                               "FROM src JOIN zscore_s USING (l_suppkey)",
        "j2_side_by_side": f"""WITH {src(T)},\n{zi},\n{hbos_sql(T)},\n{cut_sql(T, 'hs', 'hbos')}
SELECT z.event_type, z.event_id, z.flag AS zscore, q.flag AS iqr, h.flag AS hbos
FROM zscore z JOIN iqr q USING (event_type, i) JOIN hbos h USING (event_type, i)""",
        "j3_neighbour_distance": f"WITH {src(U)},\n{knn_sql(U)} " + scores.format(key=U, ids="event_id", name="knn", table="kn"),
        "o1_sorted": "SELECT event_type, event_id, value FROM events ORDER BY event_type, ts, event_id",
        "u1_union": metric_sql(),
        "d1_zscore": flags_sql(T, "zscore", zscore_sql(T)),
        "d1_counts": f"WITH {src(T)},\n{zscore_sql(T)} SELECT event_type, count(*) FILTER (WHERE flag) AS anomaly_count, count(*) AS total FROM zscore GROUP BY 1",
        "d1_zscore_supplier": flags_sql(L, "zscore", zscore_sql(L)),
        "d2_modified_zscore": flags_sql(T, "modified_zscore", modified_zscore_sql(T)),
        "d3_iqr": flags_sql(T, "iqr", iqr_sql(T)),
        "d4_moving_average": flags_sql(T, "moving_average", moving_average_sql(T)),
        "d4_moving_average_odd": flags_sql(T, "moving_average", moving_average_sql(T, 7, 2.2)),
        "d5_ema": flags_sql(T, "ema", ema_flag_sql(T)),
        "d5_ema_span50": flags_sql(L, "ema", ema_flag_sql(L, 50, 2.0)),
        "d6_seasonal": flags_sql(T, "seasonal", seasonal_sql(T)),
        "d6_parts": f"WITH {src(T)},\n{residual_sql(T, 24)} SELECT event_type, event_id, round(full_trend, 6) AS trend, "
                    "round(season, 6) AS season, round(resid, 6) AS resid FROM re",
        "d6_seasonal_odd": flags_sql(T, "seasonal", seasonal_sql(T, 7, 2.5)),
        "d6_seasonal_short": flags_sql(U, "seasonal", seasonal_sql(U, 40, 2.0)),
        "d8_ensemble_stat": flags_sql(T, "ensemble_stat", f"{voters_sql(T)},\n{vote_sql(T)}"),
        "d8_ensemble_supplier": flags_sql(L, "ensemble_stat", f"{voters_sql(L)},\n{vote_sql(L)}"),
        "d6_seasonal_blocks": flags_sql(T, "seasonal", seasonal_sql(T)),
        "d8_ensemble_blocks": flags_sql(T, "ensemble_stat", f"{voters_sql(T)},\n{vote_sql(T)}"),
        "m0_features_blocks": f"WITH {src(T)},\n{features_sql(T)} SELECT event_type, event_id, {rounds(FEATURES)} FROM ft",
        "m0_features": f"WITH {src(T)},\n{features_sql(T)} SELECT event_type, event_id, {rounds(FEATURES)} FROM ft",
        "m0b_scaled": f"WITH {src(T)},\n{scaled_sql(T)} SELECT event_type, event_id, {rounds(FEATURES)} FROM sc",
        "m1_isolation_forest": recursive(flags_sql(T, "fo_cut", f"{forest_sql(T)},\n{cut_sql(T, 'fs', 'fo_cut')}")),
        "m1_scores": recursive(f"WITH {src(U)},\n{forest_sql(U)} " + scores.format(key=U, ids="event_id", name="score", table="fs")),
        "m6_autoencoder": recursive(flags_sql(T, "pc_cut", f"{pca_sql(T)},\n{cut_sql(T, 'pc', 'pc_cut', 0.05)}")),
        "m6_scores": recursive(f"WITH {src(T)},\n{pca_sql(T)} " + scores.format(key=T, ids="event_id", name="score", table="pc")),
        "m4_scores": recursive(f"WITH {src(U)},\n{boundary_sql(U)} " + scores.format(key=U, ids="event_id", name="score", table="ob")),
        "m4_ocsvm": recursive(flags_sql(U, "ocsvm", f"{boundary_sql(U)},\n{OUTSIDE_SQL}")),
        "m7_ensemble_ml": recursive(flags_sql(U, "ensemble_ml", learned_sql(U))),
        "m_all_counts": recursive(long_sql(U, ["isolation_forest", "lof", "knn", "ocsvm", "hbos", "autoencoder", "ensemble_ml"],
                                           learned_sql(U, True)))
        + " SELECT user_id, method, count(*) FILTER (WHERE is_anomaly) AS anomaly_count, count(*) AS total FROM lo_all GROUP BY 1, 2",
        "m2_lof": flags_sql(U, "lof", f"{lof_sql(U)},\n{cut_sql(U, 'lo', 'lof')}"),
        "m2_scores": f"WITH {src(U)},\n{lof_sql(U)} " + scores.format(key=U, ids="event_id", name="lof", table="lo"),
        "m2_lof_cells": f"WITH {src(U)},\n{lof_sql(U)} " + scores.format(key=U, ids="event_id", name="lof", table="lo"),
        "m3_knn_cells": f"WITH {src(U)},\n{knn_sql(U)} " + scores.format(key=U, ids="event_id", name="knn", table="kn"),
        "m3_knn_type": flags_sql(T, "knn", f"{knn_sql(T)},\n{cut_sql(T, 'kn', 'knn')}"),
        "m3_knn": flags_sql(U, "knn", f"{knn_sql(U)},\n{cut_sql(U, 'kn', 'knn')}"),
        "m5_hbos": flags_sql(T, "hbos", f"{hbos_sql(T)},\n{cut_sql(T, 'hs', 'hbos')}"),
        "d7_grubbs": grubbs_sql(T),
        "d7_grubbs_user": grubbs_sql(U),
        "m5_scores": f"WITH {src(L)},\n{hbos_sql(L)} " + scores.format(key=L, ids="l_orderkey, l_linenumber", name="score", table="hs_raw"),
        "r2_summary": summary_sql(L, ["zscore"], zscore_sql(L)),
        "r3_comparison": summary_sql(T, ["zscore", "modified_zscore", "iqr"], f"{zi},\n{modified_zscore_sql(T)}"),
        "r3_comparison_wide": f"""{long_sql(T, ['zscore', 'modified_zscore', 'iqr'], f"{zi}, {modified_zscore_sql(T)}")} SELECT event_type,
{", ".join(f"count(*) FILTER (WHERE method = '{m}' AND is_anomaly) AS {m}" for m in ('zscore', 'modified_zscore', 'iqr'))} FROM lo_all GROUP BY 1""",
        "r4_histogram": f"""{long_sql(T, ['zscore'], zscore_sql(T))},
sp AS (SELECT event_type, method, is_anomaly, CASE WHEN is_anomaly THEN 20 ELSE 50 END AS bins,
  min(value) - CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS lo,
  max(value) + CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS hi FROM lo_all GROUP BY 1, 2, 3),
co AS (SELECT event_type, method, is_anomaly, least(CAST(floor((value - lo) / (hi - lo) * bins) AS INT), bins - 1) AS bin, count(*) AS c
  FROM lo_all JOIN sp USING (event_type, method, is_anomaly) GROUP BY 1, 2, 3, 4),
gr AS (SELECT *, CAST(unnest(range(bins)) AS INT) AS bin FROM sp)
SELECT event_type, method, is_anomaly, bin, round(lo + bin * ((hi - lo) / bins), 6) AS bin_start,
round(lo + (bin + 1) * ((hi - lo) / bins), 6) AS bin_end, coalesce(c, 0) AS points FROM gr LEFT JOIN co USING (event_type, method, is_anomaly, bin)""",
        "r5_box_plot": f"""{long_sql(T, ['zscore'], zscore_sql(T))},
q AS (SELECT event_type, method, is_anomaly, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM lo_all GROUP BY 1, 2, 3)
SELECT event_type, method, is_anomaly, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS whisker_low, max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
FROM lo_all JOIN q USING (event_type, method, is_anomaly) GROUP BY event_type, method, is_anomaly, q1, median, q3""",
        "r6_matrix": f"""{long_sql(T, ['zscore', 'iqr'], zi)} SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS bucket,
max(CASE WHEN method = 'zscore' AND is_anomaly THEN 1 ELSE 0 END) AS zscore, max(CASE WHEN method = 'iqr' AND is_anomaly THEN 1 ELSE 0 END) AS iqr
FROM lo_all JOIN (SELECT event_id, ts FROM events) USING (event_id) GROUP BY 1, 2""",
        "r8_overlay": f"""WITH {src(T)},\n{zi} SELECT event_id, z.value, z.flag AS zscore, q.flag AS iqr
FROM zscore z JOIN iqr q USING (event_type, event_id) WHERE event_type = 'click'""",
        "r8_overlay_ties": """WITH st AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events WHERE event_type = 'view')
SELECT epoch_us(ts) AS us, value, sd > 0 AND abs((value - m) / sd) > 3.0 AS zscore
FROM (SELECT * FROM events UNION ALL SELECT * FROM events), st WHERE event_type = 'view'""",
        "r8_overlay_small": f"""{long_sql(T, ['zscore', 'iqr'], zi)},
ti AS (SELECT lo_all.*, epoch_us(ts) AS us, min(epoch_us(ts)) OVER s AS t0, max(epoch_us(ts)) OVER s AS t1
  FROM lo_all JOIN (SELECT event_id, ts FROM events) USING (event_id) WINDOW s AS (PARTITION BY lo_all.event_type)),
px AS (SELECT *, floor((us - t0)::DOUBLE / ((t1 - t0)::DOUBLE + 1) * 60) AS pixel FROM ti),
rk AS (SELECT *, row_number() OVER (b ORDER BY us, value, is_anomaly) AS a1, row_number() OVER (b ORDER BY us DESC, value DESC, is_anomaly DESC) AS a2,
  row_number() OVER (b ORDER BY value, us, is_anomaly) AS a3, row_number() OVER (b ORDER BY value DESC, us DESC, is_anomaly DESC) AS a4
  FROM px WINDOW b AS (PARTITION BY event_type, method, pixel))
SELECT DISTINCT event_type, method, us, value, is_anomaly FROM rk WHERE is_anomaly OR 1 IN (a1, a2, a3, a4)""",
        "e2_plot_files": f"""WITH me AS ({METRICS_SQL}),
st AS (SELECT cloudbed, cmdb_id, kpi_name, avg(value) AS m, stddev_pop(value) AS sd, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM me GROUP BY 1, 2, 3),
lo AS (SELECT me.*, unnest(['zscore', 'iqr']) AS method, unnest([sd > 0 AND abs((value - m) / sd) > 3.0,
  value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)]) AS flag FROM me JOIN st USING (cloudbed, cmdb_id, kpi_name)),
bx AS (SELECT cloudbed, cmdb_id, kpi_name, method, flag, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM lo GROUP BY ALL),
wh AS (SELECT cloudbed, cmdb_id, kpi_name, method, min(value) AS low, max(value) AS high FROM lo JOIN bx USING (cloudbed, cmdb_id, kpi_name, method, flag)
  WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL)
SELECT cloudbed, cmdb_id, kpi_name, method, count(*) AS in_bars, any_value(low) AS low, any_value(high) AS high,
  count(DISTINCT (epoch, value)) FILTER (WHERE flag) AS flagged, count(DISTINCT epoch // 3600) FILTER (WHERE flag) AS hours
FROM lo JOIN wh USING (cloudbed, cmdb_id, kpi_name, method) GROUP BY 1, 2, 3, 4""",
        "e2_outputs": f"""WITH me AS ({METRICS_SQL}),
st AS (SELECT cloudbed, cmdb_id, kpi_name, avg(value) AS m, stddev_pop(value) AS sd, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM me GROUP BY 1, 2, 3),
fl AS (SELECT me.*, sd > 0 AND abs((value - m) / sd) > 3.0 AS z, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS q
  FROM me JOIN st USING (cloudbed, cmdb_id, kpi_name)),
lo AS (SELECT cloudbed, cmdb_id, kpi_name, 'zscore' AS method, z AS is_anomaly FROM fl
  UNION ALL SELECT cloudbed, cmdb_id, kpi_name, 'iqr', q FROM fl)
SELECT cloudbed, cmdb_id, kpi_name, method, count(*) AS total, count(*) FILTER (WHERE is_anomaly) AS reported,
  count(*) FILTER (WHERE is_anomaly) AS in_file FROM lo GROUP BY 1, 2, 3, 4""",
        "e1_detection_job": f"""WITH me AS ({METRICS_SQL}),
st AS (SELECT cloudbed, cmdb_id, kpi_name, avg(value) AS m, stddev_pop(value) AS sd, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM me GROUP BY 1, 2, 3),
fl AS (SELECT me.*, sd > 0 AND abs((value - m) / sd) > 3.0 AS z, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS q
  FROM me JOIN st USING (cloudbed, cmdb_id, kpi_name))
SELECT cloudbed, cmdb_id, kpi_name, 'zscore' AS method, count(*) FILTER (WHERE z) AS anomaly_count, count(*) AS total FROM fl GROUP BY 1, 2, 3
UNION ALL SELECT cloudbed, cmdb_id, kpi_name, 'iqr', count(*) FILTER (WHERE q), count(*) FROM fl GROUP BY 1, 2, 3""",
        "e2_analysis": summary_sql(T, ["zscore", "iqr", "ensemble_stat"], f"{voters_sql(T)},\n{vote_sql(T)}"),
        "e2_first_series": """WITH me AS (SELECT 'user_' || user_id AS cmdb_id, event_type || '.value' AS kpi_name, event_id, value FROM events),
fi AS (SELECT * FROM me ORDER BY cmdb_id, kpi_name LIMIT 1), se AS (SELECT me.* FROM me SEMI JOIN fi USING (cmdb_id, kpi_name)),
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM se)
SELECT cmdb_id, kpi_name, event_id, value FROM se, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
        "e3_many_methods": f"""{long_sql(T, [*STAT_VOTERS, "ensemble_stat"], f"{voters_sql(T)}, {vote_sql(T)}")}
SELECT event_type, event_id, method, is_anomaly, CAST(is_anomaly AS DOUBLE) AS anomaly_score FROM lo_all""",
        "e5_dispatch": f"""{long_sql(T, ["z2", "q3_", "ensemble_stat"], ", ".join([zscore_sql(T), iqr_sql(T), zscore_sql(T, 2.0, "z2"),
                                     iqr_sql(T, 3.0, "q3_"), vote_sql(T, ("zscore", "iqr"), 1.5)]))}
SELECT event_type, event_id, CASE method WHEN 'z2' THEN 'zscore' WHEN 'q3_' THEN 'iqr' ELSE method END AS method, is_anomaly FROM lo_all""",
    }
