"""End-to-end jobs."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, store
from seriesguard.operators import report
from seriesguard.operators.select import anomalous, first_series, restrict
from seriesguard.plans.registry import CONTAMINATION, detect, normalize
from seriesguard.sources.csv import KEYS, load_cloudbed, load_job_input, require_columns
from seriesguard.sources.sinks import (
    write_anomalies, write_comparison, write_counts, write_detections, write_summary_text, write_table)

DEFAULT_METHODS = ("ensemble_stat", "isolation_forest")


def metric_frame(rows: DataFrame, block_rows: int | None = None) -> SeriesFrame:
    """Metric rows as series per cloudbed, service and KPI."""
    require_columns(rows)
    keys = KEYS if "cloudbed" in rows.columns else KEYS[1:]
    return SeriesFrame(rows, keys, ("timestamp",), "value", block_rows)


def run_detection(spark: SparkSession, data_dir: str, output_dir: str,
                  methods: Sequence[str] = ("ensemble_stat",), params: Mapping[str, Mapping] | None = None,
                  fmt: str = "csv", partition_by: Sequence[str] = ("method",), window: int = 10,
                  contamination: float = CONTAMINATION, one_file: bool = True) -> None:
    """Detect with all methods over every series below ``data_dir`` in one pass and write both
    the rows and the counts per series (E1)."""
    methods = normalize(methods)
    # text is parsed once; every later pass reads the stored columns
    frame = metric_frame(store(load_job_input(spark, data_dir)))
    rows = detect(frame, methods, params, window, contamination)
    detections = f"{output_dir}/detections"
    write_detections(rows, detections, fmt, partition_by)
    # the counts come from what was written, not from a second detection run
    reader = spark.read.schema(rows.schema)
    written = reader.option("header", True).csv(detections) if fmt == "csv" else reader.format(fmt).load(detections)
    counts = report.counts(written, [*frame.keys, "method"])
    write_counts(counts, f"{output_dir}/counts", fmt, one_file=one_file)


def analyze(frame: SeriesFrame, methods: Sequence[str] = DEFAULT_METHODS, key: Mapping[str, object] | str | None = None,
            compare: bool = False, params: Mapping[str, Mapping] | None = None, window: int = 10,
            contamination: float = CONTAMINATION, stored: bool = False, pixels: int = 1000) -> dict[str, DataFrame]:
    """Detections and every report on them (E2), lazily.

    ``key`` restricts the analysis to matching series, "first" to the first by name. With
    ``compare`` and several methods, the comparison and the method matrix are added. ``stored``
    writes the detections once, for callers who use several of the results.
    """
    methods = normalize(methods)
    if key == "first":
        service, kpi = frame.keys[-2:] if len(frame.keys) > 1 else (frame.keys[0], frame.keys[0])
        key = first_series(frame.rows, service, kpi).first().asDict()
    if key:
        frame = restrict(frame, key)
    found = detect(frame, methods, params, window, contamination)
    found = store(found) if stored else found
    keys, n_groups = list(frame.keys), frame.profile.n_series * len(methods)
    summaries = report.summary(found, keys, frame.value)
    results = {
        "detections": found,
        "anomalies": anomalous(found),
        "summary": summaries,
        "summary_text": report.summary_text(summaries, keys),
        "histogram": report.histogram(found, keys, frame.value, n_groups),
        "box_plot": report.box_plot(found, keys, frame.value, frame.profile.longest, n_groups),
        "overlay": report.overlay_points(found, keys, frame.time, frame.value, pixels, frame.profile.n_series),
    }
    if compare and len(methods) > 1:
        results["comparison"] = report.comparison(found, keys, frame.value)
        results["matrix"] = report.matrix(found, keys, frame.time, methods)
    return results


def run_analysis(spark: SparkSession, data_dir: str, output_dir: str, methods: Sequence[str] = DEFAULT_METHODS,
                 service: str | None = None, kpi: str | None = None, cloudbed: str | None = None, compare: bool = False,
                 fmt: str = "csv", **options) -> None:
    """The analysis with its files (E2): anomalies, summary, text reports, and as plot data histograms, box plots and the
    overlay of values and flags; with ``compare``, the comparison and the matrix of methods over time."""
    rows = store(load_cloudbed(spark, data_dir, cloudbed) if cloudbed else load_job_input(spark, data_dir))
    named = {name: wanted for name, wanted in (("cmdb_id", service), ("kpi_name", kpi)) if wanted is not None}
    frame = metric_frame(rows)
    found = analyze(frame, methods, named or None, compare, stored=True, **options)
    write_anomalies(found["detections"], f"{output_dir}/anomalies", fmt)
    write_table(found["summary"], f"{output_dir}/summary", fmt)
    write_summary_text(found["summary_text"], f"{output_dir}/reports", frame.keys)
    for name in ("histogram", "box_plot", "overlay", "matrix"):
        if name in found:
            write_table(found[name], f"{output_dir}/{name}", fmt)
    if "comparison" in found:
        write_comparison(found["comparison"], f"{output_dir}/comparison", fmt)


def main() -> None:
    parser = argparse.ArgumentParser(description="Detect outliers in metric series")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--output-dir", default="results")
    parser.add_argument("--methods", nargs="+", default=["ensemble_stat"])
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--partition-by", nargs="*", default=["method"])
    parser.add_argument("--window", type=int, default=10)
    parser.add_argument("--contamination", type=float, default=CONTAMINATION)
    parser.add_argument("--analyze", action="store_true", help="write anomalies, summaries and reports")
    parser.add_argument("--service", help="with --analyze: only this service")
    parser.add_argument("--kpi", help="with --analyze: only this KPI")
    parser.add_argument("--cloudbed", help="with --analyze: only this cloudbed")
    parser.add_argument("--compare", action="store_true", help="with --analyze: compare the methods")
    parser.add_argument("--ingest", metavar="CLOUDBED", help="only load this cloudbed into the store at the output")
    args = parser.parse_args()
    spark = (SparkSession.builder.appName("seriesguard").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    if args.ingest:
        from seriesguard.sources.store import ingest_cloudbed

        ingest_cloudbed(spark, args.data_dir, args.ingest, args.output_dir)
    elif args.analyze:
        run_analysis(spark, args.data_dir, args.output_dir, args.methods, args.service, args.kpi, args.cloudbed,
                     args.compare, args.format, window=args.window, contamination=args.contamination)
    else:
        run_detection(spark, args.data_dir, args.output_dir, args.methods, fmt=args.format,
                      partition_by=args.partition_by, window=args.window, contamination=args.contamination)


if __name__ == "__main__":
    main()
