"""Writers for detections, counts, anomalies and reports (K1-K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


#: Times in CSV files keep their microseconds, which the default format drops.
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_table(rows: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    writer = rows.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampFormat", CSV_TIME + "XXX").option("timestampNTZFormat", CSV_TIME)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_detections(detections: DataFrame, path: str, fmt: str = "csv",
                     partition_by: Sequence[str] = ("method",), mode: str = "overwrite") -> None:
    """Row-level results (K1). Partitioning by series as well makes one directory per series:
    useful for few series, so it is left to the caller."""
    write_table(detections, path, fmt, partition_by, mode)


def write_counts(counts: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", one_file: bool = True) -> None:
    """Counts per series (K2): one file, or one per partition where the caller has too many series for that.

    The finished counts move to one task; they are not counted there.
    """
    write_table(counts.repartition(1) if one_file else counts, path, fmt, mode=mode)


def write_anomalies(detections: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Only the flagged rows (K3)."""
    write_table(detections.where("is_anomaly"), path, fmt, mode=mode)


def write_comparison(comparison: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """The summary row of every method (K4)."""
    write_table(comparison, path, fmt, mode=mode)


def write_summary_text(texts: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite") -> None:
    """One text report per series and method (K5): a row of JSON with the series' keys, in directories by method."""
    write_table(texts.select(*keys, "method", "report"), path, "json", ["method"], mode)
