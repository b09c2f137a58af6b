"""Picking series and rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame


def one_series(frame: SeriesFrame, **key) -> DataFrame:
    """Time and value of one series in time order; the filter reaches the scan."""
    rows = frame.rows
    for name, wanted in key.items():
        rows = rows.where(F.col(name) == wanted)
    return rows.select(*frame.order, frame.value).orderBy(*frame.order)


def restrict(frame: SeriesFrame, key: Mapping[str, object]) -> SeriesFrame:
    """The frame cut down to the series matching ``key``."""
    rows = frame.rows
    for name, wanted in key.items():
        rows = rows.where(F.col(name) == wanted)
    return SeriesFrame(rows, frame.keys, frame.order, frame.value, frame.block_rows)


def services(rows: DataFrame, service: str = "cmdb_id") -> DataFrame:
    """Distinct services."""
    return rows.select(service).distinct()


def kpis(rows: DataFrame, service: str | None = None, service_column: str = "cmdb_id",
         kpi_column: str = "kpi_name") -> DataFrame:
    """Distinct KPIs, of one service if given."""
    if service:
        rows = rows.where(F.col(service_column) == service)
    return rows.select(kpi_column).distinct()


def anomalous(detections: DataFrame) -> DataFrame:
    return detections.where("is_anomaly")


def normal(detections: DataFrame) -> DataFrame:
    return detections.where(~F.col("is_anomaly"))


def label(rows: DataFrame, flag: Column) -> DataFrame:
    """Append a flag and its 0/1 score."""
    flag = F.coalesce(flag, F.lit(False))
    return rows.withColumns({"is_anomaly": flag, "anomaly_score": flag.cast("double")})


def first_series(rows: DataFrame, service: str = "cmdb_id", kpi: str = "kpi_name") -> DataFrame:
    """The first service by name and its first KPI by name."""
    return rows.agg(F.min(F.struct(service, kpi)).alias("_first")).select(
        F.col(f"_first.{service}").alias(service), F.col(f"_first.{kpi}").alias(kpi))
