"""The series store (S6, K6, K7): Parquet files in hashed buckets, clustered by device, measurement and time.

A store has a fixed number of buckets, chosen by its first write; the directory names hold that number and the bucket, so
readers need no further metadata. A bucket holds all rows of its devices in files sorted by (device, measurement, time): a
reader prunes buckets by the device's hash, and row groups by names and time. There is no directory for each series, and a
long series is several files. Writing to a store again merges: a stored row whose series and millisecond
come again is replaced, and only buckets with new rows are rewritten.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesguard.frame import store
from seriesguard.functions.names import clean_name, millis_to_time, time_to_millis
from seriesguard.sources.csv import load_cloudbed

#: Rows that a bucket is planned for, and buckets of a store at most. Together they are directories, not tasks.
BUCKET_ROWS = 1 << 24
MAX_BUCKETS = 1 << 12

ROWS = "timestamp timestamp, value double, device_name string, measurement_name string, device string, measurement string"
LAYOUT = ["buckets", "device_bucket"]
SERIES = ["device_name", "measurement_name"]


def bucket_of(device: Column, buckets: Column) -> Column:
    """Bucket of a device by its cleaned name."""
    return F.pmod(F.xxhash64(device), buckets).cast("int")


def write_store(rows: DataFrame, path: str, device: str = "cmdb_id", measurement: str = "kpi_name",
                time: str = "timestamp", value: str = "value", mode: str = "overwrite") -> None:
    """Store many series at once: one row per series and millisecond, the last one kept.

    ``mode``: "overwrite" makes the store anew, "append" merges with what it has; rows written later win. The raw names
    stay as columns next to the cleaned ones that reads look for.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    spark = rows.sparkSession
    raw = rows.select(
        F.col(device).cast("string").alias("device_name"), F.col(measurement).cast("string").alias("measurement_name"),
        time_to_millis(F.col(time)).alias("_ms"), F.col(time).alias("_time"), F.col(value).cast("double").alias("value"))
    last = raw.groupBy(*SERIES, "_ms").agg(F.max_by("value", F.struct("_time", "value")).alias("value"))
    new = store(last.select(
        millis_to_time(F.col("_ms")).alias("timestamp"), "value", *SERIES,
        clean_name(F.col("device_name")).alias("device"), clean_name(F.col("measurement_name")).alias("measurement")))
    buckets = _buckets(spark, path) if mode == "append" else None
    if buckets is None:
        n = new.count()
        buckets = min(MAX_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1, n / BUCKET_ROWS)))))
        _write(new, path, buckets, dynamic=False)
        return
    # at most MAX_BUCKETS numbers; the rest of the store is neither read nor written
    touched = [r["b"] for r in new.select(bucket_of(F.col("device"), F.lit(buckets)).alias("b")).distinct().collect()]
    if not touched:
        return
    old = _stored(spark, path).where(F.col("device_bucket").isin(touched)).drop(*LAYOUT)
    same = [old[c].eqNullSafe(new[c]) for c in [*SERIES, "timestamp"]]
    kept = old.join(new, same[0] & same[1] & same[2], "left_anti")
    # complete elsewhere before the first stored file is replaced
    _write(store(kept.unionByName(new)), path, buckets, dynamic=True)


def _write(rows: DataFrame, path: str, buckets: int, dynamic: bool) -> None:
    # ranges of equal size: a long series, or a crowded day of one, is cut into several files by time
    order = ["device_bucket", "device", "measurement", "timestamp"]
    laid = rows.withColumns({"buckets": F.lit(buckets), "device_bucket": bucket_of(F.col("device"), F.lit(buckets))})
    (laid.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy(*LAYOUT).parquet(path))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{ROWS}, buckets int, device_bucket int").parquet(path)


def _buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of a store, None where there is none yet."""
    try:
        row = _stored(spark, path).select("buckets").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row["buckets"] if row else None


def read_store(spark: SparkSession, path: str, device: str | None = None, measurement: str | None = None,
               start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """Stored rows of one series, one device or all, inside the closed time range.

    Each bound is optional. A device prunes buckets, all bounds reach the Parquet scan.
    """
    rows = _stored(spark, path)
    if device is not None:
        name = clean_name(F.lit(device))
        rows = rows.where((F.col("device_bucket") == bucket_of(name, F.col("buckets"))) & (F.col("device") == name))
    if measurement is not None:
        rows = rows.where(F.col("measurement") == clean_name(F.lit(measurement)))
    return in_range(rows.drop(*LAYOUT), "timestamp", start_ms, end_ms)


def in_range(rows: DataFrame, time: str, start_ms: int | None, end_ms: int | None) -> DataFrame:
    """Rows in a closed range of epoch milliseconds, each bound optional."""
    # a bound of the column's own type is what the scan can push down
    kind = dict(rows.dtypes)[time]
    if start_ms is not None:
        rows = rows.where(F.col(time) >= millis_to_time(F.lit(start_ms)).cast(kind))
    if end_ms is not None:
        rows = rows.where(F.col(time) <= millis_to_time(F.lit(end_ms)).cast(kind))
    return rows


def ingest_cloudbed(spark: SparkSession, root: str, cloudbed: str, store: str, mode: str = "overwrite") -> None:
    """Load every series of a cloudbed into the store in one distributed write (K7, E4); "append" merges with it."""
    write_store(load_cloudbed(spark, root, cloudbed), store, mode=mode)
