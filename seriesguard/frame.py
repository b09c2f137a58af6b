"""The series frame: keyed, ordered rows of one value, and how work splits inside a series.

A series is the set of rows with equal key columns, ordered by time and tie-breakers. It is
never gathered into one task unless a size check has shown that it fits. Longer series are
cut into blocks of consecutive rows; window frames that reach over a block edge are served by
copying the few rows next to the edge.
"""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from seriesguard.functions.names import time_to_micros

# A per-series table is broadcast up to this size; beyond it the join is left to the adaptive
# sort-merge join, which splits skewed keys.
BROADCAST_BYTES = 32 << 20
TEXT_BYTES = 64

# Rows per block: fewer when the data is small, so that every core has work, but never so few
# that cutting a series costs more than it saves.
MAX_BLOCK_ROWS = 1 << 17
MIN_BLOCK_ROWS = 1 << 15

# A time bucket holding more than this many blocks counts as hot: times are too uneven for
# equal-width buckets and the rows are range-partitioned instead.
HOT_BUCKET_BLOCKS = 8

# Where Python runs on many small groups, one call gets a bundle of them: about so many rows.
BUNDLE_ROWS = 10_000

# Without it shuffle files stay until the driver's garbage collector happens to find their owners.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows that a task sorts or aggregates. Left to sizes in bytes, tasks get many more where values compress well.
TASK_ROWS = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="seriesguard-"))
        named = spark.sparkContext.getCheckpointDir()
    return named


def store(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and continue from there.

    For results several passes read: they are computed once, survive lost executors, and later
    scans read only the columns they need. Shuffle files of the write go when it ends.
    """
    spark = df.sparkSession
    path = path or stored_path(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stored_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/seriesguard-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete what ``store`` wrote there, once nothing that is still to be computed reads it."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def attach(rows: DataFrame, table: DataFrame, on: Sequence[str], size: int | None,
           how: str = "inner", values: int = 0) -> DataFrame:
    """Join a table with one row per key to the rows; broadcast only when it is known to be small.

    ``size`` bounds the table's rows (None: unknown), ``values`` the entries of its array columns.
    """
    width = sum(TEXT_BYTES if kind == "string" else 8 for _, kind in table.dtypes) + 8 * values
    small = size is not None and size * width <= BROADCAST_BYTES
    return rows.join(F.broadcast(table) if small else table, list(on), how)


def cogrouped(left: DataFrame, right: DataFrame, by: Sequence[str], run, schema) -> DataFrame:
    """Run ``run`` on the rows both sides have for each value of ``by``."""
    # both sides often stem from the same rows; renamed columns tell them apart
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, schema)


def bundles(rows: DataFrame, by: Sequence[str], count: int, size: int) -> DataFrame:
    """The rows with ``_bundle``, a hash of ``by`` with ``count`` values, spread over tasks of some bundles each."""
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, size // (4 * BUNDLE_ROWS))
    return rows.withColumn("_bundle", F.pmod(F.xxhash64(*by), F.lit(count))).repartition(tasks, "_bundle")


def bundled(rows: DataFrame, by: Sequence[str], size: int, run, schema) -> DataFrame:
    """Run ``run`` on Arrow tables that hold whole groups of ``by``, many where they are small; ``size`` is the number of rows."""
    count = max(8 * rows.sparkSession.sparkContext.defaultParallelism, size // BUNDLE_ROWS)
    return bundles(rows, by, count, size).groupBy("_bundle").applyInArrow(lambda part: run(part), schema)


def cobundled(left: DataFrame, right: DataFrame, by: Sequence[str], size: int, run, schema) -> DataFrame:
    """The same with the groups of two tables; ``size`` is the number of rows of the larger one."""
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    count = max(8 * left.sparkSession.sparkContext.defaultParallelism, size // BUNDLE_ROWS)
    sides = [bundles(side, by, count, size).groupBy("_bundle") for side in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(lambda a, b: run(a, b), schema)


@dataclass(frozen=True)
class Profile:
    """Row counts that decide how the work is split. Nulls and NaNs are not counted."""

    total: int
    n_series: int
    longest: int
    longer_than: dict[int, int]

    def series_longer_than(self, rows: int) -> int:
        """Upper bound on the number of series with more than ``rows`` rows."""
        known = [size for size in self.longer_than if size <= rows]
        return self.longer_than[max(known)] if known else self.n_series


@dataclass(frozen=True)
class SeriesFrame:
    """Rows of many series.

    ``keys`` identify a series, ``order`` lists the time column and then any tie-breakers,
    ``value`` names the measured column.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    value: str = "value"
    block_rows: int | None = None

    @property
    def time(self) -> str:
        return self.order[0]

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.order, self.value]

    @cached_property
    def valid(self) -> DataFrame:
        """Rows that take part in statistics."""
        value = F.col(self.value)
        return self.rows.select(*self.columns).where(value.isNotNull() & ~F.isnan(value))

    @cached_property
    def invalid(self) -> DataFrame:
        """Rows with null or NaN value: carried through, never flagged."""
        value = F.col(self.value)
        return self.rows.select(*self.columns).where(value.isNull() | F.isnan(value))

    @cached_property
    def profile(self) -> Profile:
        """One aggregation job over the key columns; its result is a single row."""
        sizes = [1 << p for p in range(4, 41, 2)]
        counts = self.valid.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))
        row = counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.count(F.lit(1)).alias("n_series"),
            F.coalesce(F.max("n"), F.lit(0)).alias("longest"),
            *[F.expr(f"count_if(n > {s}) AS gt{s}") for s in sizes],
        ).first()
        return Profile(row["total"], row["n_series"], row["longest"],
                       {s: row[f"gt{s}"] for s in sizes})

    def spread(self, rows: DataFrame, by: Sequence[str], largest: int | None = None) -> DataFrame:
        """Rows of the frame's size, hashed by ``by`` over enough tasks that each gets about TASK_ROWS of them.

        ``largest`` bounds the rows with equal ``by``. Small tables stay as they are, and those with larger groups.
        """
        cores = rows.sparkSession.sparkContext.defaultParallelism
        largest = self.profile.longest if largest is None else largest
        if self.profile.total <= TASK_ROWS * cores or largest > TASK_ROWS:
            return rows
        return rows.repartition(math.ceil(self.profile.total / TASK_ROWS), *by)

    @cached_property
    def block(self) -> int:
        if self.block_rows:
            return self.block_rows
        cores = self.rows.sparkSession.sparkContext.defaultParallelism
        want = max(1, self.profile.total // (4 * cores))
        return min(MAX_BLOCK_ROWS, max(MIN_BLOCK_ROWS, 1 << (want - 1).bit_length()))

    @cached_property
    def full_order(self) -> list[str]:
        """Order columns plus the value, so that ties cannot change a result."""
        return [*self.order, self.value]

    @cached_property
    def stored(self) -> SeriesFrame:
        """The same frame with its indexed rows written once, for work in several passes.

        Statistics read what was written too; of the source only the rows without a value are read again.
        """
        frame = SeriesFrame(self.rows, self.keys, self.order, self.value, self.block_rows)
        indexed = store(self.indexed)
        vars(frame).update(profile=self.profile, stored=frame, indexed=indexed, valid=indexed.drop("i"))
        return frame

    @cached_property
    def indexed(self) -> DataFrame:
        """Valid rows plus ``i``, the 0-based position in the series."""
        if self.profile.longest <= self.block:
            window = Window.partitionBy(*self.keys).orderBy(*self.full_order)
            return self.spread(self.valid, self.keys).withColumn("i", F.row_number().over(window).cast("long") - 1)
        bucketed = self._bucketed()
        counts = (bucketed.where(F.col("_bucket") >= 0).groupBy(*self.keys, "_bucket")
                  .agg(F.count(F.lit(1)).alias("_count")))
        hottest = counts.agg(F.max("_count").alias("m")).first()["m"]
        if hottest > HOT_BUCKET_BLOCKS * self.block:
            return self._range_indexed()
        before = (Window.partitionBy(*self.keys).orderBy("_bucket")
                  .rowsBetween(Window.unboundedPreceding, -1))
        offsets = counts.select(
            *self.keys, "_bucket", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"))
        n_buckets = 2 * self.profile.total // self.block + 1
        placed = attach(bucketed, offsets, [*self.keys, "_bucket"], n_buckets, "left")
        window = Window.partitionBy(*self.keys, "_bucket").orderBy(*self.full_order)
        position = F.coalesce("_offset", F.lit(0)) + F.row_number().over(window) - 1
        return placed.select(*self.columns, position.cast("long").alias("i"))

    def _bucketed(self) -> DataFrame:
        """Cut long series into equal time spans of about one block; short series get -1."""
        time = F.col(self.time)
        if dict(self.rows.dtypes)[self.time].startswith("timestamp"):
            time = time_to_micros(time)
        time = time.cast("double")
        spans = (self.valid.groupBy(*self.keys)
                 .agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_t0"), F.max(time).alias("_t1"))
                 .where(F.col("_n") > self.block))
        rows = attach(self.valid, spans, self.keys,
                      self.profile.series_longer_than(self.block), "left")
        n_buckets = F.ceil(F.col("_n") / self.block)
        share = (time - F.col("_t0")) / (F.col("_t1") - F.col("_t0") + 1)
        bucket = F.least(n_buckets - 1, F.floor(share * n_buckets))
        return rows.select(*self.columns, F.coalesce(bucket, F.lit(-1)).cast("long").alias("_bucket"))

    def _range_indexed(self) -> DataFrame:
        """Positions by a range-partitioned sort, for times too uneven for equal buckets.

        Sampling balances the partitions over keys, times, tie-breakers and, through the row
        id, even full copies. The sorted rows are written once, so counts and positions agree.
        """
        parts = max(8, math.ceil(self.profile.total / self.block))
        by = [*self.keys, *self.full_order, "_row"]
        placed = store(
            self.valid.withColumn("_row", F.monotonically_increasing_id())
            .repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_row")
            .withColumn("_at", F.monotonically_increasing_id()))
        # the upper bits of the id are the partition number, the lower 33 the row in it
        placed = placed.withColumn("_part", F.shiftright("_at", 33))
        before = (Window.partitionBy(*self.keys).orderBy("_part")
                  .rowsBetween(Window.unboundedPreceding, -1))
        runs = (placed.groupBy(*self.keys, "_part")
                .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_count"))
                .select(*self.keys, "_part", "_first",
                        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset")))
        rows = attach(placed, runs, [*self.keys, "_part"], self.profile.n_series + parts)
        position = F.col("_offset") + F.col("_at") - F.col("_first")
        return rows.select(*self.columns, position.alias("i"))

    def blocks(self, back: int = 0, fwd: int = 0, rows: DataFrame | None = None) -> Blocks:
        """Rows laid out for window frames reaching ``back`` rows behind and ``fwd`` ahead."""
        rows = self.indexed if rows is None else rows
        size = max(self.block, 4 * max(back, fwd, 1))
        if self.profile.longest <= size:
            return Blocks(self.spread(rows, self.keys), list(self.keys), None)
        own = F.expr(f"i div {size}")
        copies = F.array(
            own,
            F.when((own > 0) & (F.col("i") % size < fwd), own - 1),
            F.when(size - F.col("i") % size <= back, own + 1))
        spread = rows.withColumn("_block", F.explode(F.array_compact(copies)))
        by = [*self.keys, "_block"]
        return Blocks(self.spread(spread, by, size), by, F.col("_block") == own)


@dataclass(frozen=True)
class Blocks:
    """Rows with their block and the copies a block needs from its neighbours."""

    rows: DataFrame
    by: list[str]
    own: Column | None

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy("i")

    def owned(self, rows: DataFrame) -> DataFrame:
        """Drop the copies once the frames are computed."""
        return rows if self.own is None else rows.where(self.own).drop("_block")


def series_frame(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 block_rows: int | None = None) -> SeriesFrame:
    """Any table as a series frame (S7): pick key, order and value columns, value as double."""
    picked = rows.select(*keys, *order, F.col(value).cast("double").alias("value"))
    return SeriesFrame(picked, tuple(keys), tuple(order), "value", block_rows)
