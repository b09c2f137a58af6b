"""Mixing sources to target weights by Pfair scheduling.

A source's rows, in a stable random order, are cut into blocks. With the exact fractions f of the target weights, block j
of a source is released at slot floor(j / f) and due by slot ceil((j + 1) / f); earliest deadline first meets every deadline,
so after any number of slots a source is less than one block away from its share. When the shares of one of the sources are
used up, a new stretch begins: releases and deadlines count from there, and the targets of the sources that have blocks left
are scaled up to the whole. Every row comes out exactly once.

The schedule is made from the sources' block counts alone, in one task: at most ``MAX_SLOTS`` slots (and one for each source),
as blocks of a corpus beyond ``MAX_SLOTS * BLOCK_ROWS`` rows are larger in proportion. Rows find their slot by a join.

Defined results: a null source is a source of its own; sources without a given weight get ``other_weight``; repeated
rows are separate rows; an empty table gives an empty one; own columns named like an output are replaced.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, partitions, store, unpacked

#: Rows per block, and slots at most before blocks grow.
BLOCK_ROWS = 16
MAX_SLOTS = 1 << 22
#: Without given weights, a source's weight is its row count to this power.
TEMPER = 0.7
#: Rows of one source that one window group numbers.
BUCKET_ROWS = 1 << 9
#: Buckets are summed in two levels: as a power of two, how many runs of them a source has at most.
RUN_BITS = 16

SLOTS = "src string, block long, slot long, release long, deadline long"


def earliest_deadline_first(weights: Mapping[str, float], blocks: Mapping[str, int] | None = None
                            ) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) in the order of slots; every block is placed in [release, deadline).

    ``blocks``: how many each source has; by default as many as its weight says.
    """
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*[w.denominator for w in exact.values()])
    weight = {s: int(w * scale) for s, w in exact.items()}
    left = {s: int(n) for s, n in (blocks or weight).items() if n > 0}
    done, base = dict.fromkeys(left, 0), 0
    while left:  # a stretch in which no source runs out
        total = sum(weight[s] for s in left)
        stretch = min(n * total // weight[s] for s, n in left.items())
        waiting = [(0, -(-total // weight[s]), s, 0) for s in sorted(left)]  # by release
        heapq.heapify(waiting)
        ready: list[tuple[int, str, int, int]] = []  # by deadline
        for slot in range(stretch):
            while waiting and waiting[0][0] <= slot:
                release, deadline, s, j = heapq.heappop(waiting)
                heapq.heappush(ready, (deadline, s, j, release))
            deadline, s, j, release = heapq.heappop(ready)
            yield s, done[s], base + slot, base + release, base + deadline
            done[s] += 1
            j += 1
            heapq.heappush(waiting, (j * total // weight[s], -(-(j + 1) * total // weight[s]), s, j))
            left[s] -= 1
        left = {s: n for s, n in left.items() if n}
        base += stretch


def _schedule(rows: pd.DataFrame) -> pd.DataFrame:
    found = earliest_deadline_first(dict(zip(rows.src, rows.weight)), dict(zip(rows.src, rows.blocks)))
    return pd.DataFrame(found, columns=["src", "block", "slot", "release", "deadline"])


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, *, source: str = "source",
        temper: float = TEMPER, other_weight: float = 1.0, block_rows: int = BLOCK_ROWS,
        max_slots: int = MAX_SLOTS) -> DataFrame:
    """The rows with ``mix_block`` (of its source), ``mix_release``, ``mix_deadline``, ``mix_slot`` and ``mix_row``.

    The mixture is the rows by (mix_slot, mix_row); slots count blocks and have no gap. The order inside a source is that of
    a hash of the row and its place in the table.
    """
    return _mixed(docs, weights, source, temper, other_weight, block_rows, max_slots)[0]


def _mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None, source: str = "source",
           temper: float = TEMPER, other_weight: float = 1.0, block_rows: int = BLOCK_ROWS,
           max_slots: int = MAX_SLOTS) -> tuple[DataFrame, int]:
    """What ``mix`` gives, and the number of slots."""
    given = {"" if s is None else f"={s}": float(w) for s, w in (weights or {}).items()}
    if any(not 0 < w < math.inf for w in [other_weight, *given.values()]):
        raise ValueError("weights must be positive")
    spark = docs.sparkSession
    src = F.when(F.col("row").getField(source).isNull(), "").otherwise(
        F.concat(F.lit("="), F.col("row").getField(source).cast("string")))
    rows = store(packed(docs).select("row", src.alias("src"), F.monotonically_increasing_id().alias("uid")), "mixing")
    # equal rows have places of their own, so no bucket is hot
    ids = rows.select("src", "uid", F.xxhash64("row", "uid").alias("h"))
    sources = store(rows.groupBy("src").agg(F.count(F.lit(1)).alias("n")), "sources")
    sums = sources.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    size = max(block_rows, math.ceil((sums.n or 0) / max_slots))
    if weights is None:
        weighted = sources.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(temper))))
    else:
        table = spark.createDataFrame(list(given.items()), "src string, weight double")
        weighted = sources.join(table, "src", "left").withColumn("weight", F.coalesce("weight", F.lit(float(other_weight))))
    weighted = weighted.select("src", "weight", F.expr(f"(n + {size - 1}) div {size}").alias("blocks"))
    slots = weighted.groupBy().applyInPandas(_schedule, SLOTS)
    total = weighted.agg(F.sum("blocks")).first()[0] or 0

    # index of a row in its source: buckets of a stable hash, numbered within, offset by the buckets before
    bits = max(0, math.ceil(math.log2(max(1, (sums.most or 0) / BUCKET_ROWS))))
    ids = ids.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long"))
    counted = ids.groupBy("src", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "run", F.shiftright("bucket", max(0, bits - RUN_BITS)))
    upto = lambda by, at: F.coalesce(F.sum("n").over(
        Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = counted.groupBy("src", "run").agg(F.sum("n").alias("n")).select("src", "run", upto(["src"], "run").alias("before"))
    offsets = counted.withColumn("inner", upto(["src", "run"], "bucket")).join(runs, ["src", "run"]) \
        .select("src", "bucket", (F.col("before") + F.col("inner")).alias("offset"))
    inside = Window.partitionBy("src", "bucket").orderBy("h", "uid")
    placed = (ids.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["src", "bucket"])
              .withColumn("k", F.col("at") + F.col("offset")).withColumn("block", F.expr(f"k div {size}"))
              .join(slots, ["src", "block"]).select("uid", "block", "release", "deadline", "slot",
                                                    (F.col("k") % size).cast("long").alias("inner")))
    return unpacked(rows.select("row", "uid").join(placed, "uid"), docs.columns, {
        "mix_block": F.col("block"), "mix_release": F.col("release"), "mix_deadline": F.col("deadline"),
        "mix_slot": F.col("slot"), "mix_row": F.col("inner")}), total


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows alone, laid out in the mixture's order: sorted partitions of as many slots each, one after the other."""
    rows, slots = _mixed(docs, **options)
    n = partitions(docs)
    part = F.expr(f"mix_slot * {n} div {max(1, slots)}").cast("int")
    return rows.repartitionById(n, part).sortWithinPartitions("mix_slot", "mix_row").select(*docs.columns)
