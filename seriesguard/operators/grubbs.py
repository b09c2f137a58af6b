"""Grubbs test (D7): repeated removal of the most extreme value.

The removed value is always the current minimum or maximum, so what remains stays a contiguous
run in sorted order and the whole loop needs only the two tails, the count and the two sums. One
round replays the loop on a bounded number of rows from each tail. Where a series uses up its
rows, its rows are sorted by value once and stored with their ranks from either end; every further
round goes on from the saved state and reads only the next slice of ranks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, attach, bundled, store
from seriesguard.functions.student_t import upper_tail
from seriesguard.operators.bundles import numbered, runs

FIRST_TAIL = 1_000
MAX_TAIL = 50_000

# the innermost value removed from either end, and how many rows went from there
EDGES = {"_low": "double", "_high": "double"}
GONE = ["_gone_low", "_gone_high"]


def is_extreme(g: float, n: int, alpha: float) -> bool:
    """Whether a Grubbs statistic exceeds its critical value.

    The critical value rises with the t quantile, so the statistic is turned into the t value
    it corresponds to and that value's tail is compared with alpha / 2n.
    """
    room = (n - 1) ** 2 - n * g * g
    if room <= 0:
        return True
    t = math.sqrt(n * (n - 2) * g * g / room)
    return upper_tail(t, n - 2) < alpha / (2 * n)


def replay(low: list, high: list, n: int, total: float, square: float, alpha: float) -> tuple:
    """Run the removal loop over two tails of (centred value, position), most extreme first.

    Returns the count and sums left, how many rows went from each tail, and whether a tail was
    used up before the loop came to its end.
    """
    from_low = from_high = 0
    while n > 2:
        if from_low == len(low) or from_high == len(high):
            return n, total, square, from_low, from_high, True
        mean = total / n
        spread = math.sqrt(max(square / n - mean * mean, 0.0))
        lowest, highest = low[from_low], high[from_high]
        down, up = mean - lowest[0], highest[0] - mean
        if spread == 0 or lowest[0] == highest[0] or not is_extreme(max(down, up) / spread, n, alpha):
            break
        if down > up or (down == up and lowest[1] < highest[1]):
            value, from_low = lowest[0], from_low + 1
        else:
            value, from_high = highest[0], from_high + 1
        n, total, square = n - 1, total - value, square - value * value
    return n, total, square, from_low, from_high, False


def tails(rows: DataFrame, keys: list[str], value: str, size: int, longest: int) -> DataFrame:
    """The ``size`` smallest and largest rows of each series.

    Ranked within parts of a series first, so no task ranks more than about the square root of a
    long series; Spark also cuts each map task's rows to ``size`` per part before the shuffle.
    """
    parts = max(1, math.ceil(math.sqrt(longest / (2 * size)))) if longest > 100 * size else 1
    ends = []
    for end, by in (("low", F.col(value).asc()), ("high", F.col(value).desc())):
        near = rows
        if parts > 1:
            near = near.withColumn("_salt", F.pmod(F.xxhash64("i"), F.lit(parts)))
            near = _top(near, [*keys, "_salt"], by, size).drop("_salt")
        ends.append(_top(near, keys, by, size).withColumn("_end", F.lit(end)))
    return ends[0].unionByName(ends[1])


def _top(rows: DataFrame, keys: list[str], by: Column, size: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(by, F.col("i"))
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size).drop("_rank")


RANKS = ["_low_rank", "_high_rank"]


def _ranked(rows: DataFrame, frame: SeriesFrame) -> DataFrame:
    """Rows (keys, i, _v) with their ranks from the smallest and from the largest value, earlier rows first among equals;
    stored in the order of ranks."""
    keys = list(frame.keys)
    values = SeriesFrame(rows.select(*keys, "_v", F.col("i").alias("_at"), F.col("_v").alias("_x")), frame.keys, ("_v", "_at"),
                         "_x", frame.block_rows)
    placed = store(values.indexed.select(*keys, "_v", F.col("_at").alias("i"), F.col("i").alias("_low_rank")))
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    equal = placed.groupBy(*keys, "_v").agg(F.min("_low_rank").alias("_first"), F.max("_low_rank").alias("_last"))
    both = attach(placed.join(equal, [*keys, "_v"]), sizes, keys, values.profile.n_series)
    high = F.col("_size") - 1 - F.col("_last") + F.col("_low_rank") - F.col("_first")
    laid = both.select(*keys, "i", "_v", "_low_rank", high.alias("_high_rank"))
    return store(laid.repartitionByRange(*keys, "_low_rank").sortWithinPartitions(*keys, "_low_rank"))


def grubbs_flags(frame: SeriesFrame, alpha: float = 0.05, first_tail: int = FIRST_TAIL) -> DataFrame:
    """Keys and positions of the flagged rows.

    A removed value marks the earliest row holding it, so of equal outliers one row is marked.
    """
    keys, profile = list(frame.keys), frame.profile
    rows = frame.indexed.select(*keys, "i", F.col(frame.value).alias("_v"))
    state = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.avg("_v").alias("_centre"), F.lit(0.0).alias("_total"),
        (F.var_pop("_v") * F.count(F.lit(1))).alias("_square"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in EDGES.items()], *[F.lit(0).cast("long").alias(g) for g in GONE])
    names = state.columns
    schema = state.withColumn("_more", F.lit(False)).schema
    near, size, ended, ranked = tails(rows, keys, "_v", first_tail, profile.longest), first_tail, [], None
    while True:
        result = bundled(attach(near, state, keys, profile.n_series), keys, profile.total, _round(keys, alpha), schema)
        if not ended and profile.longest <= first_tail:
            # every series fits into its tails, so none can be left over
            ended.append(result)
            break
        result = store(result)
        ended.append(result.where(~F.col("_more")))
        state = result.where("_more").select(*names)
        left = state.agg(F.count(F.lit(1)).alias("n"), *[f(g).alias(f"{f.__name__}{g}") for f in (F.min, F.max) for g in GONE]).first()
        if left["n"] == 0:
            break
        if ranked is None:
            ranked = _ranked(attach(rows, state.select(*keys), keys, left["n"]), frame)
        size = min(MAX_TAIL, 4 * size)
        # the outer bounds of all slices let the scan skip row groups
        reach = [F.col(rank).between(left[f"min{g}"], left[f"max{g}"] + size - 1) for rank, g in zip(RANKS, GONE)]
        slices = attach(ranked.where(reach[0] | reach[1]), state.select(*keys, *GONE), keys, left["n"]).where(
            (F.col("_low_rank") >= F.col("_gone_low")) & (F.col("_high_rank") >= F.col("_gone_high")))
        ends = [slices.where(F.col(rank) < F.col(g) + size).select(*keys, "i", "_v", F.lit(end).alias("_end"))
                for rank, g, end in zip(RANKS, GONE, ("low", "high"))]
        near = ends[0].unionByName(ends[1])
    edges = ended[0]
    for more in ended[1:]:
        edges = edges.unionByName(more)
    edges = edges.select(*keys, "_low", "_high").where(F.col("_low").isNotNull() | F.col("_high").isNotNull())
    # removal works inwards, so exactly the values at or beyond the two edges were removed
    beyond = attach(rows, edges, keys, profile.n_series).where(
        (F.col("_v") <= F.col("_low")) | (F.col("_v") >= F.col("_high")))
    return beyond.groupBy(*keys, "_v").agg(F.min("i").alias("i")).select(*keys, "i")


def _round(keys: list[str], alpha: float):
    def run(part: pa.Table) -> pa.Table:
        number, low = numbered([part], keys)[0], pc.equal(part["_end"], "low").to_numpy()
        at, value = part["i"].to_numpy(), part["_v"].to_numpy()
        order = np.lexsort((at, np.where(low, value, -value), ~low, number))
        at, value, low = at[order], value[order], low[order]
        spans = list(runs(number[order]))
        state = part.select([*keys, "_n", "_centre", "_total", "_square", *EDGES, *GONE]).take(order[[a for a, _ in spans]])
        old = {name: state[name].to_pylist() for name in state.column_names[len(keys):]}
        new = {name: [] for name in [*old, "_more"]}
        for j, (a, b) in enumerate(spans):
            centre, middle = old["_centre"][j], a + int(low[a:b].sum())
            sides = [list(zip((value[s] - centre).tolist(), at[s].tolist())) for s in (slice(a, middle), slice(middle, b))]
            n, total, square, *gone, more = replay(*sides, old["_n"][j], old["_total"][j], old["_square"][j], alpha)
            for name, now in (("_n", n), ("_centre", centre), ("_total", total), ("_square", square), ("_more", more)):
                new[name].append(now)
            for edge, went, first, taken in zip(EDGES, GONE, (a, middle), gone):
                new[edge].append(float(value[first + taken - 1]) if taken else old[edge][j])
                new[went].append(old[went][j] + taken)
        for name, column in new.items():
            kind = pa.bool_() if name == "_more" else state.schema.field(name).type
            column = pa.array(column, kind)
            state = state.append_column(name, column) if name == "_more" else state.set_column(
                state.column_names.index(name), name, column)
        return state

    return run
