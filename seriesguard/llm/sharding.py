"""Sharding by histogram sort, in DataFrame functions only.

Splitters cut the key order (``doc_id``, then a checksum of the text, then a row number fixed on storing) into ranges of
nearly equal bytes. A round counts the exact bytes below every candidate boundary of the cells that hold an unmet
splitter, all partitions at once; a boundary within tolerance of a splitter's target is taken, other splitters go on
inside the cell that holds their target. Then one exchange moves every row to its range, and ranges make up shards.

A range is what one task sorts, so a shard larger than ``range_bytes`` consists of several ranges: the number of shards
does not limit the number of tasks. There are at most ``MAX_RANGES`` of them, so that what the driver and the tasks hold
for each stays small (8 MB); beyond that they grow, and Spark sorts them on disk.

Defined results: null text has no bytes and null ids come first; rows with equal ids are ordered by checksum and row
number, so a hot id is split like any other; an empty table gives an empty one; own columns named like an output are
replaced.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, packed, store, unpacked

#: Bytes that a row counts besides its text.
ROW_BYTES = 8
#: Bytes that one range, the work of one task, may hold.
RANGE_BYTES = 128 << 20
#: Ranges at most; beyond MAX_RANGES * RANGE_BYTES (8 TB) ranges are larger.
MAX_RANGES = 1 << 16
#: A splitter may miss its target by this share of a range, or by half a row.
TOLERANCE = 0.001
#: Key bits that one round resolves.
BITS = 12


def _digits(low: int, high: int, uid: int) -> list:
    """The key as numbers of at most BITS bits, most significant first; the first is 0 for a null key."""
    span, parts, out = (high - low + 1).bit_length(), [(F.col("tie"), 32), (F.col("uid"), max(1, uid.bit_length()))], []
    if span <= 62:
        parts.insert(0, (F.when(F.col("k").isNull(), 0).otherwise(F.col("k") - low + 1), span))
    else:  # differences would overflow: all 64 bits, the sign flipped
        bits = F.col("k").bitwiseXOR(F.lit(-1 << 63))
        rest = 64 - (BITS - 1)
        out.append(F.when(F.col("k").isNull(), 0).otherwise(F.shiftrightunsigned(bits, rest) + 1))
        parts.insert(0, (F.coalesce(bits, F.lit(0)), rest))
    for value, bits in parts:
        for top in range(bits, 0, -BITS):
            end = max(0, top - BITS)
            out.append(F.shiftright(value.cast("long"), end).bitwiseAND((1 << (top - end)) - 1))
    return out


def _at_most(splitters, key, most: int):
    """How many of the sorted splitters are not above the key, by halving."""
    start = F.struct(F.lit(0).alias("low"), F.size(splitters).alias("high"))

    def step(a, _):
        middle = F.shiftright(a["low"] + a["high"], 1)
        below = (a["low"] < a["high"]) & (F.get(splitters, middle) <= key)
        return F.struct(F.when(below, middle + 1).otherwise(a["low"]).alias("low"),
                        F.when(below, a["high"]).otherwise(middle).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, most.bit_length()))), start, step, lambda a: a["low"])


def _place(cells: DataFrame, targets: DataFrame, parent: list[str], digit: str, slack: float, last: bool) -> DataFrame:
    """Each target with the cell that holds it: its digit, ``before`` and, if met there, the digit of the boundary."""
    both = cells.select(*parent, digit, "before", "bytes", F.col("before").alias("at"),
                        F.lit(None).cast("long").alias("splitter")) \
        .unionByName(targets.select(*parent, F.lit(None).cast("long").alias(digit),
                                    F.lit(None).cast("long").alias("before"), F.lit(None).cast("long").alias("bytes"),
                                    F.col("target").alias("at"), "splitter"))
    order = Window.partitionBy(*parent).orderBy("at", F.col("splitter").isNotNull()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    held = both.select(*parent, "splitter", F.col("at").alias("target"),
                       *[F.last(c, True).over(order).alias(c) for c in (digit, "before", "bytes")]) \
        .where("splitter is not null")
    left, right = F.col("target") - F.col("before"), F.col("before") + F.col("bytes") - F.col("target")
    near = F.least(left, right) <= (F.lit(float("inf")) if last else F.lit(slack))
    return held.withColumn("boundary", F.when(near, F.col(digit) + F.when(left <= right, 0).otherwise(1)))


def _splitters(rows: DataFrame, digits: list, total: int, ranges: int, slack: float) -> list[tuple[int, ...]]:
    """The first key of every range but the first, by rounds of exact counts."""
    keyed = rows.select("size", *[d.alias(f"d{i}") for i, d in enumerate(digits)])
    targets = rows.sparkSession.createDataFrame(
        [(s, total * s // ranges, 0) for s in range(1, ranges)], "splitter long, target long, root int")
    cells, found, parent = None, {}, ["root"]
    keyed = keyed.withColumn("root", F.lit(0))
    for depth in range(len(digits)):
        digit = f"d{depth}"
        running = Window.partitionBy(*parent).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        if cells is None:
            counted = keyed.groupBy(*parent, digit).agg(F.sum("size").alias("bytes"))
            base = F.lit(0).cast("long")
        else:  # only inside cells that hold an unmet target
            counted = keyed.join(cells, parent).groupBy(*parent, digit, "base").agg(F.sum("size").alias("bytes"))
            base = F.col("base")
        counted = counted.withColumn("before", base + F.coalesce(F.sum("bytes").over(running), F.lit(0)))
        placed = store(_place(counted, targets, parent, digit, slack, depth + 1 == len(digits)), "splitters")
        prefix = [*parent[1:], digit]
        for r in placed.where("boundary is not null").collect():  # one row for each range
            found[r.splitter] = (*[r[c] for c in parent[1:]], r.boundary)
        targets = placed.where("boundary is null").select("splitter", "target", *parent, digit)
        if targets.isEmpty():
            break
        cells = placed.where("boundary is null").select(*parent, digit, F.col("before").alias("base")).distinct()
        parent = [*parent, *prefix[-1:]]
    return [found[s] + (0,) * (len(digits) - len(found[s])) for s in sorted(found)]


def shard_by_bytes(docs: DataFrame, shards: int = 24, *, key: str = "doc_id", text: str = "text",
                   range_bytes: int = RANGE_BYTES, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows with ``size`` (long), ``shard`` (int) and ``slot`` (long, gapless in key order), exchanged once."""
    body = F.col("row").getField(text).cast("string")
    rows = store(packed(docs).select(
        "row", (F.coalesce(F.octet_length(body), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.col("row").getField(key).cast("long").alias("k"), F.crc32(F.coalesce(body, F.lit(""))).alias("tie"),
        F.monotonically_increasing_id().alias("uid")), "shards")
    all_ = rows.agg(F.sum("size").alias("bytes"), F.min("k").alias("low"), F.max("k").alias("high"),
                    F.max("uid").alias("uid")).first()
    total, low, high = all_.bytes or 0, all_.low or 0, all_.high or 0
    ranges = shards * max(1, min(MAX_RANGES // shards, math.ceil(total / shards / range_bytes)))
    digits = _digits(low, high, all_.uid or 0)
    splitters = sorted(_splitters(rows, digits, total, ranges, tolerance * total / ranges)) if total else []

    # both tables handed to the rows are bounded by the number of ranges, not of rows
    # ranges below a row's first digit, and the splitters that share it
    firsts = [s[0] for s in splitters]
    table = [(d, bisect.bisect_left(firsts, d), [list(s) for s in splitters[bisect.bisect_left(firsts, d):
                                                                             bisect.bisect_right(firsts, d)]])
             for d in range(1 << BITS)]
    lookup = docs.sparkSession.createDataFrame(table, "d0 long, below int, inside array<array<long>>")
    full = F.array(*digits)
    placed = rows.withColumn("d0", digits[0]).join(F.broadcast(lookup), "d0").withColumn(
        "part", F.col("below") + _at_most(F.col("inside"), full, max(len(t[2]) for t in table))).drop("below", "inside", "d0")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shard = F.expr(f"part div {ranges // shards}").cast("int")
    offsets = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("shard", shard).select(
        "part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    done = placed.join(F.broadcast(offsets), "part").repartitionById(ranges, F.col("part").cast("int")) \
        .sortWithinPartitions("k", "tie", "uid") \
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    return unpacked(done, docs.columns, {"size": F.col("size"), "shard": F.col("shard"),
                                         "slot": F.col("offset") + F.col("at")})


def write_shards(docs: DataFrame, path: str | None = None, **options) -> str:
    """Write the rows as Parquet in one folder for each shard; returns the path."""
    path = path or fresh_path(docs, "sharded")
    shard_by_bytes(docs, **options).write.partitionBy("shard").parquet(path)
    return path
